"""The account tables, derived from the star-schema tables that a run is given.

``Workspace`` is the single place where queries get their inputs. Each property is a lazy DataFrame over
the parquet files; only the columns a query needs reach the scan.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kithscope.functions.authenticity import score_accounts
from kithscope.functions.bands import QUEUE_GATE
from kithscope.schemas import GIVEN_TABLES
from kithscope.session import scratch_path

AS_OF = "2001-07-15 00:00:00"
CURATED = "@customers"


class Workspace:
    def __init__(self, spark: SparkSession, sf_dir: str, as_of: str = AS_OF):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.as_of = as_of

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.schema(GIVEN_TABLES[name]).parquet(f"{self.sf_dir}/{name}.parquet")

    def once(self, df: DataFrame, label: str) -> DataFrame:
        """``df`` written to the shared folder and read back, for inputs a plan would otherwise compute several times."""
        path = scratch_path(self.spark, label)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    @cached_property
    def user_stats(self) -> DataFrame:
        """Counters per account. Line items are summed per order before the join, so the join and the
        per-customer total move one row per order instead of one per line."""
        per_order = self.raw("lineitem").groupBy("l_orderkey").agg(
            F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("q")
        )
        per_customer = (
            self.raw("orders")
            .join(per_order, F.col("o_orderkey") == F.col("l_orderkey"))
            .groupBy("o_custkey")
            .agg(
                F.min("o_orderdate").alias("first_at"),
                F.max("o_orderdate").alias("last_at"),
                F.sum("n").alias("lines"),
                F.sum("q").cast("bigint").alias("quantity"),
            )
        )
        joined = self.raw("customer").join(per_customer, F.col("c_custkey") == F.col("o_custkey"), "left")
        return joined.selectExpr(
            "*", "c_custkey % 20 = 3 as mass", "(c_custkey * 7919) % 7001 as mixed", "coalesce(lines, 0) as n_lines"
        ).selectExpr(
            "cast(c_custkey as string) as twitter_id",
            "case when mass then c_custkey % 120 when c_custkey % 25 = 4 then floor((c_acctbal + 1000) * 200)"
            " else floor((c_acctbal + 1000) * (1 + c_custkey % 17) / 10) end as followers",
            "case when mass then 4000 + mixed when c_custkey % 25 = 4 then c_custkey % 300 else mixed end as following",
            "case when mass then n_lines * 20000 else n_lines * ((c_custkey * 31) % 400) end as statuses",
            "case when mass then 0 else coalesce(quantity, 0) * (c_custkey % 5) end as favorites",
            "c_custkey % 120 as listed",
            "n_lines * (c_custkey % 7) as media",
            "c_custkey % 6 = 0 as blue_verified",
            "c_custkey % 11 = 0 or mass as default_profile",
            "c_custkey % 22 = 0 or c_custkey % 40 = 3 as default_image",
            "c_custkey % 13 = 0 as sensitive",
            "case when c_custkey % 8 = 5 then last_at else first_at end as created_at",
        )

    @cached_property
    def bios(self) -> DataFrame:
        return self.raw("documents").select("doc_id", F.col("text").alias("bio"))

    def _profiles(self, customers: DataFrame, *bio: str) -> DataFrame:
        k = F.col("c_custkey")
        places = self.raw("nation").select("n_nationkey", F.col("n_name").alias("location"))
        return (
            customers
            .join(places, F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .select(
                k.cast("string").alias("twitter_id"),
                F.lower(F.replace(F.col("c_name"), F.lit("#"), F.lit("_"))).alias("handle"),
                F.col("c_name").alias("name"),
                *bio,
                "location",
                F.col("c_mktsegment").alias("category"),
                F.when(k % 10 == 0, "bluesky").otherwise("twitter").alias("platform"),
                (k % 2 == 0).alias("can_dm"),
            )
        )

    @cached_property
    def user_profiles(self) -> DataFrame:
        return self._profiles(self.raw("customer").join(self.bios, F.col("c_custkey") == F.col("doc_id"), "left"), "bio")

    @cached_property
    def accounts(self) -> DataFrame:
        """The profiles without their bios, the only long texts in them."""
        return self._profiles(self.raw("customer"))

    @cached_property
    def scores(self) -> DataFrame:
        """twitter_id, human_score, likely_is."""
        return score_accounts(self.user_stats, self.as_of).select("twitter_id", "human_score", "likely_is")

    @cached_property
    def profiles(self) -> DataFrame:
        """Profiles with the computed score and class."""
        return self.user_profiles.join(self.scores, "twitter_id")

    @cached_property
    def queue(self) -> DataFrame:
        """Accounts above the queue gate, added when the account was created."""
        scored = score_accounts(self.user_stats, self.as_of)
        handles = self.user_profiles.select("twitter_id", "handle")
        return (
            scored.filter(F.col("human_score") > QUEUE_GATE)
            .select("twitter_id", F.col("created_at").alias("added_at"))
            .join(handles, "twitter_id")
            .select("twitter_id", "handle", "added_at")
        )

    @cached_property
    def user_keywords(self) -> DataFrame:
        """(account, keyword) once, with the first time it was seen."""
        brands = self.raw("part").select("p_partkey", F.col("p_brand").alias("keyword"))
        per_order = (
            self.raw("lineitem")
            .select("l_orderkey", "l_partkey")
            .join(brands, F.col("l_partkey") == F.col("p_partkey"))
            .select("l_orderkey", "keyword")
        )
        found = (
            self.raw("orders")
            .select("o_orderkey", "o_custkey", "o_orderdate")
            .join(per_order, F.col("o_orderkey") == F.col("l_orderkey"))
            .groupBy(F.col("o_custkey").cast("string").alias("twitter_id"), "keyword")
            .agg(F.min("o_orderdate").alias("added_at"))
        )
        curated = (
            self.raw("customer")
            .filter(F.col("c_custkey") % 50 == 7)
            .select(
                F.col("c_custkey").cast("string").alias("twitter_id"),
                F.lit(CURATED).alias("keyword"),
                F.lit("1995-01-01 00:00:00").cast("timestamp_ntz").alias("added_at"),
            )
        )
        return found.unionByName(curated)

    @cached_property
    def keyword_table(self) -> DataFrame:
        """``user_keywords`` computed once, for plans that need it more than once."""
        return self.once(self.user_keywords, "keyword-hits")

    @cached_property
    def profile_scores(self) -> DataFrame:
        """Latest label per (account, model). ``max_by`` keeps one row per key already on the map side,
        so a customer with very many lines never gathers in one sort."""
        latest = F.struct("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey")
        orders = (
            self.raw("orders")
            .filter(F.col("o_custkey") % 3 != 0)
            .select("o_orderkey", F.col("o_custkey").cast("string").alias("twitter_id"), "o_orderpriority")
        )
        lines = self.raw("lineitem").select(
            "l_orderkey", "l_partkey", "l_linenumber", "l_returnflag", "l_shipdate"
        )
        model = (
            F.when(F.col("l_linenumber") % 3 == 0, "model-a")
            .when(F.col("l_linenumber") % 3 == 1, "model-b")
            .otherwise("model-c")
        )
        picked = (
            orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
            .groupBy("twitter_id", model.alias("scored_by"))
            .agg(F.max_by(F.struct("l_returnflag", "o_orderpriority", "l_shipdate"), latest).alias("row"))
        )
        return picked.select(
            "twitter_id",
            "scored_by",
            F.when(F.col("row.l_returnflag") == "A", F.lit(True))
            .when(F.col("row.l_returnflag") == "R", F.lit(False))
            .alias("label"),
            F.col("row.o_orderpriority").alias("reason"),
            F.col("row.l_shipdate").alias("scored_at"),
        )

    @cached_property
    def searches(self) -> DataFrame:
        """Search log: one page per keyword and period, the newest page of some keywords without cursor."""
        day = F.date_trunc("day", F.col("ts"))
        events = self.raw("events").select("event_id", "ts", "user_id", F.col("event_type").alias("keyword"))
        by_day = events.groupBy("keyword", day.alias("d")).agg(
            F.count(F.lit(1)).alias("items"), F.min("ts").alias("query_at")
        )
        first_events = (
            events.groupBy("user_id")
            .agg(F.min_by(F.struct("keyword", day.alias("d")), F.struct("ts", "event_id")).alias("f"))
            .groupBy(F.col("f.keyword").alias("keyword"), F.col("f.d").alias("d"))
            .agg(F.count(F.lit(1)).alias("new_profiles"))
        )
        tags = self.keyword_table.filter(F.col("keyword") != CURATED)
        year = F.date_trunc("year", F.col("added_at"))
        by_year = tags.groupBy("keyword", year.alias("d")).agg(
            F.count(F.lit(1)).alias("items"), F.min("added_at").alias("query_at")
        )
        first_tags = (
            tags.groupBy("twitter_id")
            .agg(F.min_by(F.struct("keyword", year.alias("d")), F.struct("added_at", "keyword")).alias("f"))
            .groupBy(F.col("f.keyword").alias("keyword"), F.col("f.d").alias("d"))
            .agg(F.count(F.lit(1)).alias("new_profiles"))
        )
        pages = _number_pages(by_day.join(first_events, ["keyword", "d"], "left"), F.col("keyword").isin("error", "view"))
        more = _number_pages(by_year.join(first_tags, ["keyword", "d"], "left"), F.col("keyword").endswith("3"))
        return pages.unionByName(more)


def _number_pages(periods: DataFrame, exhausted: Column) -> DataFrame:
    """Pages count up by period inside a keyword. The windows run over one row per keyword and period."""
    by_period = Window.partitionBy("keyword").orderBy("d")
    newest = Window.partitionBy("keyword").orderBy(F.col("d").desc())
    page = (F.row_number().over(by_period) - 1).cast("bigint")
    closed = (F.row_number().over(newest) == 1) & exhausted
    numbered = periods.select(
        "keyword", "items", page.alias("page"), closed.alias("closed"),
        F.coalesce("new_profiles", F.lit(0)).cast("bigint").alias("new_profiles"), "query_at",
    )
    cursor = F.when(~F.col("closed"), F.concat(F.lit("c"), F.col("page").cast("string")))
    return numbered.select("keyword", "items", "page", cursor.alias("next_page"), "new_profiles", "query_at")
