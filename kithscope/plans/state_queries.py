"""Queries for samples, batches, array operators, merges and quality checks."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kithscope.functions.numbers import r6, row_count, seeded_order
from kithscope.operators import keywords, lookups, merges, quality, sampling
from kithscope.operators.ordering import bottom_k
from kithscope.plans.account_queries import cell_sql, trim_sql
from kithscope.plans.catalog import Catalog
from kithscope.plans.evaluation_queries import marked
from kithscope.plans.relation_queries import mixed_case_handles
from kithscope.plans.workspace import CURATED, Workspace
from kithscope.schemas import UNIQUE_KEYS
from kithscope.session import scratch_path
from kithscope.sources import batch_files, delimited, exports, tables

catalog = Catalog()

# --- samples and batches -----------------------------------------------------------------------------


@catalog.query(
    "k3_random_sample",
    """select p.handle, p.name, p.bio, p.category, coalesce(s.followers, 0) as followers from (select * from user_profiles
    where bio<>'' and name<>'' order by md5(twitter_id || '|11'), twitter_id limit 25) p left join user_stats s using (twitter_id)""",
)
def _(w):
    usable = w.user_profiles.filter((F.col("bio") != "") & (F.col("name") != ""))
    picked = sampling.random_sample(usable, "twitter_id", 25, "11")
    return lookups.with_followers(picked, w.user_stats).select("handle", "name", "bio", "category", "followers")


@catalog.query(
    "k3_half_of_all",
    """select twitter_id, handle from (select *, row_number() over (order by md5(twitter_id || '|half'), twitter_id) as place, count(*) over () as n from user_profiles) t
    where place <= n // 2""",
)
def _(w):
    """A sample of half of the table, cut off in place."""
    rows = w.user_profiles.select("twitter_id", "handle")
    return bottom_k(rows, seeded_order("half", F.col("twitter_id")), "twitter_id", rows.count() // 2, few=100)


STRATA = """select s.*, p.handle, row_number() over (partition by s.twitter_id, case when s.label then 'true' else 'other' end
   order by md5(s.twitter_id || '|' || s.scored_by || '|5'), s.scored_by) as one, case when s.label then 'true' else 'other' end as stratum
 from profile_scores s join user_profiles p using (twitter_id) where p.bio<>'' and p.name<>''"""


@catalog.query(
    "k4_stratified_sample",
    """with t as (select *, row_number() over (order by md5(twitter_id || '|5true'), twitter_id) as place from strata where one=1 and stratum='true'),
    o as (select *, row_number() over (order by md5(twitter_id || '|5other'), twitter_id) as place from strata where one=1 and stratum='other'),
    n as (select least(180, count(*)) as n_true from t)
    select twitter_id, handle, stratum, label, reason from t, n where place <= 180
    union all select twitter_id, handle, stratum, label, reason from o, n where place <= 600 - n_true""",
    strata=STRATA,
)
def _(w):
    picked = sampling.stratified_sample(w.profile_scores, w.user_profiles, w.user_stats, seed="5")
    return picked.select("twitter_id", "handle", "stratum", "label", "reason")


@catalog.query(
    "k4_large_strata",
    """with n as (select count(*) // 2 as total from user_profiles), t as (select *, row_number() over (order by md5(twitter_id || '|7true'), twitter_id) as place from strata where one=1 and stratum='true'),
    o as (select *, row_number() over (order by md5(twitter_id || '|7other'), twitter_id) as place from strata where one=1 and stratum='other'),
    m as (select least(cast(floor(total * 0.3e0) as bigint), (select count(*) from t)) as n_true, total from n)
    select twitter_id, handle, stratum, label, reason from t, m where place <= n_true
    union all select twitter_id, handle, stratum, label, reason from o, m where place <= total - n_true""",
    strata=STRATA.replace("|5'", "|7'"),
)
def _(w):
    picked = sampling.stratified_sample(w.profile_scores, w.user_profiles, w.user_stats, total=w.user_profiles.count() // 2, seed="7")
    return picked.select("twitter_id", "handle", "stratum", "label", "reason")


@catalog.query("k6_all_pages", "select count(*) as accounts, 25 as size, count(*) filter (where bio is null) as no_bio from user_profiles")
def _(w):
    batched = sampling.sharded_batches(w.user_profiles, "twitter_id", 25, 8)
    return batched.agg(
        row_count().alias("accounts"), F.lit(25).alias("size"), F.count(F.when(F.col("bio").isNull(), 1)).alias("no_bio")
    )


@catalog.query(
    "k7_general_sample",
    """select twitter_id, round(final_score + 1e-9, 6) as final_score from (select * from finals where has_llm and not is_curated
    order by md5(twitter_id || '|42'), twitter_id limit 1000) t""",
)
def _(w):
    general = marked(w).filter(F.col("has_llm") & ~F.col("is_curated"))
    picked = sampling.random_sample(general, "twitter_id", 1000, "42")
    return picked.select("twitter_id", r6(F.col("final_score")).alias("final_score"))


@catalog.query(
    "k6_page_sizes",
    """select n // 25 as full_pages, case when n % 25 > 0 then n % 25 end as rest, n as accounts from (select count(*) as n from user_profiles) t""",
)
def _(w):
    # Numbered over all rows by range, so that pages are full but for the last; sizes come from the batches themselves.
    batched = sampling.numbered_batches(w.user_profiles.select("twitter_id"), [F.col("twitter_id")], 25, first=0).withColumnRenamed("batch", "batch_no")
    pages = batched.groupBy("batch_no").agg(row_count().alias("n"), F.countDistinct("twitter_id").alias("ids"), F.max("position").alias("last"))
    good = pages.filter((F.col("n") == F.col("ids")) & (F.col("last") == F.col("n") - 1))
    return good.agg(
        F.count(F.when(F.col("n") == 25, 1)).alias("full_pages"), F.max(F.when(F.col("n") < 25, F.col("n"))).alias("rest"),
        F.sum("n").alias("accounts"),
    )


SHARD_ROWS = 100
SHARDED = f"""select *, cast('0x' || substring(md5(twitter_id), 1, 8) as bigint) % (select greatest(1, (count(*) + {SHARD_ROWS - 1}) // {SHARD_ROWS}) from user_profiles) as shard from user_profiles"""


@catalog.query(
    "b1_sharded_batches",
    """select shard, batch_no, count(*) as size, max(place) as last_position from (select shard, (row_number() over s - 1) // 25 as batch_no, (row_number() over s - 1) % 25 as place
    from sharded window s as (partition by shard order by twitter_id)) t group by 1, 2""",
    sharded=SHARDED,
)
def _(w):
    batched = sampling.sharded_batches(w.user_profiles, "twitter_id", 25, rows_per_shard=SHARD_ROWS)
    return batched.groupBy("shard", "batch_no").agg(row_count().alias("size"), F.max("position").alias("last_position"))


@catalog.query(
    "k6_pages_by_shard",
    """select twitter_id, shard, (row_number() over s - 1) // 25 as batch_no, (row_number() over s - 1) % 25 as position from sharded
    window s as (partition by shard order by twitter_id)""",
    sharded=SHARDED,
)
def _(w):
    return sampling.sharded_batches(w.user_profiles.select("twitter_id"), "twitter_id", 25, rows_per_shard=SHARD_ROWS)


@catalog.query(
    "b2_numbered_batches",
    """select twitter_id, 1 + cast(floor((rn-1)/30) as bigint) as batch, (rn-1)%30 as position from
    (select twitter_id, row_number() over (order by followers desc, twitter_id) as rn from user_stats) t""",
)
def _(w):
    order = [F.col("followers").desc(), F.col("twitter_id")]
    return sampling.numbered_batches(w.user_stats.select("twitter_id", "followers"), order, 30).drop("followers")


@catalog.query("b3_model_gate")
def _(w):
    runs = w.searches.select(F.concat_ws("/", "keyword", F.col("page").cast("string")).alias("run_id"))
    tried = sampling.model_gate(runs)
    return tried.groupBy("model").agg(F.avg(F.col("takes_part").cast("double")).alias("share"), row_count().alias("runs"))


PICK = """from user_profiles p left join user_stats s using (twitter_id) where p.bio<>''
 and twitter_id in (select twitter_id from profile_scores)
 and twitter_id not in (select twitter_id from user_keywords where keyword='@customers')"""


@catalog.query(
    "b4_hand_pick",
    f"select twitter_id, handle, name, bio, category, coalesce(followers, 0) as followers {PICK} order by handle limit 600",
)
def _(w):
    return sampling.hand_pick(w.profile_scores, w.user_profiles, w.user_stats, w.user_keywords, CURATED)


@catalog.query(
    "s13_master_lines",
    f"select '  ' || handle || ', null, \"\"' as value from (select handle {PICK} order by handle limit 600) t",
)
def _(w):
    return exports.master_lines(
        sampling.hand_pick(w.profile_scores, w.user_profiles, w.user_stats, w.user_keywords, CURATED)
    )


@catalog.query(
    "s13_master_file",
    f"select '  ' || handle || ', null, \"\"' as value from (select handle {PICK} order by handle limit 600) t",
)
def _(w):
    path = scratch_path(w.spark, "master")
    exports.master_lines(sampling.hand_pick(w.profile_scores, w.user_profiles, w.user_stats, w.user_keywords, CURATED)).write.text(path)
    return w.spark.read.text(path)


ONE_LINE = "regexp_replace(coalesce({0}, ''), '[' || chr(10) || chr(13) || ']+', ' ', 'g')"


@catalog.query(
    "s3_lead_files",
    f"""select p.handle as username, {trim_sql("regexp_replace(" + trim_sql(ONE_LINE.format('p.bio')) + ", '^\"|\"$', '', 'g')")} as bio,
    s.followers, coalesce(p.human_score, 0e0) as score, p.category as tags from profiles p join user_stats s using (twitter_id)""",
)
def _(w):
    path = scratch_path(w.spark, "leads")
    line = F.regexp_replace(F.coalesce("bio", F.lit("")), "[\n\r]+", " ")
    rows = w.profiles.join(w.user_stats.select("twitter_id", "followers"), "twitter_id").select(
        "handle", line.alias("bio"), F.col("followers").cast("string"), F.col("human_score").cast("string"),
        "category", F.lit("").alias("rationale"),
    )
    delimited.write_lines(rows, path, [c.upper() for c in delimited.LEAD_COLUMNS])
    return delimited.read_leads(w.spark, path).drop("rationale")


@catalog.query(
    "s6_handle_lists",
    "select handle from user_profiles where cast(twitter_id as bigint)%5<>0",
)
def _(w):
    path = scratch_path(w.spark, "handles")
    k = F.col("twitter_id").cast("bigint")
    line = F.when(k % 10 == 0, F.concat(F.lit("# "), "handle")).when(k % 5 == 0, F.lit("   "))
    w.user_profiles.select(line.otherwise(F.concat(F.lit("  "), "handle", F.lit(" "))).alias("value")).write.text(path)
    return delimited.read_handles(w.spark, path)


@catalog.query(
    "s14_hand_labels",
    """select lower(p.handle) as handle, s.label, s.reason, case when s.label then 'human' when not s.label then 'entity' end as class
    from profile_scores s join user_profiles p using (twitter_id) where s.scored_by='model-a'""",
)
def _(w):
    path = scratch_path(w.spark, "progress")
    own = w.profile_scores.filter(F.col("scored_by") == "model-a").join(w.user_profiles, "twitter_id")
    kind = F.when(F.col("label"), "human").when(~F.col("label"), "entity")
    delimited.write_progress(own.select("handle", "label", "reason", kind.alias("class")), path)
    return delimited.read_progress(w.spark, path)


@catalog.query(
    "s14_all_hand_labels",
    """select s.scored_by, lower(p.handle) as handle, s.label, s.reason, case when s.label then 'human' when not s.label then 'entity' end as class
    from profile_scores s join user_profiles p using (twitter_id)""",
)
def _(w):
    """A store per model, written and read back."""
    path = scratch_path(w.spark, "progress")
    kind = F.when(F.col("label"), "human").when(~F.col("label"), "entity")
    rows = w.once(w.profile_scores.join(w.user_profiles, "twitter_id").select("scored_by", "handle", "label", "reason", kind.alias("class")), "labelled")
    parts = []
    for model in ("model-a", "model-b", "model-c"):
        delimited.write_progress(rows.filter(F.col("scored_by") == model), f"{path}/{model}")
        parts.append(delimited.read_progress(w.spark, f"{path}/{model}").withColumn("scored_by", F.lit(model)))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def batch_profiles(w: Workspace) -> DataFrame:
    full = lookups.with_followers(w.user_profiles.filter(F.col("bio").isNotNull()), w.user_stats)
    rows = full.select("twitter_id", "handle", "name", "bio", "category", "followers")
    return sampling.numbered_batches(rows, [F.col("followers").desc(), F.col("handle")], 30)


BATCHES = """select *, 1 + cast(floor((rn-1)/30) as bigint) as batch_no, (rn-1)%30 as position from (
  select p.twitter_id, p.handle, p.name, p.bio, p.category, coalesce(s.followers, 0) as followers,
  row_number() over (order by coalesce(s.followers, 0) desc, p.handle) as rn
  from user_profiles p left join user_stats s using (twitter_id) where p.bio is not null) t"""


@catalog.query(
    "s4_batch_tables",
    f"select batch_no, handle, name, {trim_sql(ONE_LINE.format('bio'))} as bio, category, followers from batches",
    batches=BATCHES,
)
def _(w):
    path = scratch_path(w.spark, "batches")
    texts = batch_files.batch_text(batch_files.by_folder(batch_profiles(w)), ["folder", "batch"], "position")
    batch_files.write_batches(texts, path)
    return batch_files.read_batches(w.spark, path)


ALL_BATCHES = BATCHES.replace(" where p.bio is not null", "").replace("p.bio,", "coalesce(p.bio, '') as bio,")


def all_batch_profiles(w: Workspace) -> DataFrame:
    """Batches of all accounts; one without a bio has an empty one."""
    full = lookups.with_followers(w.user_profiles.withColumn("bio", F.coalesce("bio", F.lit(""))), w.user_stats)
    rows = full.select("twitter_id", "handle", "name", "bio", "category", "followers")
    return sampling.numbered_batches(rows, [F.col("followers").desc(), F.col("handle")], 30)


@catalog.query(
    "s4_whole_tables",
    f"select batch_no, handle, name, {trim_sql(ONE_LINE.format('bio'))} as bio, category, followers from batches",
    batches=ALL_BATCHES,
)
def _(w):
    path = scratch_path(w.spark, "whole-batches")
    batch_files.write_batches(batch_files.batch_text(batch_files.by_folder(all_batch_profiles(w)), ["folder", "batch"], "position"), path)
    # An empty cell is read as a missing value.
    return batch_files.read_batches(w.spark, path).withColumn("bio", F.coalesce("bio", F.lit("")))


def dialect_files(w: Workspace) -> str:
    """All batches as files of three dialects by number: padded commas, plain names over commas, tabs. Every tenth declares a row too many."""
    rows = w.once(all_batch_profiles(w), "all-batches")
    padded, plain, tabs = (batch_files.profile_line(indent, sep) for indent, sep in (("  ", ", "), ("", ","), ("  ", "\t")))
    dialect = F.col("batch") % 3
    line = F.when(dialect == 0, padded).when(dialect == 1, plain).otherwise(tabs)
    n = F.size("rows") + F.when(F.col("batch") % 10 == 9, 1).otherwise(0)
    head = F.when(dialect == 1, F.lit("handle,name,bio,category,followers")).otherwise(batch_files.header_line(n, "customers"))
    # A batch holds at most 30 rows.
    packed = batch_files.by_folder(rows).groupBy("folder", "batch").agg(F.array_sort(F.collect_list(F.struct("position", line.alias("line")))).alias("rows"))
    texts = packed.select("folder", "batch", F.concat_ws("\n", head, F.transform("rows", lambda r: r["line"])).alias("text"))
    path = scratch_path(w.spark, "dialects")
    batch_files.write_batches(texts, path)
    return path


@catalog.query(
    "s4_dialect_tables",
    f"""select batch_no, handle, name, {trim_sql(ONE_LINE.format('bio'))} as bio, category, followers from batches where batch_no % 10 <> 9 or batch_no % 3 = 1""",
    batches=ALL_BATCHES,
)
def _(w):
    return batch_files.read_tables(w.spark, dialect_files(w))[0]


@catalog.query(
    "s4_refused_tables",
    """select batch_no, count(*) + 1 as declared, count(*) as found, 'row count' as reason from batches where batch_no % 10 = 9 and batch_no % 3 <> 1 group by 1""",
    batches=ALL_BATCHES,
)
def _(w):
    return batch_files.read_tables(w.spark, dialect_files(w))[1].drop("file")


@catalog.query(
    "j9_label_files",
    """select b.batch_no, b.handle, s.scored_by, case when s.scored_by = 'model-b' then not s.label else s.label end as label, s.reason
    from batches b join profile_scores s using (twitter_id)""",
    batches=ALL_BATCHES,
)
def _(w):
    """Label files of all batches and models through the reader; in those of one model every handle stands twice and the last label counts."""
    placed = w.once(all_batch_profiles(w), "all-batches")
    rows = placed.join(w.profile_scores.select("twitter_id", "scored_by", "label", "reason"), "twitter_id").withColumn("handle", F.upper("handle"))
    again = rows.filter("scored_by = 'model-b'").withColumns({"position": F.col("position") + 1000, "label": ~F.col("label")})
    texts = batch_files.label_json(batch_files.by_folder(rows.unionByName(again)), ["folder", "batch", "scored_by"], "position")
    odd = w.spark.createDataFrame([(-1, "model-a", "[{broken"), (-2, "model-a", ""), (-3, "model-a", '{"handle": "x"}')], "batch bigint, scored_by string, text string")
    path = scratch_path(w.spark, "label-files")
    batch_files.write_batches(texts.unionByName(batch_files.by_folder(odd)), path, "scored_by", "batch")
    items = batch_files.read_label_arrays(w.spark, path, "scored_by")
    return lookups.batch_labels(placed.select(F.col("batch").alias("batch_no"), "handle"), items, "scored_by")


def labelled_batches(w: Workspace) -> DataFrame:
    own = w.profile_scores.filter(F.col("scored_by") == "model-a").select("twitter_id", "label", "reason")
    return batch_profiles(w).join(own, "twitter_id")


@catalog.query(
    "s5_label_arrays",
    """select batch_no, handle, label, reason from batches join (select * from profile_scores where scored_by='model-a') s
    using (twitter_id)""",
    batches=BATCHES,
)
def _(w):
    texts = batch_files.label_json(labelled_batches(w), ["batch"], "position")
    parsed = texts.select(
        F.col("batch").alias("batch_no"), F.explode(F.from_json("text", batch_files.LABEL_ITEMS_DDL)).alias("item")
    )
    return parsed.select("batch_no", "item.handle", "item.label", "item.reason")


@catalog.query(
    "s5_label_files",
    """select b.batch_no, s.scored_by, b.handle, s.label, s.reason from batches b join profile_scores s using (twitter_id)""",
    batches=BATCHES.replace(" where p.bio is not null", ""),
)
def _(w):
    # All labels of all accounts, bio or not, as one file per batch and model; beside them a broken and an empty one.
    rows = lookups.with_followers(w.user_profiles, w.user_stats).select("twitter_id", "handle", "followers")
    placed = sampling.numbered_batches(rows, [F.col("followers").desc(), F.col("handle")], 30)
    keyed = placed.join(w.profile_scores.select("twitter_id", "scored_by", "label", "reason"), "twitter_id")
    texts = batch_files.label_json(batch_files.by_folder(keyed), ["folder", "batch", "scored_by"], "position")
    path = scratch_path(w.spark, "label-files")
    odd = w.spark.createDataFrame([(-1, "model-a", "[{broken"), (-2, "model-a", "")], "batch bigint, scored_by string, text string")
    # A model's folder holds many batches, so that there are fewer folders than with a batch's holding three models.
    batch_files.write_batches(texts.unionByName(batch_files.by_folder(odd)), path, "scored_by", "batch")
    found = w.spark.read.option("wholetext", True).schema("value string, batch bigint, scored_by string").text(path)
    items = F.explode(F.from_json(F.trim("value"), batch_files.LABEL_ITEMS_DDL, {"mode": "PERMISSIVE"})).alias("item")
    parsed = found.select(F.col("batch").alias("batch_no"), "scored_by", items).filter("batch_no >= 0")
    return parsed.select("batch_no", "scored_by", "item.handle", "item.label", "item.reason")


@catalog.query(
    "s10_profile_set_lines",
    """select 'Brand#1' as keyword, '[' || count(*) || ']{handle,name,bio,category,followers}:' as head, count(*) as n
    from user_keywords join user_profiles using (twitter_id) where keyword='Brand#1' and bio<>''""",
)
def _(w):
    rows = lookups.keyword_work_list(
        w.user_profiles, w.user_stats, w.user_keywords, w.profile_scores, "Brand#1", limit=None
    )
    path = scratch_path(w.spark, "sets")
    batch_files.write_profile_sets(batch_files.profile_set_lines(rows, F.lit("Brand#1")), path)
    lines = w.spark.read.text(path).select("keyword", "value")
    is_head = F.col("value").startswith("[")
    return lines.groupBy("keyword").agg(
        F.max(F.when(is_head, F.col("value"))).alias("head"), F.count(F.when(~is_head, 1)).alias("n")
    )


SET_ROWS = f"""select keyword, handle, coalesce(followers, 0) as followers, '  ' || {cell_sql("handle")} || ',' || {cell_sql("name")} || ',' || {cell_sql("bio")} || ',' ||
 coalesce({cell_sql("category")}, 'null') || ',' || coalesce(followers, 0) as line from user_keywords join user_profiles using (twitter_id) left join user_stats using (twitter_id) where bio<>''"""


@catalog.query(
    "s10_ordered_sets",
    """select keyword, place, md5(line) as line from (select keyword, row_number() over (partition by keyword order by followers desc, handle) as place, line from set_rows
    union all select keyword, 0, '[' || count(*) || ']{handle,name,bio,category,followers}:' from set_rows group by keyword) t""",
    set_rows=SET_ROWS,
)
def _(w):
    """The sets of all keywords, most followers first, read back in the order in which lines stand in the files."""
    # An account has each keyword once, so what is collected for one is bounded by the number of sets.
    found = w.user_keywords.groupBy("twitter_id").agg(F.collect_list(F.struct("keyword")).alias("hits"))
    # All joins are by the same key, so that the bios move once; those without an account stay where they are if the keys are few enough to broadcast.
    keys = w.raw("customer").select(F.col("c_custkey").cast("string").alias("twitter_id"))
    bios = w.bios.filter("bio <> ''").select(F.col("doc_id").cast("string").alias("twitter_id"), "bio").join(keys, "twitter_id", "left_semi")
    rows = lookups.with_followers(w.accounts.join(bios, "twitter_id"), w.user_stats).join(found, "twitter_id")
    lines = w.once(batch_files.shared_set_lines(rows, F.col("hits.keyword")), "set-lines")
    # Each set holds the whole text of its accounts, about twenty times that in all sets. They are only read back, so not all are there at once.
    return batch_files.read_back_sets(lines, scratch_path(w.spark, "sets"), {"line": F.md5("value")}, compression="gzip")


@catalog.query(
    "s11_batch_files",
    "select batch_no as batch, count(*) as size, sum(followers)::bigint as followers from batches group by 1",
    batches=BATCHES,
)
def _(w):
    texts = batch_files.batch_text(batch_profiles(w), ["batch"], "position")
    lines = texts.select("batch", "size", F.explode(F.split("text", "\n")).alias("line")).filter(~F.col("line").startswith("["))
    followers = F.regexp_extract("line", r",(\d+)$", 1).cast("bigint")
    return lines.groupBy("batch").agg(F.max("size").alias("size"), F.sum(followers).alias("followers"))


@catalog.query(
    "s11_batch_lines",
    "select batch_no as batch, count(*) as size, sum(followers)::bigint as followers from batches group by 1",
    batches=BATCHES.replace(" where p.bio is not null", ""),
)
def _(w):
    full = lookups.with_followers(w.user_profiles, w.user_stats).select("twitter_id", "handle", "name", "bio", "category", "followers")
    placed = sampling.numbered_batches(full, [F.col("followers").desc(), F.col("handle")], 30)
    path = scratch_path(w.spark, "batch-lines")
    batch_files.write_batch_lines(batch_files.batch_text(placed, ["batch"], "position"), path)
    read = w.spark.read.schema("batch bigint, size bigint, text string").json(path)
    lines = read.select("batch", "size", F.explode(F.split("text", "\n")).alias("line")).filter(~F.col("line").startswith("["))
    return lines.groupBy("batch").agg(F.max("size").alias("size"), F.sum(F.regexp_extract("line", r",(\d+)$", 1).cast("bigint")).alias("followers"))


@catalog.query(
    "s11_batch_cells",
    f"select batch_no, position, handle, name, {trim_sql(ONE_LINE.format('bio'))} as bio, category, followers from batches",
    batches=ALL_BATCHES,
)
def _(w):
    """Many batches to a file, every cell compared."""
    path = scratch_path(w.spark, "batch-lines")
    batch_files.write_batch_lines(batch_files.batch_text(all_batch_profiles(w), ["batch"], "position"), path)
    return batch_files.read_batch_lines(w.spark, path)


@catalog.query(
    "j9_batch_labels",
    """select b.batch_no, b.handle, s.label, s.reason from batches b join profile_scores s using (twitter_id)
    where s.scored_by='model-a'""",
    batches=BATCHES,
)
def _(w):
    texts = batch_files.label_json(labelled_batches(w), ["batch"], "position")
    items = texts.select(
        F.col("batch").alias("batch_no"),
        F.posexplode(F.from_json("text", batch_files.LABEL_ITEMS_DDL)).alias("pos", "item"),
    ).select("batch_no", "pos", F.upper("item.handle").alias("handle"), "item.label", "item.reason")
    profiles = batch_profiles(w).select(F.col("batch").alias("batch_no"), "handle")
    return lookups.batch_labels(profiles, items)


@catalog.query(
    "j9_whole_labels",
    """select b.batch_no, b.handle, s.scored_by, s.label, s.reason from batches b join profile_scores s using (twitter_id)""",
    batches=ALL_BATCHES,
)
def _(w):
    placed = all_batch_profiles(w)
    labels = w.profile_scores.select("twitter_id", "scored_by", "label", "reason")
    texts = batch_files.label_json(placed.join(labels, "twitter_id"), ["batch", "scored_by"], "position")
    items = texts.select(
        F.col("batch").alias("batch_no"), "scored_by", F.posexplode(F.from_json("text", batch_files.LABEL_ITEMS_DDL)).alias("pos", "item")
    ).select("batch_no", "scored_by", "pos", F.upper("item.handle").alias("handle"), "item.label", "item.reason")
    return lookups.batch_labels(placed.select(F.col("batch").alias("batch_no"), "handle"), items, "scored_by")


# --- sets and arrays ---------------------------------------------------------------------------------

@catalog.query(
    "z1_concatenate",
    """select 'curated' as pool, twitter_id from finals where is_curated and has_llm union all
    select 'general', twitter_id from (select twitter_id from finals where has_llm and not is_curated
    order by md5(twitter_id || '|42'), twitter_id limit 100) t""",
)
def _(w):
    scored = marked(w).filter(F.col("has_llm"))
    general = sampling.random_sample(scored.filter(~F.col("is_curated")), "twitter_id", 100, "42")
    tag = lambda df, name: df.select(F.lit(name).alias("pool"), "twitter_id")
    return tag(scored.filter("is_curated"), "curated").unionByName(tag(general, "general"))


@catalog.query(
    "z2_append_keyword",
    """select p.twitter_id, case when k.ks is null then 'Brand#1' when list_contains(k.ks, 'Brand#1') then array_to_string(k.ks, ';')
    else array_to_string(list_append(k.ks, 'Brand#1'), ';') end as keywords from user_profiles p
    left join (select twitter_id, list(keyword order by keyword) as ks from user_keywords
      where keyword<>'Brand#1' or cast(twitter_id as bigint)%2=0 group by 1) k using (twitter_id)""",
)
def _(w):
    kept = w.user_keywords.filter((F.col("keyword") != "Brand#1") | (F.col("twitter_id").cast("bigint") % 2 == 0))
    sets = kept.groupBy("twitter_id").agg(F.array_sort(F.collect_set("keyword")).alias("ks"))
    joined = w.user_profiles.select("twitter_id").join(sets, "twitter_id", "left")
    grown = merges.append_once(F.col("ks"), F.array(F.lit("Brand#1")))
    return joined.select("twitter_id", F.array_join(grown, ";").alias("keywords"))


@catalog.query(
    "z3_membership",
    """select twitter_id, bool_or(keyword='Brand#1') as has_word from user_keywords
    where twitter_id in (select twitter_id from profile_scores) group by 1""",
)
def _(w):
    rows = lookups.labelled_at_all(w.user_keywords, w.profile_scores)
    sets = rows.groupBy("twitter_id").agg(F.collect_set("keyword").alias("ks"))
    return sets.select("twitter_id", F.array_contains("ks", "Brand#1").alias("has_word"))


@catalog.query(
    "z4_union_of_names",
    """select coalesce(a.name, b.name) as name, coalesce(a.n, 0) as old_count, coalesce(b.n, 0) as new_count from
    (select likely_is as name, count(*) as n from scores where human_score > 0.6 group by 1) a full outer join
    (select likely_is as name, count(*) as n from scores where human_score < 0.4 group by 1) b using (name)""",
)
def _(w):
    counted = lambda df, name: df.groupBy(F.col("likely_is").alias("name")).agg(row_count().alias(name))
    old = counted(w.scores.filter(F.col("human_score") > 0.6), "old_count")
    new = counted(w.scores.filter(F.col("human_score") < 0.4), "new_count")
    joined = old.join(new, "name", "full")
    return joined.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("old_count", "new_count")})


# --- merges ------------------------------------------------------------------------------------------

def stored_profiles(w: Workspace) -> DataFrame:
    """Two thirds of the accounts, with the keywords found before 1998."""
    early = w.user_keywords.filter(F.col("added_at") < F.lit("1998-01-01 00:00:00").cast("timestamp_ntz"))
    sets = early.groupBy("twitter_id").agg(F.array_sort(F.collect_set("keyword")).alias("got_by_keywords"))
    base = w.user_profiles.filter(F.col("twitter_id").cast("bigint") % 3 != 0).select("twitter_id", "handle", "name")
    return base.join(sets, "twitter_id", "left").withColumn("updated_at", F.lit("1998-01-01 00:00:00").cast("timestamp_ntz"))


def incoming_profiles(w: Workspace) -> DataFrame:
    """Later hits on all accounts, with renamed fields."""
    late = w.user_keywords.filter(F.col("added_at") >= F.lit("1998-01-01 00:00:00").cast("timestamp_ntz"))
    named = w.user_profiles.select("twitter_id", "handle", F.concat("name", F.lit(" (new)")).alias("name"))
    return named.join(late, "twitter_id").withColumnRenamed("added_at", "updated_at")


MERGE = {
    "stored": """select p.twitter_id, p.handle, p.name, k.ks from user_profiles p left join (select twitter_id,
      list(keyword order by keyword) as ks from user_keywords where added_at < timestamp '1998-01-01' group by 1) k using (twitter_id)
      where cast(p.twitter_id as bigint)%3<>0""",
    "incoming": """select p.twitter_id, any_value(p.handle) as handle, any_value(p.name || ' (new)') as name,
      list(k.keyword order by k.keyword) as ks, max(k.added_at) as at from user_profiles p join user_keywords k using (twitter_id)
      where k.added_at >= timestamp '1998-01-01' group by 1""",
}
MERGED = """select coalesce(s.twitter_id, i.twitter_id) as twitter_id, coalesce(s.handle, i.handle) as handle, {name} as name,
 case when i.ks is null then array_to_string(s.ks, ';') else array_to_string(list_concat(coalesce(s.ks, []),
  list_filter(i.ks, lambda x: not list_contains(coalesce(s.ks, []), x))), ';') end as keywords,
 coalesce(i.at, timestamp '1998-01-01') as updated_at from stored s full outer join incoming i on s.twitter_id=i.twitter_id"""


@catalog.query("u1_upsert_profiles", MERGED.format(name="coalesce(s.name, i.name)"), **MERGE)
def _(w):
    merged = merges.upsert_profiles(stored_profiles(w), incoming_profiles(w))
    return merged.select("twitter_id", "handle", "name", F.array_join("got_by_keywords", ";").alias("keywords"), "updated_at")


@catalog.query("u1_refresh_profiles", MERGED.format(name="coalesce(i.name, s.name)"), **MERGE)
def _(w):
    merged = merges.upsert_profiles(stored_profiles(w), incoming_profiles(w), refresh=True)
    return merged.select("twitter_id", "handle", "name", F.array_join("got_by_keywords", ";").alias("keywords"), "updated_at")


@catalog.query(
    "u2_upsert_stats",
    """select twitter_id, case when cast(twitter_id as bigint)%3=0 then followers+1 else followers end as followers,
    case when cast(twitter_id as bigint)%3=0 then 2 else 1 end as seq from user_stats""",
)
def _(w):
    stored = w.user_stats.select("twitter_id", "followers", F.lit(1).alias("seq"))
    changed = w.user_stats.filter(F.col("twitter_id").cast("bigint") % 3 == 0)
    first = changed.select("twitter_id", (F.col("followers") + 7).alias("followers"), F.lit(0).alias("seq"))
    second = changed.select("twitter_id", (F.col("followers") + 1).alias("followers"), F.lit(2).alias("seq"))
    return merges.upsert_latest(stored, first.unionByName(second), ["twitter_id"], "seq")


@catalog.query("u3_insert_keywords", "select twitter_id, keyword, added_at from user_keywords")
def _(w):
    half = w.user_keywords.filter(F.length("keyword") % 2 == 0)
    later = w.user_keywords.withColumn("added_at", F.col("added_at") + F.expr("interval 1 day"))
    incoming = w.user_keywords.unionByName(later)
    return merges.insert_absent(half, incoming, ["twitter_id", "keyword"], F.col("added_at"))


@catalog.query(
    "u4_enqueue",
    """select count(*) as queued, count(*) filter (where cast(twitter_id as bigint)%4=0) as added from queue""",
)
def _(w):
    k = F.col("twitter_id").cast("bigint")
    stored = w.queue.filter(k % 4 != 0).withColumn("origin", F.lit("stored"))
    incoming = w.queue.withColumn("origin", F.lit("incoming"))
    merged = merges.insert_absent(stored, incoming, ["twitter_id"], F.col("added_at"))
    return merged.agg(row_count().alias("queued"), F.count(F.when(F.col("origin") == "incoming", 1)).alias("added"))


@catalog.query(
    "u4_queue_rows",
    """select twitter_id, handle, added_at, case when cast(twitter_id as bigint)%4=0 then 'incoming' else 'stored' end as origin from queue""",
)
def _(w):
    k = F.col("twitter_id").cast("bigint")
    stored = w.queue.filter(k % 4 != 0).withColumn("origin", F.lit("stored"))
    return merges.insert_absent(stored, w.queue.withColumn("origin", F.lit("incoming")), ["twitter_id"], F.col("added_at"))


@catalog.query(
    "u5_label_rows",
    """select twitter_id, scored_by, case when scored_by='model-c' then not label else label end as label from profile_scores""",
)
def _(w):
    stored = w.profile_scores.filter(F.col("scored_by") != "model-c")
    incoming = w.profile_scores.withColumn("label", ~F.col("label"))
    merged = merges.insert_absent(stored, incoming, ["twitter_id", "scored_by"], F.col("scored_at"))
    return merged.select("twitter_id", "scored_by", "label")


@catalog.query(
    "u5_insert_labels",
    """select count(*) filter (where scored_by='model-c') as labeled, count(*) filter (where scored_by<>'model-c') as skipped
    from profile_scores""",
)
def _(w):
    stored = w.profile_scores.filter(F.col("scored_by") != "model-c")
    return merges.insert_counts(stored, w.profile_scores, ["twitter_id", "scored_by"])


@catalog.query(
    "u6_upsert_labels",
    """select twitter_id, scored_by, case when scored_by='model-a' then not label else label end as label from profile_scores""",
)
def _(w):
    stored = w.profile_scores.filter(F.col("scored_by") != "model-c")
    flipped = w.profile_scores.filter(F.col("scored_by") == "model-a").withColumn("label", ~F.col("label"))
    incoming = flipped.unionByName(w.profile_scores.filter(F.col("scored_by") == "model-c"))
    merged = merges.upsert_latest(stored, incoming, ["twitter_id", "scored_by"], "scored_at")
    return merged.select("twitter_id", "scored_by", "label")


@catalog.query(
    "u6_upsert_counts",
    """select count(*) filter (where scored_by='model-c') as inserted, count(*) filter (where scored_by='model-a') as updated
    from profile_scores""",
)
def _(w):
    stored = w.profile_scores.filter(F.col("scored_by") != "model-c")
    incoming = w.profile_scores.filter(F.col("scored_by") != "model-b")
    return merges.upsert_counts(stored, incoming, ["twitter_id", "scored_by"])


def pool(w: Workspace) -> DataFrame:
    words = w.user_keywords.filter(F.length("keyword") == 8).select("keyword").distinct()
    return words.select(
        "keyword", F.array(F.lit("#old")).alias("semantic_tags"), F.lit(0).cast("bigint").alias("profiles_found"),
        F.lit("0.500").cast("decimal(4,3)").alias("avg_human_score"), F.lit("0.500").cast("decimal(4,3)").alias("label_rate"),
        F.lit(False).alias("still_valid"),
    )


@catalog.query(
    "u7_upsert_keyword_stats",
    """select keyword, case when length(keyword)=8 then '#old' else '' end as tags, count(*) as profiles_found,
    round(avg(human_score), 3) as avg_human_score from user_keywords join scores using (twitter_id) group by 1""",
)
def _(w):
    grouped = w.user_keywords.join(w.scores, "twitter_id").groupBy("keyword").agg(
        row_count().alias("profiles_found"), F.avg("human_score").alias("avg_human_score")
    )
    fresh = grouped.select(
        "keyword", F.array().cast("array<string>").alias("semantic_tags"), "profiles_found", "avg_human_score",
        F.lit(0.0).alias("label_rate"), F.lit(True).alias("still_valid"),
    )
    merged = merges.upsert_keyword_stats(pool(w), fresh)
    return merged.select(
        "keyword", F.array_join("semantic_tags", ",").alias("tags"), "profiles_found",
        F.col("avg_human_score").cast("double").alias("avg_human_score"),
    )


@catalog.query(
    "u8_add_keywords",
    """select keyword, case when keyword like '%#1%' then '#new' else '#old' end as tags, length(keyword)<>8 as still_valid
    from (select distinct keyword from user_keywords) k where length(keyword)=8 or keyword like '%#1%'""",
)
def _(w):
    new = w.user_keywords.filter(F.col("keyword").contains("#1")).select("keyword").distinct()
    merged = merges.add_keywords(pool(w), new.withColumn("new_tags", F.array(F.lit("#new"))))
    return merged.select("keyword", F.array_join("semantic_tags", ",").alias("tags"), "still_valid")


@catalog.query(
    "u10_load_curated",
    """select w.handle as wanted_handle, p.twitter_id, coalesce(p.human_score, 0e0) as human_score, coalesce(p.likely_is, '-') as likely_is,
    s.followers, case when p.twitter_id is not null then '@customers' end as keyword,
    case when p.twitter_id is not null then 'success' else 'not_found' end as status
    from wanted w left join profiles p on lower(p.handle)=lower(w.handle) left join user_stats s using (twitter_id)""",
    wanted="""select case when c_custkey%3=0 then upper(h) when c_custkey%13=1 then 'no_' || h else h end as handle
      from (select c_custkey, lower(replace(c_name,'#','_')) as h from customer) t""",
)
def _(w):
    stored = w.profiles.join(w.user_stats.select("twitter_id", "followers"), "twitter_id")
    return merges.load_curated(mixed_case_handles(w).select("handle"), stored, CURATED)


# --- quality -----------------------------------------------------------------------------------------

@catalog.query(
    "q1_search_references",
    """select count(*) as total, count(*) filter (where sid is null) as missing,
    count(*) filter (where sid is not null and sid not in (select keyword || '/' || page from searches)) as dangling
    from (select case when cast(twitter_id as bigint)%10=0 then null when cast(twitter_id as bigint)%10=1 then 'x' || keyword
      else keyword || '/0' end as sid from user_keywords where keyword<>'@customers') t""",
)
def _(w):
    k = F.col("twitter_id").cast("bigint") % 10
    sid = F.when(k == 1, F.concat(F.lit("x"), "keyword")).when(k > 1, F.concat("keyword", F.lit("/0")))
    hits = w.user_keywords.filter(F.col("keyword") != CURATED).select(sid.alias("search_id"))
    ids = w.searches.select(F.concat_ws("/", "keyword", F.col("page").cast("string")).alias("id"))
    return quality.search_references(hits, ids)


@catalog.query(
    "q2_new_profile_counts",
    """select count(*) as total, count(*) filter (where new_profiles=0) as zero, count(*) filter (where new_profiles>0) as positive,
    count(*) filter (where new_profiles<0 or new_profiles>items) as out_of_range, round(avg(new_profiles) + 1e-9, 6) as mean,
    max(new_profiles) as maximum from searches""",
)
def _(w):
    return quality.new_profile_counts(w.searches).withColumn("mean", r6(F.col("mean")))


@catalog.query("q3_without_stats", "select twitter_id from user_profiles where twitter_id not in (select twitter_id from user_stats where followers>1000)")
def _(w):
    return quality.without_stats(w.user_profiles.select("twitter_id"), w.user_stats.filter(F.col("followers") > 1000))


@catalog.query(
    "q4_queue_scores",
    """select count(*) as queued, count(*) filter (where human_score<=0.65) as below_gate, min(human_score) as minimum,
    max(human_score) as maximum, round(avg(human_score) + 1e-9, 6) as mean from scores where human_score > 0.65 or likely_is='Creator'""",
)
def _(w):
    loose = w.scores.filter((F.col("human_score") > 0.65) | (F.col("likely_is") == "Creator")).select("twitter_id")
    return quality.queue_scores(loose, w.scores).withColumn("mean", r6(F.col("mean")))


@catalog.query(
    "q6_table_counts",
    """select 'user_profiles' as name, count(*) as n from user_profiles union all select 'user_stats', count(*) from user_stats
    union all select 'user_keywords', count(*) from user_keywords union all select 'profile_scores', count(*) from profile_scores
    union all select 'api_search_usage', count(*) from searches union all select 'profiles_to_score', count(*) from queue""",
)
def _(w):
    return quality.table_counts(
        {"user_profiles": w.user_profiles, "user_stats": w.user_stats, "user_keywords": w.user_keywords,
         "profile_scores": w.profile_scores, "api_search_usage": w.searches, "profiles_to_score": w.queue}
    )


SEVEN = """select 'user_profiles' as name, count(*) as n from user_profiles union all select 'user_stats', count(*) from user_stats
    union all select 'user_keywords', count(*) from user_keywords union all select 'profile_scores', count(*) from profile_scores
    union all select 'api_search_usage', count(*) from searches union all select 'profiles_to_score', count(*) from queue
    union all select 'keyword_stats', count(distinct keyword) from searches"""


def seven_tables(w: Workspace) -> dict[str, DataFrame]:
    # Tables that others are made from are computed once.
    w.user_stats, w.profile_scores = w.once(w.user_stats, "stats"), w.once(w.profile_scores, "labels")
    w.searches = w.once(w.searches, "searches")
    stats = keywords.keyword_stats(w.searches, w.keyword_table, w.scores, w.profile_scores)
    return {
        "user_profiles": w.user_profiles, "user_stats": w.user_stats, "user_keywords": w.keyword_table, "profile_scores": w.profile_scores,
        "api_search_usage": w.searches, "profiles_to_score": w.queue, "keyword_stats": stats,
    }


@catalog.query("q6_seven_tables", SEVEN)
def _(w):
    return quality.table_counts(seven_tables(w))


@catalog.query("s2_seven_tables", SEVEN.replace("count(*) as n", "count(*) as n, count(*) as keys").replace("count(*) from", "count(*), count(*) from").replace("count(distinct keyword) from", "count(distinct keyword), count(distinct keyword) from"))
def _(w):
    """All seven stored and read by their schemas: rows, and rows with a key of their own."""
    root = scratch_path(w.spark, "tables")
    parts = []
    for name, df in seven_tables(w).items():
        df.write.parquet(f"{root}/{name}")
        keys = ["keyword", "page"] if name == "api_search_usage" else UNIQUE_KEYS[name]
        rows = tables.read_table(w.spark, root, name)
        parts.append(rows.agg(row_count().alias("n"), F.count_distinct(F.struct(*keys)).alias("keys")).select(F.lit(name).alias("name"), "n", "keys"))
    return functools.reduce(DataFrame.unionByName, parts)


def leads(w: Workspace) -> DataFrame:
    k = F.col("twitter_id").cast("bigint")
    stored = w.profiles.filter(F.col("human_score").isNotNull()).join(w.user_stats.select("twitter_id", "followers"), "twitter_id")
    return stored.select(
        F.when(k % 13 == 0, F.concat(F.lit("no_"), "handle")).otherwise(F.col("handle")).alias("username"),
        F.lit("").alias("bio"),
        F.when(k % 9 == 0, (F.col("followers") * 1.5).cast("bigint")).otherwise(F.col("followers")).alias("followers"),
        F.when(k % 11 == 0, F.col("human_score") + 0.2).otherwise(F.col("human_score")).alias("score"),
    )


CHECKED = """select l.username as wanted_handle, p.twitter_id, p.can_dm, case when p.twitter_id is null then null else s.followers end as db_followers,
 case when p.twitter_id is null then null else 0.2e0*p.human_score+0.8e0*coalesce(m.avg_llm, 0e0) end as db_score,
 case when p.twitter_id is null then 'not_found'
   when (case when s.followers>0 then abs(l.followers-s.followers)*1e0/s.followers when l.followers>0 then 1 else 0 end) > 0.2 then 'follower_mismatch'
   when abs(l.score-(0.2e0*p.human_score+0.8e0*coalesce(m.avg_llm, 0e0))) > 0.05 then 'score_mismatch' else 'valid' end as status
 from (select case when k%13=0 then 'no_' || handle else handle end as username, case when k%9=0 then cast(trunc(followers*1.5) as bigint) else followers end as followers,
   case when k%11=0 then human_score+0.2e0 else human_score end as score from (select cast(twitter_id as bigint) as k, * from profiles join user_stats using (twitter_id)
   where human_score is not null) t) l
 left join profiles p on p.handle=l.username left join user_stats s using (twitter_id) left join label_means m using (twitter_id)"""


def checked_leads(w: Workspace) -> DataFrame:
    stored = w.profiles.join(w.user_stats.select("twitter_id", "followers"), "twitter_id")
    return quality.validate_leads(leads(w), stored, w.profile_scores)


@catalog.query(
    "q7_validate_leads",
    "select wanted_handle, twitter_id, db_followers, round(db_score + 1e-9, 6) as db_score, status from checked",
    checked=CHECKED,
)
def _(w):
    out = checked_leads(w).withColumn("db_score", r6(F.col("db_score")))
    return out.select("wanted_handle", "twitter_id", "db_followers", "db_score", "status")


@catalog.query(
    "q8_validated_rows",
    """select wanted_handle as username, db_followers as followers, format('{:.4f}', db_score) as score,
    case when can_dm then 'true' else 'false' end as can_dm from checked where status='valid'""",
    checked=CHECKED,
)
def _(w):
    return quality.validated_rows(checked_leads(w))


@catalog.query("q8_status_counts", "select status, count(*) as n from checked group by 1", checked=CHECKED)
def _(w):
    return quality.status_counts(checked_leads(w))


@catalog.query(
    "q9_constraints",
    """select 'duplicate_label' as rule, count(*) as n from (select o_custkey, l_linenumber%3 as m from orders join lineitem on l_orderkey=o_orderkey
      group by 1, 2 having count(*) > 1) t
    union all select 'duplicate_keyword', count(*) from (select twitter_id, keyword from user_keywords group by 1, 2 having count(*) > 1) t
    union all select 'bad_class', count(*) from scores where likely_is not in ('Human','Creator','Entity','Other','Bot')
    union all select 'long_text', count(*) from user_profiles where length(coalesce(bio, '')) > 500 or length(handle) > 50""",
)
def _(w):
    lines = w.raw("orders").join(w.raw("lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
    lines = lines.select(F.col("o_custkey").alias("twitter_id"), (F.col("l_linenumber") % 3).alias("scored_by"))
    return quality.table_counts(
        {
            "duplicate_label": quality.duplicate_keys(lines, UNIQUE_KEYS["profile_scores"]),
            "duplicate_keyword": quality.duplicate_keys(w.user_keywords, UNIQUE_KEYS["user_keywords"]),
            "bad_class": quality.bad_classes(w.scores),
            "long_text": quality.too_long(w.user_profiles, {"bio": 500, "handle": 50}),
        }
    ).withColumnRenamed("name", "rule")


@catalog.query(
    "q10_quarantine",
    """select reject_reason, count(*) as n from (select case when twitter_id<>min(twitter_id) over (partition by h) then 'handle_taken'
      when created_at is null then 'bad_created_at' end as reject_reason from (select twitter_id, created_at,
      case when cast(twitter_id as bigint)%50=1 then 'shared_' || cast(twitter_id as bigint)%400 else handle end as h
      from user_profiles join user_stats using (twitter_id)) t) u group by 1""",
)
def _(w):
    k = F.col("twitter_id").cast("bigint")
    shared = F.when(k % 50 == 1, F.concat(F.lit("shared_"), (k % 400).cast("string"))).otherwise(F.col("handle"))
    rows = w.user_profiles.join(w.user_stats.select("twitter_id", "created_at"), "twitter_id").withColumn("handle", shared)
    return quality.quarantine(rows).groupBy("reject_reason").agg(row_count().alias("n"))
