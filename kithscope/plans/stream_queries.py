"""Streaming queries. Each runs over everything that is there, stops, and returns what it wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from kithscope.functions.numbers import row_count
from kithscope.operators import history
from kithscope.operators.merges import curated_totals
from kithscope.plans.account_queries import raw_users
from kithscope.plans.catalog import Catalog
from kithscope.plans.evaluation_queries import HISTORY, label_history
from kithscope.plans.relation_queries import mixed_case_handles
from kithscope.plans.workspace import CURATED, Workspace
from kithscope.schemas import GIVEN_TABLES
from kithscope.session import scratch_path
from kithscope.streaming import ingest, jobs, windows

catalog = Catalog()


def event_stream(w: Workspace) -> DataFrame:
    """The events file as a stream of keyword hits."""
    rows = w.spark.readStream.schema(GIVEN_TABLES["events"]).option("pathGlobFilter", "events.parquet").parquet(w.sf_dir)
    return rows.select(
        F.col("user_id").cast("string").alias("twitter_id"), F.col("event_type").alias("keyword"),
        F.col("ts").cast("timestamp").alias("seen_at"), F.col("event_id").alias("seq"),
    )


def run_to_table(w: Workspace, writer: DataStreamWriter, label: str, schema: str) -> DataFrame:
    path, state = scratch_path(w.spark, label), scratch_path(w.spark, f"{label}-state")
    query = writer.format("parquet").option("path", path).option("checkpointLocation", state).trigger(availableNow=True).start()
    query.awaitTermination()
    return w.spark.read.schema(schema).parquet(path)


@catalog.query("t2_drop_repeats", "select distinct cast(user_id as varchar) as twitter_id, event_type as keyword from events")
def _(w):
    unique = windows.drop_repeats(event_stream(w), "seen_at", "60 days")
    stored = run_to_table(w, unique.writeStream, "repeats", windows.HIT)
    return stored.select("twitter_id", "keyword")


PART = "(epoch_us(ts) - (select min(epoch_us(ts)) from events)) // greatest(1, (select (max(epoch_us(ts)) - min(epoch_us(ts))) // 4 + 1 from events))"


def quarters(w: Workspace) -> DataFrame:
    """Events as hits with ``part``, the quarter of the whole time they lie in."""
    rows = w.raw("events").select(
        F.col("user_id").cast("string").alias("twitter_id"), F.col("event_type").alias("keyword"), F.col("ts").cast("timestamp").alias("seen_at"),
        F.col("event_id").alias("seq"),
    )
    ends = rows.agg(F.unix_micros(F.min("seen_at")).alias("lo"), F.unix_micros(F.max("seen_at")).alias("hi")).first()
    width = max(1, (ends["hi"] - ends["lo"]) // 4 + 1)
    return rows.withColumn("part", F.expr(f"(unix_micros(seen_at) - {ends['lo']}) div {width}"))


def deliver(w: Workspace, start, label: str, deliveries: list[DataFrame], schema: str = windows.HIT) -> str:
    """Runs a stream over deliveries that land one after the other, each written by as many tasks as its rows have.

    ``start`` (stream, folder of results, checkpoint) gives a stream writer. The stream stops after every delivery and goes on from its
    checkpoint with the next, so each is a micro-batch of its own.
    """
    landing, out, state = (scratch_path(w.spark, f"{label}-{kind}") for kind in ("landing", "out", "state"))
    for k, rows in enumerate(deliveries):
        rows.write.parquet(f"{landing}/{k}")
        stream = w.spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(landing)
        start(stream, out, state).trigger(availableNow=True).start().awaitTermination()
    return out


def as_delivered(w: Workspace, order: list[int]) -> list[DataFrame]:
    rows = quarters(w)
    return [rows.filter(F.col("part") == k).drop("part") for k in order]


@catalog.query("t2_repeats_over_batches", "select distinct cast(user_id as varchar) as twitter_id, event_type as keyword from events")
def _(w):
    def start(stream, out, state):
        unique = windows.drop_repeats(stream, "seen_at", "3650 days")
        return unique.writeStream.format("parquet").option("path", out).option("checkpointLocation", state)

    # The first delivery comes twice.
    out = deliver(w, start, "repeats", as_delivered(w, [0, 1, 2, 3, 0]))
    return w.spark.read.schema(windows.HIT).parquet(out).select("twitter_id", "keyword")


FIRSTS = """select cast(user_id as varchar) as twitter_id, event_type as keyword, event_id as seq from (select *,
    row_number() over (partition by user_id order by ts, event_id) as seen from events) t where seen=1"""


@catalog.query("t3_firsts_over_batches", FIRSTS)
def _(w):
    out = deliver(w, windows.follow_firsts, "firsts", as_delivered(w, [0, 1, 2, 3, 0]))
    return windows.read_firsts(w.spark, out).select("twitter_id", "keyword", "seq")


@catalog.query("t3_firsts_in_any_order", FIRSTS)
def _(w):
    out = deliver(w, windows.follow_firsts, "firsts", as_delivered(w, [2, 3, 1, 2, 0]))
    return windows.read_firsts(w.spark, out).select("twitter_id", "keyword", "seq")


@catalog.query(
    "t3_first_seen_again",
    """with gaps as (select *, ts - lag(ts) over (partition by user_id order by ts, event_id) as gap from events),
    runs as (select *, sum(case when gap is null or gap > interval 8 hours then 1 else 0 end) over (partition by user_id order by ts, event_id) as run from gaps),
    firsts as (select *, row_number() over (partition by user_id, run order by ts, event_id) as rn, count(*) over (partition by user_id, run) as hits,
      max(ts) over (partition by user_id, run) + interval 8 hours as until from runs)
    select cast(user_id as varchar) as twitter_id, event_type as keyword, event_id as seq, hits, until from firsts
    where rn = 1 and until <= (select max(ts) from events) - interval 1 day""",
)
def _(w):
    def start(stream, out, state):
        firsts = windows.first_seen_sessions(stream, "8 hours", "1 day")
        return firsts.writeStream.format("parquet").outputMode("append").option("path", out).option("checkpointLocation", state)

    out = deliver(w, start, "sessions", as_delivered(w, [0, 1, 2, 3]))
    rows = w.spark.read.schema(f"{windows.HIT}, hits bigint, until timestamp").parquet(out)
    return rows.select("twitter_id", "keyword", "seq", "hits", F.col("until").cast("timestamp_ntz").alias("until"))


@catalog.query(
    "t3_first_seen",
    """select keyword, d, count(*) as new_profiles from (select event_type as keyword, date_trunc('day', ts) as d,
    row_number() over (partition by user_id order by ts, event_id) as seen from events) t where seen=1 group by 1, 2""",
)
def _(w):
    seen = run_to_table(w, windows.first_seen_stream(event_stream(w)).writeStream.outputMode("append"), "first", windows.HIT)
    day = F.date_trunc("day", "seen_at").cast("timestamp_ntz")
    return seen.groupBy("keyword", day.alias("d")).agg(row_count().alias("new_profiles"))


WINDOWS = """select w as window_start, w + interval {days} days as window_end, event_type as keyword, count(*) as searches,
 cast(sum(event_id % 3) as bigint) as new_profiles from (select *, unnest(range(0, {days})) as back from events) e,
 lateral (select date_trunc('day', ts) - back * interval 1 day as w) x
 where w + interval {days} days <= (select max(ts) from events) - interval 1 day group by 1, 2, 3"""


def windowed(w: Workspace, days: int) -> DataFrame:
    rows = event_stream(w).select("keyword", F.col("seen_at").alias("query_at"), (F.col("seq") % 3).alias("new_profiles"))
    out = windows.yield_by_window(rows, f"{days} days", "1 day", "1 day")
    schema = "window_start timestamp, window_end timestamp, keyword string, searches bigint, new_profiles bigint"
    stored = run_to_table(w, out.writeStream.outputMode("append"), f"yield{days}", schema)
    return stored.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


@catalog.query("t4_daily_yield", WINDOWS.format(days=1))
def _(w):
    return windowed(w, 1)


@catalog.query("t4_weekly_yield", WINDOWS.format(days=7))
def _(w):
    return windowed(w, 7)


SEARCH = "seq bigint, keyword string, query_at timestamp, new_profiles bigint"
# Every fiftieth row of the first quarter, and every hundredth of the third, lands only before the last quarter.
HELD_BACK = "((part = 0 and event_id % 50 = 0) or (part = 2 and event_id % 100 = 1))"
LATE_VIEWS = {
    "parts": f"select *, {PART} as part from events",
    "held": f"select *, {HELD_BACK} as back from parts",
    "lates": """select *, back and ts < (select max(ts) from held where part < 3 and not back) - interval 1 day as is_late from held""",
}


def followed_yield(w: Workspace, length: str) -> str:
    rows = quarters(w).select("part", "seq", "keyword", F.col("seen_at").alias("query_at"), (F.col("seq") % 3).alias("new_profiles"))
    back = F.expr(HELD_BACK.replace("event_id", "seq"))
    given = [rows.filter((F.col("part") == k) & ~back) for k in range(3)] + [rows.filter(back), rows.filter("part = 3")]
    follow = lambda stream, out, state: windows.follow_yield(stream, out, state, length, "1 day", "1 day")
    return deliver(w, follow, "yield", [df.drop("part") for df in given], SEARCH)


@catalog.query(
    "t4_late_rows",
    "select event_id as seq, event_type as keyword, ts as query_at, event_id % 3 as new_profiles from lates where is_late",
    **LATE_VIEWS,
)
def _(w):
    rows = windows.read_late(w.spark, followed_yield(w, "7 days"), SEARCH)
    return rows.select("seq", "keyword", F.col("query_at").cast("timestamp_ntz").alias("query_at"), "new_profiles")


@catalog.query(
    "t4_yield_over_batches",
    """select w as window_start, w + interval 7 days as window_end, event_type as keyword, count(*) as searches, cast(sum(event_id % 3) as bigint) as new_profiles,
    w + interval 7 days <= (select max(ts) from events) - interval 1 day as closed from (select *, unnest(range(0, 7)) as back_days from lates where not is_late) e,
    lateral (select date_trunc('day', ts) - back_days * interval 1 day as w) x group by 1, 2, 3""",
    **LATE_VIEWS,
)
def _(w):
    rows = windows.read_yield(w.spark, followed_yield(w, "7 days"))
    return rows.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


@catalog.query(
    "t4_rows_in_and_out",
    "select count(*) as rows_in, count(*) filter (where not is_late) as in_windows, count(*) filter (where is_late) as late from lates",
    **LATE_VIEWS,
)
def _(w):
    """Windows of one day hold each row once, so rows in are rows in windows and late ones."""
    path = followed_yield(w, "1 day")
    held = windows.read_yield(w.spark, path).agg(F.sum("searches").alias("in_windows"))
    late = windows.read_late(w.spark, path, SEARCH).agg(row_count().alias("late"))
    marks = w.spark.read.schema(windows.MARK).parquet(f"{path}/marks").agg(F.sum("n_rows").alias("rows_in"))
    one = F.lit(1).alias("k")
    return marks.select("*", one).join(held.select("*", one), "k").join(late.select("*", one), "k").drop("k")


ODD_USERS = [("900000001", None), ("900000002", "taken"), ("900000003", "taken"), ("90000001", "taken")]


def landed_pages(w: Workspace, files: int | None = None) -> str:
    """Search pages of all accounts as JSON lines: a keyword per market segment, 20 accounts a page. For each
    keyword also page 0 from a second platform, again, without keyword, without time, a broken line and the empty page that
    ends it; and a page with accounts that must be rejected. In several files: as many as asked for, else those of the tasks that make the pages, as gzip."""
    users = raw_users(w).withColumn("keyword", F.col("user.professional.category")[0]["name"])
    ranked = F.array_sort(F.collect_list(F.struct("k", "user")))
    # Twenty consecutive ids form a page, so what is collected for one is bounded.
    pages = users.groupBy("keyword", "page").agg(ranked.alias("rows")).select(
        "keyword", "page", F.timestamp_seconds(F.lit(1_000_000_000) + F.col("page") * 3600).alias("query_at"),
        F.lit("twitter").alias("platform"), F.transform("rows", lambda r: r["user"]).alias("data"),
        F.concat(F.lit("c"), F.col("page").cast("string")).alias("cursor"),
    )
    lines = pages.select(F.to_json(F.struct(*pages.columns)).alias("value"))
    first = pages.filter(F.col("page") == 0)
    as_lines = lambda df: df.select(F.to_json(F.struct(*df.columns)).alias("value"))
    end = first.withColumns({"page": F.lit(1_000_000), "query_at": F.lit("2002-01-01").cast("timestamp"), "data": F.filter("data", lambda u: F.lit(False))})
    template = raw_users(w).filter("page = 0 and k = 1").select("user")
    changed = [F.col("user").withField("rest_id", F.lit(i)).withField("legacy.screen_name", F.lit(h)) for i, h in ODD_USERS]
    odd = template.select(F.array(*changed).alias("data"))
    odd = odd.select(F.lit("odd").alias("keyword"), F.lit(0).alias("page"), F.timestamp_seconds(F.lit(999_999_999)).alias("query_at"), F.lit("twitter").alias("platform"), "data", F.lit("c").alias("cursor"))
    more = [
        as_lines(first.withColumn("platform", F.lit("bluesky"))),
        as_lines(first),
        as_lines(first.drop("keyword")),
        as_lines(first.drop("query_at")),
        as_lines(end.drop("cursor")),
        as_lines(odd),
        first.select(F.lit('{"keyword": "cut').alias("value")),
    ]
    path = scratch_path(w.spark, "landing")
    for part in more:
        lines = lines.unionByName(part)
    if files:
        lines.repartition(files).write.text(path)
    else:
        lines.write.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").text(path)
    return path


def ingested(w: Workspace) -> ingest.Store:
    store = ingest.Store(w.spark, scratch_path(w.spark, "store"), buckets=8)
    query = ingest.start_ingest(w.spark, landed_pages(w), store, scratch_path(w.spark, "ingest"), w.as_of, files_per_batch=100_000)
    query.awaitTermination()
    return store


@catalog.query(
    "t1_ingest",
    """select twitter_id, handle, human_score, likely_is, followers, category as keywords, human_score > 0.65 as queued
    from profiles join user_stats using (twitter_id) where human_score is not null""",
)
def _(w):
    store = ingested(w)
    stats = store.stats.read().select("twitter_id", "followers")
    queued = store.queue.read().select("twitter_id", F.lit(True).alias("q"))
    joined = store.profiles.read().join(stats, "twitter_id").join(queued, "twitter_id", "left")
    return joined.filter("handle <> 'taken'").select(
        "twitter_id", "handle", "human_score", "likely_is", "followers", F.array_join("got_by_keywords", ";").alias("keywords"),
        F.coalesce("q", F.lit(False)).alias("queued"),
    )


@catalog.query(
    "t1_ingest_over_batches",
    """select twitter_id, handle, human_score, likely_is, followers, category as keywords, human_score > 0.65 as queued
    from profiles join user_stats using (twitter_id) where human_score is not null""",
)
def _(w):
    """One file a micro-batch; pages come again in later files."""
    store, landing = ingest.Store(w.spark, scratch_path(w.spark, "store"), buckets=8), landed_pages(w, files=4)
    ingest.start_ingest(w.spark, landing, store, scratch_path(w.spark, "ingest"), w.as_of, files_per_batch=1).awaitTermination()
    stats = store.stats.read().select("twitter_id", "followers")
    queued = store.queue.read().select("twitter_id", F.lit(True).alias("q"))
    joined = store.profiles.read().join(stats, "twitter_id").join(queued, "twitter_id", "left")
    return joined.filter("handle <> 'taken'").select(
        "twitter_id", "handle", "human_score", "likely_is", "followers", F.array_join("got_by_keywords", ";").alias("keywords"),
        F.coalesce("q", F.lit(False)).alias("queued"),
    )


LANDED = """select *, 'c' || page as cursor from (select cast(twitter_id as bigint) as k, twitter_id, category as keyword,
 cast(floor(cast(twitter_id as bigint)/20) as bigint) as page, created_at from user_profiles join user_stats using (twitter_id)) t"""


@catalog.query(
    "t1_searches",
    """select keyword, page, 'twitter' as platform, count(*) as items, 'c' || page as next_page,
      case when page=0 then 0 else count(created_at) end as new_profiles from landed group by keyword, page
    union all select keyword, page, 'bluesky', count(*), 'c0', count(created_at) from landed where page=0 group by keyword, page
    union all select distinct keyword, 1000000, 'twitter', 0, null, 0 from landed where page=0
    union all select 'odd', 0, 'twitter', 4, 'c', 1""",
    landed=LANDED,
)
def _(w):
    return ingested(w).searches.read().select("keyword", "page", "platform", "items", "next_page", "new_profiles")


@catalog.query(
    "t1_keywords",
    """select twitter_id, keyword, case when page=0 then least(substr(md5('bluesky|' || keyword || '|0'), 1, 16), substr(md5('twitter|' || keyword || '|0'), 1, 16))
      else substr(md5('twitter|' || keyword || '|' || page), 1, 16) end as search_id from landed where created_at is not null
    union all select '90000001', 'odd', substr(md5('twitter|odd|0'), 1, 16)""",
    landed=LANDED,
)
def _(w):
    return ingested(w).keywords.read().select("twitter_id", "keyword", "search_id")


@catalog.query(
    "t1_rejected",
    """select 'bad_created_at' as reject_reason, count(*) + 2 * count(*) filter (page=0) as n from landed where created_at is null having count(*) > 0
    union all select 'no_handle', 1 union all select 'handle_taken', 2""",
    landed=LANDED,
)
def _(w):
    store = ingested(w)
    return w.spark.read.parquet(f"{store.root}/rejected").groupBy("reject_reason").agg(row_count().alias("n"))


def filled(w: Workspace) -> ingest.Store:
    """A store that holds the given accounts, keyword hits and searches."""
    store = ingest.Store(w.spark, scratch_path(w.spark, "store"), buckets=8)
    first = lambda old, inc: inc
    # Counters are needed for the scores and beside them.
    w.user_stats = w.once(w.user_stats, "stats")
    at = F.lit("2000-01-01").cast("timestamp")
    profiles = w.profiles.join(w.user_stats.select("twitter_id", F.col("followers").alias("follower_count"), F.col("created_at").cast("string").alias("created_at")), "twitter_id")
    profiles = profiles.withColumns({"got_by_keywords": F.lit(None).cast("array<string>"), "updated_at": at})
    store.profiles.merge(profiles.select(*store.profiles.columns()), first)
    hits = w.keyword_table.filter("keyword <> '@customers'").withColumns({"search_id": F.lit("s"), "added_at": at})
    store.keywords.merge(hits.select(*store.keywords.columns()), first)
    searches = w.searches.withColumns({"id": F.lit("s"), "ids_hash": F.lit("h"), "platform": F.lit("twitter"), "query_at": F.col("query_at").cast("timestamp")})
    store.searches.merge(searches.select(*store.searches.columns()), first)
    return store


def as_labels(w: Workspace) -> DataFrame:
    return w.profile_scores.withColumns({"audience": F.lit("v1"), "scored_at": F.col("scored_at").cast("timestamp")})


@catalog.query(
    "l8_stored_labels",
    "select twitter_id, scored_by, case when scored_by='model-c' then not label else label end as label, reason from profile_scores",
)
def _(w):
    store = ingest.Store(w.spark, scratch_path(w.spark, "store"), buckets=8)
    jobs.save_labels(store, as_labels(w).filter("scored_by <> 'model-c'"), "run-1")
    jobs.save_labels(store, as_labels(w).withColumn("label", ~F.col("label")), "run-2")
    jobs.save_labels(store, as_labels(w).withColumn("label", F.lit(None).cast("boolean")), "run-2")
    return store.labels.read().select("twitter_id", "scored_by", "label", "reason")


@catalog.query(
    "l9_stored_relabels",
    "select twitter_id, scored_by, case when scored_by='model-a' then not label else label end as label from profile_scores",
)
def _(w):
    store = ingest.Store(w.spark, scratch_path(w.spark, "store"), buckets=8)
    jobs.save_labels(store, as_labels(w), "run-1")
    later = as_labels(w).filter("scored_by = 'model-a'").withColumns({"label": ~F.col("label"), "scored_at": F.lit("2024-01-01").cast("timestamp")})
    jobs.save_labels(store, later, "run-2", again=True)
    return store.labels.read().select("twitter_id", "scored_by", "label")


LOGS = """select twitter_id, scored_by, label, scored_at, audience from (select *, row_number() over (partition by twitter_id, scored_by, scored_at
 order by seq desc, l_partkey desc) as rn from history) t where rn=1"""
LOG_VIEWS = {"history": HISTORY, "logs": LOGS}
TIMES = ["1994-01-01", "1996-07-01", "1998-06-01"]


def label_log(w: Workspace) -> DataFrame:
    """The log after the labels of both audience versions were saved, the second run twice, and a first-wins run that finds all known."""
    last = F.max_by(F.struct("label", "audience"), "scored_at").alias("r")
    rows = label_history(w).groupBy("twitter_id", "scored_by", F.col("scored_at.l_shipdate").alias("at")).agg(last)
    rows = rows.select(
        "twitter_id", F.col("scored_by").cast("string").alias("scored_by"), "r.label", F.lit("line").alias("reason"),
        F.col("at").cast("timestamp").alias("scored_at"), "r.audience",
    )
    # Every run below takes its labels from here.
    rows = w.once(rows, "label-history")
    store = ingest.Store(w.spark, scratch_path(w.spark, "store"), buckets=8)
    for version in ("v0", "v1", "v1"):
        jobs.save_labels(store, rows.filter(F.col("audience") == version), f"run-{version}", again=True)
    jobs.save_labels(store, rows.withColumn("label", ~F.col("label")), "run-first")
    return store.label_log.read()


@catalog.query(
    "e6_labels_at",
    f"""select twitter_id, cast(scored_by as varchar) as scored_by, asked_at, label, audience from (select l.*, asked_at, row_number() over (partition by twitter_id, scored_by, asked_at
    order by scored_at desc) as rn from logs l, (values {', '.join(f"(timestamp '{t}')" for t in TIMES)}) v(asked_at) where scored_at <= asked_at) t where rn=1""",
    **LOG_VIEWS,
)
def _(w):
    times = [F.lit(f"{t} 00:00:00").cast("timestamp") for t in TIMES]
    held = history.held_at(label_log(w), times, history.LABEL_KEYS, "scored_at")
    return held.select(*history.LABEL_KEYS, F.col("asked_at").cast("timestamp_ntz").alias("asked_at"), "label", "audience")


@catalog.query(
    "e6_label_validity",
    """select twitter_id, cast(scored_by as varchar) as scored_by, label, scored_at as valid_from,
    lead(scored_at) over (partition by twitter_id, scored_by order by scored_at) as valid_to from logs""",
    **LOG_VIEWS,
)
def _(w):
    rows = history.validity(label_log(w), history.LABEL_KEYS, "scored_at")
    return rows.select(*history.LABEL_KEYS, "label", *(F.col(c).cast("timestamp_ntz").alias(c) for c in ("valid_from", "valid_to")))


@catalog.query(
    "e6_label_when_ordered",
    """select o_orderkey, label, audience from (select r.o_orderkey, l.label, l.audience, row_number() over (partition by r.o_orderkey order by l.scored_at desc nulls last) as rn
    from orders r left join logs l on l.twitter_id=cast(r.o_custkey as varchar) and l.scored_by=r.o_orderkey%3 and l.scored_at <= r.o_orderdate) t where rn=1""",
    **LOG_VIEWS,
)
def _(w):
    """The label that a model had given an account when it placed an order."""
    requests = w.raw("orders").select(
        "o_orderkey", F.col("o_custkey").cast("string").alias("twitter_id"), (F.col("o_orderkey") % 3).cast("string").alias("scored_by"),
        F.col("o_orderdate").cast("timestamp").alias("asked_at"),
    )
    log = label_log(w).select(*history.LABEL_KEYS, "scored_at", "label", "audience")
    return history.as_of(requests, log, history.LABEL_KEYS, "asked_at", "scored_at").select("o_orderkey", "label", "audience")


@catalog.query(
    "u10_totals",
    """select count(*) as total, count(p.twitter_id) as success, count(*) filter (where p.human_score > 0.55) as humans
    from wanted w left join profiles p on lower(p.handle)=lower(w.handle)""",
    wanted="""select case when c_custkey%3=0 then upper(h) when c_custkey%13=1 then 'no_' || h else h end as handle
      from (select c_custkey, lower(replace(c_name,'#','_')) as h from customer) t""",
)
def _(w):
    return curated_totals(jobs.save_curated(filled(w), mixed_case_handles(w).select("handle"), CURATED, F.lit("2024-01-03").cast("timestamp"), "curated"))


@catalog.query(
    "u7_stored_keyword_stats",
    """select s.keyword, case when length(s.keyword)=8 then '#kept' else '' end as tags, coalesce(f.n, 0) as profiles_found,
    round(coalesce(f.mean, 0e0), 3) as avg_human_score, round(case when l.rated > 0 then l.liked*1e0/l.rated else 0e0 end, 3) as label_rate,
    p.has_more as still_valid, s.pages_searched from (select keyword, max(page) as pages_searched from searches group by 1) s
    left join (select keyword, count(*) as n, avg(human_score) as mean from user_keywords join scores using (twitter_id) group by 1) f using (keyword)
    left join (select keyword, count(label) as rated, count(*) filter (where label) as liked
      from user_keywords join profile_scores using (twitter_id) group by 1) l using (keyword)
    left join latest_pages p using (keyword)""",
)
def _(w):
    store = filled(w)
    jobs.save_labels(store, as_labels(w), "labels")
    known = w.searches.filter(F.length("keyword") == 8).select("keyword").distinct().withColumn("semantic_tags", F.array(F.lit("#kept")))
    rest = {c: F.lit(None) for c in store.keyword_stats.columns() if c not in ("keyword", "semantic_tags")}
    empty = w.spark.createDataFrame([], store.keyword_stats.schema)
    before = known.withColumns(rest).select(*(F.col(f.name).cast(f.dataType) for f in empty.schema))
    store.keyword_stats.merge(before, lambda old, inc: inc, "seed")
    jobs.refresh_keyword_stats(store, F.lit("2024-01-02").cast("timestamp"), "day-1")
    rows = store.keyword_stats.read()
    return rows.select(
        "keyword", F.array_join("semantic_tags", ",").alias("tags"), "profiles_found", F.col("avg_human_score").cast("double").alias("avg_human_score"),
        F.col("label_rate").cast("double").alias("label_rate"), "still_valid", "pages_searched",
    )


@catalog.query(
    "u10_stored_curated",
    """select 'keyword' as kind, twitter_id from wanted join user_profiles p on lower(p.handle)=lower(wanted.handle)
    union all select 'queue', twitter_id from wanted join user_profiles p on lower(p.handle)=lower(wanted.handle)""",
    wanted="""select case when c_custkey%3=0 then upper(h) when c_custkey%13=1 then 'no_' || h else h end as handle
      from (select c_custkey, lower(replace(c_name,'#','_')) as h from customer) t""",
)
def _(w):
    store = filled(w)
    at = F.lit("2024-01-03").cast("timestamp")
    for _again in range(2):
        jobs.save_curated(store, mixed_case_handles(w).select("handle"), CURATED, at, "curated")
    tagged = store.keywords.read().filter(F.col("keyword") == CURATED).select(F.lit("keyword").alias("kind"), "twitter_id")
    return tagged.unionByName(store.queue.read().select(F.lit("queue").alias("kind"), "twitter_id"))


@catalog.query(
    "t5_dead_letters",
    """select v as verdict, n from (select count(distinct keyword) as n from landed where page=0) t,
    (values ('failed: broken json'), ('failed: missing keyword'), ('failed: missing time')) as x(v)""",
    landed=LANDED,
)
def _(w):
    store = ingested(w)
    side = w.spark.read.parquet(f"{store.root}/dead_letters")
    return side.groupBy("verdict").agg(row_count().alias("n"))
