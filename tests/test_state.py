"""Merges, snapshots and streams: repeats and order of arrival must not matter."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from kithscope.operators import merges, sampling
from kithscope.plans.registry import all_queries
from kithscope.plans.workspace import Workspace
from kithscope.sources.snapshots import SnapshotTable
from kithscope.sources.tables import write_bucketed
from kithscope.streaming import ingest, windows
from tests.conftest import MEDIUM, SMALL

PROFILE = "twitter_id string, name string, got_by_keywords array<string>, updated_at int"
HIT = "twitter_id string, name string, keyword string, updated_at int"


def rows_of(df):
    return sorted((tuple(map(repr, r)) for r in df.collect()))


def test_upsert_profiles_keeps_fields_and_is_idempotent(spark):
    old = spark.createDataFrame([("1", "old", None, 1), ("2", "two", ["k"], 1)], PROFILE)
    new = spark.createDataFrame([("1", "new", "k1", 5), ("1", "newer", "k2", 6), ("3", "three", "k", 4)], HIT)
    once = merges.upsert_profiles(old, new)
    want = [("1", "old", ["k1", "k2"], 6), ("2", "two", ["k"], 1), ("3", "three", ["k"], 4)]
    assert rows_of(once) == rows_of(spark.createDataFrame(want, PROFILE))
    assert rows_of(merges.upsert_profiles(once, new)) == rows_of(once)
    fresh = {r.twitter_id: r.name for r in merges.upsert_profiles(old, new, refresh=True).collect()}
    assert fresh == {"1": "newer", "2": "two", "3": "three"}


def test_insert_absent_ignores_order_of_arrival(spark):
    schema = "twitter_id string, keyword string, added_at int"
    rows = [("1", "a", 5), ("1", "a", 3), ("2", "a", 9), ("1", "b", 4)]
    empty = spark.createDataFrame([], schema)
    want = None
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        got = merges.insert_absent(empty, spark.createDataFrame(rows, schema), ["twitter_id", "keyword"], F.col("added_at"))
        want = want or rows_of(got)
        assert rows_of(got) == want
        assert rows_of(merges.insert_absent(got, spark.createDataFrame(rows, schema), ["twitter_id", "keyword"], F.col("added_at"))) == want


def test_snapshot_rewrites_touched_buckets_only(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"), "twitter_id string, v int", ["twitter_id"], buckets=8)
    replace = lambda old, inc: merges.upsert_latest(old, inc, ["twitter_id"], "v")
    assert table.read().count() == 0
    table.merge(spark.createDataFrame([(str(i), 0) for i in range(100)], "twitter_id string, v int"), replace, "b0")
    assert table.merge(spark.createDataFrame([("7", 1)], "twitter_id string, v int"), replace, "b1") == 2
    assert len(list((tmp_path / "t" / "data" / "v=2").glob("bucket=*"))) == 1
    assert table.merge(spark.createDataFrame([("7", 9)], "twitter_id string, v int"), replace, "b1") == 2
    got = {r.twitter_id: r.v for r in table.read().collect()}
    assert len(got) == 100 and got["7"] == 1


def test_bucketed_tables_join_without_shuffle(spark):
    w = Workspace(spark, SMALL)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for name in ("user_stats", "user_profiles"):
            spark.sql(f"drop table if exists b_{name}")
            write_bucketed(getattr(w, name), f"b_{name}", "twitter_id", 4)
        joined = spark.table("b_user_stats").join(spark.table("b_user_profiles"), "twitter_id")
        assert "Exchange hashpartitioning" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == w.user_stats.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in ("user_stats", "user_profiles"):
            spark.sql(f"drop table if exists b_{name}")


@pytest.mark.parametrize("shards", [1, 5])
def test_sharded_batches_partition_the_input(spark, shards):
    df = spark.range(137).select(F.col("id").cast("string").alias("twitter_id"))
    got = sampling.sharded_batches(df, "twitter_id", 25, shards)
    sizes = [r["count"] for r in got.groupBy("shard", "batch_no").count().collect()]
    assert sum(sizes) == 137 and max(sizes) <= 25
    assert got.select("twitter_id").distinct().count() == 137


def test_numbered_batches_keep_order(spark):
    df = spark.range(70).select(F.col("id").alias("ord")).repartition(6)
    got = {r.ord: (r.batch, r.position) for r in sampling.numbered_batches(df, [F.col("ord")], 30, first=4).collect()}
    assert got == {i: (4 + i // 30, i % 30) for i in range(70)}


def test_model_gate_repeats_and_meets_its_rate(spark):
    runs = spark.range(4000).select(F.concat(F.lit("run-"), "id").alias("run_id"))
    first = rows_of(sampling.model_gate(runs))
    assert first == rows_of(sampling.model_gate(runs.repartition(3)))
    shares = {r.model: r.s for r in sampling.model_gate(runs).groupBy("model").agg(F.avg(F.col("takes_part").cast("double")).alias("s")).collect()}
    for model, probability, _size in sampling.MODEL_GATES:
        assert abs(shares[model] - probability) < 0.03


def test_first_seen_over_several_batches(spark, tmp_path):
    rng = random.Random(1)
    rows = [("hot" if rng.random() < 0.5 else str(rng.randrange(30)), "k", i) for i in range(400)]
    for part in range(4):
        lines = [json.dumps({"twitter_id": a, "keyword": k, "seen_at": f"2024-01-01T00:{i // 60:02d}:{i % 60:02d}Z", "seq": i})
                 for a, k, i in rows[part * 100:(part + 1) * 100]]
        (tmp_path / f"{part}.json").write_text("\n".join(lines))
    schema = "twitter_id string, keyword string, seen_at timestamp, seq bigint"
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(tmp_path / "*.json"))
    query = windows.first_seen_stream(stream).writeStream.format("memory").queryName("firsts").outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    got = spark.table("firsts").collect()
    assert len(got) == len({r[0] for r in rows})


def test_follow_firsts_over_several_batches_and_again(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for part in range(3):
        lines = [json.dumps({"twitter_id": str(i % 7 + part), "keyword": f"k{part}", "seen_at": f"2024-01-0{part + 1}T00:00:0{i % 10}Z", "seq": i}) for i in range(9)]
        (tmp_path / "in" / f"{part}.json").write_text("\n".join(lines))
        # Files are delivered in order of their time, and those written within a tick in any order: here the order is meant.
        os.utime(tmp_path / "in" / f"{part}.json", (1_700_000_000 + part, 1_700_000_000 + part))
    stream = spark.readStream.schema(windows.HIT).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
    query = windows.follow_firsts(stream, str(tmp_path / "out"), str(tmp_path / "cp")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert len(query.recentProgress) >= 3
    got = {r.twitter_id: (r.keyword, r.batch_id) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {str(i): ("k0" if i < 7 else f"k{i - 6}", max(0, i - 6)) for i in range(9)}


def page(keyword, number, users, cursor="c", platform="twitter", handle="h{}", query_at=True):
    data = [
        {"rest_id": str(u), "is_blue_verified": False, "professional": None,
         "legacy": {"screen_name": handle and handle.format(u), "name": f"N{u}", "description": "bio", "created_at": "Wed Oct 10 20:19:24 +0000 2018",
                    "location": "", "followers_count": 300, "friends_count": 200, "statuses_count": 1500, "favourites_count": 900,
                    "listed_count": 3, "media_count": 10, "can_dm": None, "verified": False, "default_profile": False,
                    "default_profile_image": False, "possibly_sensitive": False}}
        for u in users
    ]
    at = f"2024-01-0{number + 1}T00:00:00Z" if query_at else None
    body = {"keyword": keyword, "page": number, "query_at": at, "platform": platform, "data": data, "cursor": cursor}
    return json.dumps({k: v for k, v in body.items() if v is not None})


def test_ingest_twice_equals_once(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "1.json").write_text("\n".join([page("a", 0, range(5)), page("b", 0, range(3, 8), None), "{broken", page(None, 0, [99])]))
    store = ingest.Store(spark, str(tmp_path / "store"), buckets=4)
    run = lambda: ingest.start_ingest(spark, str(landing), store, str(tmp_path / "cp"), "2024-02-01 00:00:00").awaitTermination()
    run()
    (landing / "2.json").write_text("\n".join([page("a", 1, range(4, 10)), page("b", 1, [50])]))
    run()
    profiles = {r.twitter_id: sorted(r.got_by_keywords) for r in store.profiles.read().collect()}
    assert set(profiles) == {str(i) for i in range(10)}  # 50 came from an exhausted keyword, 99 had none
    assert profiles["4"] == ["a", "b"]
    new = {(r.keyword, r.page): r.new_profiles for r in store.searches.read().collect()}
    assert new == {("a", 0): 5, ("b", 0): 3, ("a", 1): 2}
    verdicts = sorted(r.verdict for r in spark.read.parquet(f"{store.root}/dead_letters").collect())
    assert verdicts == ["failed: broken json", "failed: missing keyword", "skipped: fully paged"]
    before = [rows_of(t.read()) for t in (store.profiles, store.stats, store.keywords, store.queue, store.searches)]
    # The second micro-batch again, as after a crash between the merges and the commit.
    pages = spark.read.schema(f"{ingest_schema()}").json(str(landing / "2.json"))
    ingest.ingest_batch(pages, 1, store, "2024-02-01 00:00:00")
    after = [rows_of(t.read()) for t in (store.profiles, store.stats, store.keywords, store.queue, store.searches)]
    assert before == after


def test_no_page_or_account_is_lost(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    store = ingest.Store(spark, str(tmp_path / "store"), buckets=4)
    run = lambda: ingest.start_ingest(spark, str(landing), store, str(tmp_path / "cp"), "2024-02-01 00:00:00").awaitTermination()
    first = [page("a", 0, range(3)), page("a", 1, [], None), page("a", 0, [1, 5], platform="bluesky"), page("a", 2, [6], query_at=False), page("b", 0, [7], handle=None)]
    (landing / "1.json").write_text("\n".join(first))
    run()
    (landing / "2.json").write_text("\n".join([page("a", 2, [8]), page("b", 1, [10, 9], handle="same"), page("b", 2, [2000], handle="h1"), page("a", 1, [11], platform="bluesky")]))
    run()
    searches = {(r.platform, r.keyword, r.page): (r["items"], r.next_page) for r in store.searches.read().collect()}
    assert searches == {
        ("twitter", "a", 0): (3, "c"), ("twitter", "a", 1): (0, None), ("bluesky", "a", 0): (2, "c"), ("twitter", "b", 0): (1, "c"),
        ("twitter", "b", 1): (2, "c"), ("twitter", "b", 2): (1, "c"), ("bluesky", "a", 1): (1, "c"),
    }
    dead = sorted(r.verdict for r in spark.read.parquet(f"{store.root}/dead_letters").collect())
    assert dead == ["failed: missing time", "skipped: fully paged"]
    rejected = sorted((r.twitter_id, r.reject_reason) for r in spark.read.parquet(f"{store.root}/rejected").collect())
    assert rejected == [("10", "handle_taken"), ("2000", "handle_taken"), ("7", "no_handle")]
    stored = {r.twitter_id for r in store.profiles.read().collect()}
    assert stored == {"0", "1", "2", "5", "9", "11"}
    # Each account on a good page is stored or rejected.
    assert stored | {i for i, _ in rejected} == {str(i) for i in (0, 1, 2, 5, 7, 10, 9, 2000, 11)}


def test_a_small_merge_writes_only_its_rows_and_compaction_keeps_the_newest(spark, tmp_path):
    schema = "twitter_id string, v int"
    table = SnapshotTable(spark, str(tmp_path / "t"), schema, ["twitter_id"], buckets=4)
    replace = lambda old, inc: merges.upsert_latest(old, inc, ["twitter_id"], "v")
    table.merge(spark.range(20_000).selectExpr("cast(id as string) twitter_id", "0 v"), replace, "b0")
    batch = spark.range(0, 25_000, 50).selectExpr("cast(id as string) twitter_id", "1 v")
    assert table.merge(batch, replace, "b1") == 2
    assert spark.read.parquet(str(tmp_path / "t" / "data" / "v=2")).count() == 500
    before = rows_of(table.read())
    assert len(before) == 20_100 and table.compact() == 3
    assert rows_of(table.read()) == before and not (tmp_path / "t" / "data" / "v=2").exists()
    assert table.merge(batch, replace, "b1") == 3
    assert {r.v for r in table.read_for(batch).join(batch.select("twitter_id"), "twitter_id").collect()} == {1}


def test_rows_without_a_time_lose_no_fields(spark):
    schema = "k string, a int, at int"
    rows = spark.createDataFrame([("x", 1, None), ("y", 2, None), ("y", 3, 5)], schema)
    empty = spark.createDataFrame([], schema)
    assert rows_of(merges.upsert_latest(empty, rows, ["k"], "at")) == rows_of(spark.createDataFrame([("x", 1, None), ("y", 3, 5)], schema))
    assert rows_of(merges.insert_absent(empty, rows, ["k"], F.col("at"))) == rows_of(spark.createDataFrame([("x", 1, None), ("y", 3, 5)], schema))


def ingest_schema():
    from kithscope.schemas import SEARCH_PAGE_WITH_REQUEST

    return f"{SEARCH_PAGE_WITH_REQUEST}, _corrupt_record string"


def test_whole_batches_hold_all_accounts_and_all_models(spark):
    w = Workspace(spark, MEDIUM)
    tables = all_queries()["s4_whole_tables"](spark, MEDIUM)
    assert tables.count() == w.user_profiles.count() and tables.filter("bio = ''").count() == w.user_profiles.filter("coalesce(bio, '') = ''").count() > 0
    labels = all_queries()["j9_whole_labels"](spark, MEDIUM)
    assert labels.count() == w.profile_scores.count() and labels.select("scored_by").distinct().count() == 3


def test_refused_handles_are_found_from_pairs_alone(spark):
    from kithscope.operators.quality import quarantine, quarantine_taken, taken_handles

    rows = [("1", "a", 1), ("22", "a", 1), ("3", "b", 1), ("3", "b", 2), (None, "b", 1), ("4", None, 1), ("5", "c", None), ("6", "c", 1), ("7", "d", 1)]
    df = spark.createDataFrame(rows, "twitter_id string, handle string, created_at int").withColumn("bio", F.lit("text"))
    stored = spark.createDataFrame([("9", "d"), ("8", "zz")], "twitter_id string, handle string")
    for held in (None, stored):
        taken = taken_handles(df, stored=held)
        assert {tuple(r) for r in taken.collect()} == {("22", "a"), ("5", "c")} | ({("7", "d")} if held is not None else set())
        found = quarantine_taken(df, F.broadcast(taken))
        assert rows_of(found) == rows_of(quarantine(df, stored=held).select(found.columns))
        assert "SortMergeJoin" not in found._jdf.queryExecution().executedPlan().toString().split("BroadcastExchange")[0]


def test_a_merge_reads_whole_only_the_rows_it_is_asked_for(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"), "twitter_id string, v int", ["twitter_id"], buckets=2)
    table.merge(spark.range(1000).selectExpr("cast(id as string) twitter_id", "0 v"), lambda old, inc: inc)
    seen = []

    def resolve(old, inc):
        seen.append(old._jdf.queryExecution().optimizedPlan().toString())
        return merges.upsert_latest(old, inc, ["twitter_id"], "v")

    table.merge(spark.createDataFrame([("7", 1), ("x", 1), (None, 1)], "twitter_id string, v int"), resolve)
    assert "strategy=broadcast" in seen[0]
    assert {(r.twitter_id, r.v) for r in table.read().filter("v = 1").collect()} == {("7", 1), ("x", 1), (None, 1)} and table.read().count() == 1002


def test_strata_are_picked_before_their_texts_are_joined(spark):
    labels = spark.createDataFrame([(str(i % 40), f"m{i % 3}", i % 2 == 0, "r") for i in range(120)], "twitter_id string, scored_by string, label boolean, reason string")
    one = [(str(i), f"h{i}", "n", "bio" if i % 5 else "", "c", "twitter", True) for i in range(40)]
    profiles = spark.createDataFrame(one + one, "twitter_id string, handle string, name string, bio string, category string, platform string, can_dm boolean")
    stats = spark.createDataFrame([("1", 5)], "twitter_id string, followers int")
    got = sampling.stratified_sample(labels, profiles, stats, total=20, seed="s")
    assert got.columns == ["twitter_id", "label", "reason", "handle", "name", "bio", "category", "stratum", "followers"]
    rows = got.collect()
    assert len(rows) == 20 == len({(r.twitter_id, r.stratum) for r in rows}) and all(r.bio for r in rows) and sum(r.stratum == "true" for r in rows) == 6
    # Both strata are cut off by the small rows written for them, which hold no text.
    relations = [x for x in got._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Relation [" in x]
    assert len(relations) == 2 and not any("bio" in x for x in relations)


def test_a_labeler_process_is_given_one_batch_at_a_time(spark):
    from kithscope.operators import label_batches

    rows = spark.range(95).select(F.col("id").cast("string").alias("twitter_id"), *(F.lit("x").alias(c) for c in ("handle", "name", "bio", "category")), F.lit(1).alias("followers"))
    packed = label_batches.pack_batches(rows, 10, 2)
    answers = label_batches.run_labeler(packed, lambda profiles, model, audience: str(len(profiles)), "m", {}, parallel=3)
    plan = answers._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapGroupsInPandas" in plan and "MapInPandas [" not in plan.replace("FlatMapGroupsInPandas", "")
    assert sum(int(r.response) for r in answers.collect()) == 95 and answers.count() == packed.count()


def test_batch_files_of_a_folder_come_from_one_task(spark, tmp_path):
    from kithscope.sources import batch_files

    models = F.explode(F.array(F.lit("m"), F.lit("n"))).alias("scored_by")
    rows = spark.range(300).select((F.col("id") / 2).cast("bigint").alias("batch"), models, (F.col("id") % 2).alias("position"), F.concat(F.lit("h"), "id").alias("handle"), F.lit(True).alias("label"), F.lit("r").alias("reason"))
    texts = batch_files.label_json(batch_files.by_folder(rows), ["folder", "batch", "scored_by"], "position")
    # As many tasks as a shuffle has, however small the texts, and no second move of the rows.
    plan = texts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "REPARTITION_BY_NUM" in plan
    path = tmp_path / "b"
    batch_files.write_batches(texts, str(path), "scored_by", "batch")
    files = [p.relative_to(path).parts for p in path.rglob("part-*")]
    assert {f[:3] for f in files} == {(f"folder={b // 32}", f"scored_by={m}", f"batch={b}") for b in range(150) for m in "mn"} and len(files) == 300
    assert len({(f[0], f[3].split("-")[1]) for f in files}) == 5 and not list(path.rglob(".part-*.crc"))
    got = batch_files.read_label_arrays(spark, str(path), "scored_by")
    assert rows_of(got.selectExpr("batch_no batch", "scored_by", "pos position", "handle", "label", "reason")) == rows_of(rows.select("batch", "scored_by", "position", "handle", "label", "reason"))
    batch_files.write_batches(texts.drop("folder"), str(tmp_path / "c"), "scored_by", "batch")
    assert len(list((tmp_path / "c").glob("scored_by=*/batch=*/part-*"))) == 300
    with pytest.raises(Exception, match="already exists"):
        batch_files.write_batches(texts, str(path), "scored_by", "batch")


def test_bios_move_once_to_their_pages(spark, tmp_path):
    from kithscope.plans.account_queries import raw_pages, raw_users
    from kithscope.schemas import GIVEN_TABLES
    from kithscope.sources import search_pages

    given = {
        "customer": ("c_custkey bigint, c_name string, c_nationkey bigint, c_acctbal double, c_mktsegment string", [(k, f"C#{k}", 1, 5.0, "s") for k in (0, 1, 1, 19, 20, 21, 59, 60, None)]),
        "documents": ("doc_id bigint, text string", [(0, "a"), (1, "b"), (1, "c"), (20, None), (21, "d"), (39, "e"), (61, "f"), (None, "g")]),
        "nation": ("n_nationkey bigint, n_name string", [(1, "N")]),
        "orders": ("o_orderkey bigint, o_custkey bigint", [(1, 1)]),
        "lineitem": ("l_orderkey bigint, l_quantity double", [(1, 2.0)]),
    }
    for name, (ddl, rows) in given.items():
        found = dict(f.split() for f in GIVEN_TABLES[name].split(", "))
        df = spark.createDataFrame(rows, ddl)
        df.select(*(F.col(c).cast(found[c]) for c in df.columns)).write.parquet(str(tmp_path / f"{name}.parquet"))
    w = Workspace(spark, str(tmp_path))
    before = w.user_profiles.join(w.user_stats, "twitter_id").select(F.col("twitter_id").cast("bigint").alias("k"), search_pages.nest_user().alias("user"))
    as_text = lambda df: sorted(r.v for r in df.select(F.to_json(F.struct("k", "user")).alias("v")).collect())
    assert as_text(raw_users(w)) == as_text(before) and len(as_text(before)) == 14
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = raw_pages(w)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    # What stands above the join with the bios holds no exchange.
    top = plan[: plan.index("bio_page")].splitlines()
    assert "Exchange" not in "".join(top[:-1]) and plan.count("Exchange hashpartitioning(bio_page") == 1


def test_stored_tables_are_written_with_zstd(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"), "twitter_id string, v int", ["twitter_id"], buckets=2)
    table.insert(spark.createDataFrame([("7", 1)], "twitter_id string, v int"), F.col("v"))
    assert list((tmp_path / "t" / "data").rglob("*.zstd.parquet")) and not list((tmp_path / "t" / "data").rglob("*.snappy.parquet"))
