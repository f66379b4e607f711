"""Streams over several deliveries in any order, and labels over time."""

import datetime as dt
import itertools
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from kithscope.operators import history
from kithscope.streaming import ingest, jobs, windows

DAY = dt.timedelta(days=1)
START = dt.datetime(2024, 1, 1)


def hits(part):
    return [{"twitter_id": str(i % 7 + part), "keyword": f"k{part}", "seen_at": f"2024-01-0{part + 1}T00:00:0{i % 10}Z", "seq": i} for i in range(9)]


@pytest.mark.parametrize("times", [(1, 2, 3), (3, 2, 1), (5, 5, 5), (2, 3, 1)])
def test_firsts_do_not_hang_on_file_times(spark, tmp_path, times):
    (tmp_path / "in").mkdir()
    for part, at in enumerate(times):
        file = tmp_path / "in" / f"{part}.json"
        file.write_text("\n".join(map(json.dumps, hits(part))))
        os.utime(file, (1_700_000_000 + at, 1_700_000_000 + at))
    stream = spark.readStream.schema(windows.HIT).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
    query = windows.follow_firsts(stream, str(tmp_path / "out"), str(tmp_path / "cp")).trigger(availableNow=True).start()
    query.awaitTermination()
    got = {r.twitter_id: (r.keyword, r.seq) for r in windows.read_firsts(spark, str(tmp_path / "out")).collect()}
    want = {}
    for r in sorted(itertools.chain(*map(hits, range(3))), key=lambda r: (r["seen_at"], r["seq"])):
        want.setdefault(r["twitter_id"], (r["keyword"], r["seq"]))
    assert got == want and len(query.recentProgress) >= 3


def test_sessions_end_and_an_account_is_new_again(spark, tmp_path):
    rng = random.Random(2)
    rows = [(str(rng.randrange(6)), f"k{i % 4}", START + DAY * rng.random() * 40, i) for i in range(120)]
    rows += [("hot", "k", START + DAY * i / 10, 1000 + i) for i in range(100)]
    rows.sort(key=lambda r: r[2])
    parts = [rows[k::1][:0] for k in range(0)] + [rows[k * 55 : (k + 1) * 55] for k in range(4)]
    landing, out, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))
    for k, part in enumerate(parts):
        random.Random(k).shuffle(part)
        spark.createDataFrame(part, "twitter_id string, keyword string, seen_at timestamp, seq bigint").write.parquet(f"{landing}/{k}")
        stream = spark.readStream.schema(windows.HIT).option("recursiveFileLookup", True).parquet(landing)
        firsts = windows.first_seen_sessions(stream, "2 days", "1 hour")
        query = firsts.writeStream.format("parquet").outputMode("append").option("path", out).option("checkpointLocation", cp).trigger(availableNow=True).start()
        query.awaitTermination()
    want, newest = {}, max(r[2] for r in rows)
    for account in {r[0] for r in rows}:
        own = sorted((r[2], r[3], r[1]) for r in rows if r[0] == account)
        begin = last = None
        for at, seq, keyword in [*own, (dt.datetime.max, 0, "")]:
            if last is not None and at - last > 2 * DAY:
                if last + 2 * DAY <= newest - dt.timedelta(hours=1):
                    want[account, begin[1]] = begin[2]
                begin = None
            begin, last = begin or (at, seq, keyword), at
    got = {(r.twitter_id, r.seq): r.keyword for r in spark.read.schema(f"{windows.HIT}, hits bigint, until timestamp").parquet(out).collect()}
    assert got == want and len(want) > 10
    # State holds open sessions only, fewer than accounts ever seen times their sessions.
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= len({r[0] for r in rows})


def test_late_rows_lie_in_the_side_table_and_a_repeated_batch_changes_nothing(spark, tmp_path):
    schema = "seq bigint, keyword string, query_at timestamp, new_profiles bigint"
    day = lambda k: START + DAY * k
    batches = [
        [(1, "a", day(0.5), 1), (2, "a", day(3.2), 2)],
        [(3, "a", day(2.1), 4), (4, "b", day(2.3), 8), (5, "a", None, 16)],  # the first is late by now, the second is not
        [(6, "b", day(9.0), 32)],
        [(7, "a", day(7.9), 64), (8, "a", day(8.0), 128)],
    ]
    landing, out, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{landing}/{k}")
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(landing)
        windows.follow_yield(stream, out, cp, "1 day", "1 day", "1 day").trigger(availableNow=True).start().awaitTermination()

    def result():
        late = {r.seq for r in windows.read_late(spark, out, schema).collect()}
        held = {(r.window_start, r.keyword): (r.searches, r.new_profiles, r.closed) for r in windows.read_yield(spark, out).collect()}
        return late, held

    late, held = result()
    assert late == {3, 5, 7}
    assert held == {
        (day(0), "a"): (1, 1, True), (day(3), "a"): (1, 2, True), (day(2), "b"): (1, 8, True), (day(9), "b"): (1, 32, False), (day(8), "a"): (1, 128, False),
    }
    # The third batch once more, as after a crash between writing and commit.
    again = windows.follow_yield(spark.readStream.schema(schema).parquet(f"{landing}/2"), out, str(tmp_path / "other"), "1 day", "1 day", "1 day")
    assert again is not None and result() == (late, held)


LABEL = "twitter_id string, scored_by string, label boolean, reason string, scored_at timestamp, audience string"


def test_the_log_keeps_what_took_effect(spark, tmp_path):
    store = ingest.Store(spark, str(tmp_path / "s"), buckets=4)
    at = lambda k: START + DAY * k
    make = lambda rows: spark.createDataFrame(rows, LABEL)
    jobs.save_labels(store, make([("1", "m", True, "r", at(1), "v0"), ("2", "m", None, "r", at(1), "v0")]), "a")
    jobs.save_labels(store, make([("1", "m", False, "r", at(2), "v0"), ("3", "m", False, "r", at(2), "v0")]), "b")
    for _ in range(2):
        jobs.save_labels(store, make([("2", "m", True, "r", at(3), "v1"), ("2", "m", False, "r", at(4), "v1")]), "c", again=True)
    assert {(r.twitter_id, r.label) for r in store.labels.read().collect()} == {("1", True), ("2", False), ("3", False)}
    log = store.label_log.read()
    assert {(r.twitter_id, r.label, r.scored_at) for r in log.collect()} == {("1", True, at(1)), ("2", None, at(1)), ("3", False, at(2)), ("2", True, at(3)), ("2", False, at(4))}
    spans = {(r.twitter_id, r.valid_from): r.valid_to for r in history.validity(log, history.LABEL_KEYS, "scored_at").collect()}
    assert spans == {("1", at(1)): None, ("2", at(1)): at(3), ("2", at(3)): at(4), ("2", at(4)): None, ("3", at(2)): None}
    held = history.held_at(log, [F.lit(at(0)), F.lit(at(3)), F.lit(at(9))], history.LABEL_KEYS, "scored_at")
    assert {(r.twitter_id, r.asked_at, r.label) for r in held.collect()} == {
        ("1", at(3), True), ("2", at(3), True), ("3", at(3), False), ("1", at(9), True), ("2", at(9), False), ("3", at(9), False),
    }
    asked = spark.createDataFrame([("2", "m", at(0), "x"), ("2", "m", at(1), "y"), ("2", "m", at(3.5), "z"), ("9", "m", at(9), "w")], "twitter_id string, scored_by string, t timestamp, label_of string")
    found = history.as_of(asked, log, history.LABEL_KEYS, "t", "scored_at").collect()
    assert {r.label_of: (r.label, r.scored_at) for r in found} == {"x": (None, None), "y": (None, at(1)), "z": (True, at(3)), "w": (None, None)}


def test_saved_labels_write_only_what_takes_effect(spark, tmp_path, monkeypatch):
    store = ingest.Store(spark, str(tmp_path / "s"), buckets=4)
    make = lambda rows: spark.createDataFrame(rows, LABEL)
    at = lambda k: START + DAY * k
    jobs.save_labels(store, make([(str(i), "m", True, "r", at(1), "v0") for i in range(50)] + [(None, "m", True, "r", at(1), "v0")]), "a")
    jobs.save_labels(store, make([(str(i), "m", False, "r", at(2), "v0") for i in range(51)] + [(None, "m", False, "r", at(2), "v0")]), "b")
    for table in (store.labels, store.label_log):
        assert [r.twitter_id for r in spark.read.parquet(f"{table.root}/data/v=2").collect()] == ["50"]
        assert table.version() == 2 and table.read().count() == 52
    assert "Aggregate" not in store.label_log.read()._jdf.queryExecution().optimizedPlan().toString()
    plan = store.queue.read().join(store.labels.read(), "twitter_id", "left_anti")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
    # A run that was merged is not even written to be looked at.
    monkeypatch.setattr(jobs, "scratch_path", lambda *_: pytest.fail("written again"))
    jobs.save_labels(store, make([("1", "m", None, "r", at(9), "v0")]), "b", again=True)
    assert store.labels.read().filter("label").count() == 51


def test_requests_carry_each_of_their_fields_once(spark):
    log = spark.createDataFrame([("1", 1, "a"), ("1", 5, "b"), (None, 2, "n")], "k string, at int, v string")
    asked = spark.createDataFrame([("x", "1", 1), ("y", "1", 9), ("z", "1", 0), ("w", None, 2)], "id string, k string, t int")
    found = history.as_of(asked, log, ["k"], "t", "at")
    assert found.columns == ["id", "k", "t", "at", "v"]
    assert {tuple(r) for r in found.collect()} == {("x", "1", 1, 1, "a"), ("y", "1", 9, 5, "b"), ("z", "1", 0, None, None), ("w", None, 2, 2, "n")}
    request = next(f for f in found._jdf.queryExecution().analyzed().toString().splitlines() if " AS _request" in f)
    assert ", k, k#" not in request and ", t, t#" not in request
