"""Exports and table files: written, read back, every odd cell."""

import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from kithscope.sources import batch_files, exports

ACCOUNT = "handle string, bio string, followers bigint, final_score double, human_score double, avg_llm double, has_llm boolean, likely_is string, keywords array<string>"
ACCOUNTS = [
    ("a", None, None, 0.91, 0.9, 0.9, True, None, []),
    ("b", "", 5, 0.72, 0.7, 0.7, True, "Human", ["k"]),
    ("c", ' a "quoted", bio\nof two lines ', 7, 0.72, 0.7, 0.7, True, "Bot", ["k", "l"]),
    ("d", "low", 1, 0.2, 0.2, 0.0, False, None, []),
    ("e", None, 2, 0.1, 0.1, 0.5, True, "Other", None),
]


def test_ranked_files_keep_empty_cells_and_order(spark, tmp_path):
    final = spark.createDataFrame(ACCOUNTS, ACCOUNT)
    exports.write_ranked(exports.high_score_rows(final), str(tmp_path / "high"), exports.HIGH_HEADER, "score")
    got = exports.read_ranked(spark, str(tmp_path / "high"), exports.HIGH_HEADER).collect()
    assert {tuple(r) for r in got} == {
        ("a", "", "0", "0.9100", "Unknown", ""), ("b", "", "5", "0.7200", "Human", "k"), ("c", ' a "quoted", bio of two lines ', "7", "0.7200", "Bot", "k; l"),
    }
    exports.write_ranked(exports.low_score_rows(final), str(tmp_path / "low"), exports.LOW_HEADER, "final_score")
    low = {r.HANDLE: r for r in exports.read_ranked(spark, str(tmp_path / "low"), exports.LOW_HEADER).collect()}
    assert low["d"].AVG_LLM == "" and low["d"].HAS_LLM == "false" and low["e"].BIO == "" and (low["e"].TAGS or "") == ""


def test_label_files_per_keyword_tell_uncertain_from_empty(spark, tmp_path):
    rows = [("k/1", "a", None, None, "why"), ("k/1", "b", "x,\ny", True, None), ("l#2", "a", "", False, "")]
    labels = spark.createDataFrame(rows, "keyword string, handle string, bio string, label boolean, reason string")
    exports.write_labels(exports.label_rows(labels, "keyword"), str(tmp_path / "l"))
    got = {(r.keyword, r.handle): (r.bio, r.label, r.reason) for r in exports.read_labels(spark, str(tmp_path / "l")).collect()}
    assert got == {("k/1", "a"): ("", None, "why"), ("k/1", "b"): ("x,\ny", True, ""), ("l#2", "a"): ("", False, "")}


FILES = {
    "batch-1.toon": 'rows[2]{handle,name,bio,category,followers}:\n  a, A One, "b, ""c""", null, 12\n  b, B, , Education, x\n',
    "batch-2.toon": "customers[2]{handle,name,bio,category,followers}:\n  a\tA  , PhD\tone, two\t\t51745\n  b\tB\t\tnull\t3\n",
    "batch-3.toon": "handle,name,bio,category,followers\r\na,A,bio,cat,7\r\n\r\nb,B,,,\r\n",
    "batch-4.toon": "followers\thandle\n9\tz\n",
    "batch-5.toon": "rows[3]{handle,name,bio,category,followers}:\n  a,A,b,c,1\n",
    "batch-6.toon": "a,A,b,c,1\n",
    "batch-7.toon": "handle,name\nx,y\nhandle,name\n",
    "batch-8.toon": "rows[0]{handle,name,bio,category,followers}:\n",
}


def test_tables_are_read_in_the_dialect_of_each_file(spark, tmp_path):
    for name, text in FILES.items():
        (tmp_path / name).write_text(text)
    rows, refused = batch_files.read_tables(spark, str(tmp_path))
    got = {(r.batch_no, r.handle): (r.name, r.bio, r.category, r.followers) for r in rows.collect()}
    assert got == {
        (1, "a"): ("A One", 'b, "c"', None, 12), (1, "b"): ("B", "", "Education", 0),
        (2, "a"): ("A  , PhD", "one, two", "", 51745), (2, "b"): ("B", "", None, 3),
        (3, "a"): ("A", "bio", "cat", 7), (3, "b"): ("B", "", "", 0),
    }
    assert {r.batch_no: r.reason for r in refused.collect()} == {4: "no header", 5: "row count", 6: "no header", 7: "several headers"}


def test_sets_are_read_back_in_written_order(spark, tmp_path):
    rows = [(f"k#{i % 3}", f"h{i:04d}", "N", 'b,"i"', None, (i * 37) % 50) for i in range(900)]
    df = spark.createDataFrame(rows, "keyword string, handle string, name string, bio string, category string, followers bigint").repartition(5)
    path = str(tmp_path / "sets")
    batch_files.write_profile_sets(batch_files.profile_set_lines(df, F.col("keyword")), path)
    got = {}
    for r in batch_files.read_profile_sets(spark, path).collect():
        got.setdefault(r.keyword, {})[r.place] = r.value
    for keyword, lines in got.items():
        own = sorted((-f, h) for k, h, *_, f in rows if k == keyword)
        want = [f"[{len(own)}]{{handle,name,bio,category,followers}}:", *(f'  {h},N,"b,""i""",null,{-f}' for f, h in own)]
        assert [lines[k] for k in range(len(lines))] == want
    assert len(got) == 3


@pytest.mark.parametrize("compression", ["none", "gzip"])
def test_sets_share_their_rows_and_are_numbered_where_they_stand(spark, tmp_path, compression):
    schema = "keywords array<string>, handle string, name string, bio string, category string, followers bigint"
    rows = [([f"k{i % 2}", "all"], f"h{i:04d}", "N", "b" * (i % 90), None, (i * 37) % 50) for i in range(600)]
    lines = batch_files.shared_set_lines(spark.createDataFrame(rows, schema).repartition(5), F.col("keywords"))
    path = str(tmp_path / "sets")
    batch_files.write_profile_sets(lines, path, compression, lines_per_task=200)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        read = batch_files.read_profile_sets(spark, path)
        plan = read._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hash" not in plan and "Exchange range" not in plan and "ExistingRDD" not in plan
        got = {}
        for r in read.collect():
            got.setdefault(r.keyword, {})[r.place] = r.value
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    for keyword, placed in got.items():
        own = sorted((-r[5], r[1], r[3]) for r in rows if keyword in r[0])
        want = [f"[{len(own)}]{{handle,name,bio,category,followers}}:", *(f"  {h},N,{b},null,{-f}" for f, h, b in own)]
        assert [placed[k] for k in range(len(placed))] == want
    assert sorted(got) == ["all", "k0", "k1"]


def test_sets_that_are_only_read_back_are_never_all_on_disk(spark, tmp_path, monkeypatch):
    schema = "keywords array<string>, handle string, name string, bio string, category string, followers bigint"
    rows = [(["all", None, "7" if i % 2 else "007", f"k{i % 5}"], f"h{i:04d}", "N", "b" * (i % 90), None, (i * 37) % 50) for i in range(600)]
    lines = batch_files.shared_set_lines(spark.createDataFrame(rows, schema).repartition(5), F.col("keywords"))
    path, seen = tmp_path / "sets", []
    write = batch_files._write_dealt

    def watched(*args):
        write(*args)
        files = [gzip.open(f, "rt") for f in path.rglob("*.txt.gz")]
        seen.append(sum(len(f.readlines()) for f in files))

    monkeypatch.setattr(batch_files, "_write_dealt", watched)
    columns = {"line": F.md5("value"), "n": F.length("value")}
    read = batch_files.read_back_sets(lines, str(path), columns, "gzip", lines_per_task=200, at_once=500)
    # 601 lines of each of two sets, each alone; then 301, 301 and five times 121.
    assert sum(seen) == 2 * 601 + 2 * 301 + 5 * 121 and max(seen) == 601 and len(seen) == 6
    assert not [*path.rglob("*.txt.gz")]
    got = {}
    for r in read.collect():
        got.setdefault(r.keyword, {})[r.place] = (r.line, r.n)
    assert sorted(got) == ["007", "7", "all", "k0", "k1", "k2", "k3", "k4"]
    for keyword, placed in got.items():
        own = sorted((-r[5], r[1], r[3]) for r in rows if keyword in r[0])
        want = [f"[{len(own)}]{{handle,name,bio,category,followers}}:", *(f"  {h},N,{b},null,{-f}" for f, h, b in own)]
        assert [placed[k] for k in range(len(placed))] == [(hashlib.md5(v.encode()).hexdigest(), len(v)) for v in want]
    assert batch_files.read_back_sets(lines, str(tmp_path / "one"), columns, "gzip").exceptAll(read).isEmpty()
    none = batch_files.read_back_sets(lines.limit(0), str(tmp_path / "none"), columns)
    assert none.collect() == [] and none.columns == read.columns


@pytest.mark.parametrize("name", ["haiku-07.json", "haiku.07.json", "batch=7/part-0.json"])
def test_label_files_by_either_name(spark, tmp_path, name):
    (tmp_path / name).parent.mkdir(exist_ok=True)
    (tmp_path / name).write_text('[{"handle": "a", "label": true, "reason": "r"}, {"handle": "a", "label": null, "reason": "s"}]')
    got = batch_files.read_label_arrays(spark, str(tmp_path)).collect()
    assert [(r.batch_no, r.pos, r.handle, r.label) for r in sorted(got, key=lambda r: r.pos)] == [(7, 0, "a", True), (7, 1, "a", None)]
