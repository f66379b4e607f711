"""Malformed and edge inputs: dates, texts, files, answers."""

import json

from pyspark.sql import functions as F

from kithscope.functions import text
from kithscope.functions.times import age_in_days, parse_created_at
from kithscope.operators.keywords import latest_pages, resume_points
from kithscope.operators.label_batches import match_labels, parse_responses, response_errors, system_prompt
from kithscope.sources import batch_files, delimited
from kithscope.sources.search_pages import CORRUPT, explode_users, read_search_pages


def one(spark, value, fn):
    return spark.createDataFrame([(value,)], "v string").select(fn(F.col("v")).alias("r")).first().r


def test_created_at_forms(spark):
    assert str(one(spark, "Wed Oct 10 20:19:24 +0000 2018", parse_created_at)) == "2018-10-10 20:19:24"
    assert str(one(spark, "2018-10-10T20:19:24Z", parse_created_at)) == "2018-10-10 20:19:24"
    assert one(spark, "last tuesday", parse_created_at) is None
    assert one(spark, "", parse_created_at) is None
    future = lambda c: age_in_days(parse_created_at(c), "2018-01-01 00:00:00")
    assert one(spark, "Wed Oct 10 20:19:24 +0000 2018", future) == 0.0


def test_normalize_text(spark):
    raw = '  "Dr. O\'Neil", PhD\\ \x07\nlab ﻿'
    assert one(spark, raw, text.normalize_text) == "Dr. ONeil PhD lab"
    assert one(spark, "", text.normalize_or_null) is None
    assert one(spark, None, text.normalize_or_null) is None


def test_file_stems(spark):
    assert one(spark, "@Grounded  theory/x", text.export_file_stem) == "grounded_theory_x"
    assert one(spark, "@Grounded  theory/x", text.label_file_stem) == "_Grounded__theory_x"


def test_code_fences(spark):
    assert one(spark, " ```json\n[1]\n``` ", text.strip_code_fence) == "[1]"
    assert one(spark, "```[1]```", text.strip_code_fence) == "[1]"


def test_search_pages_with_broken_line(spark, tmp_path):
    user = {"rest_id": "1", "is_blue_verified": True, "legacy": {"screen_name": "A", "followers_count": 3}, "professional": {"category": []}}
    lines = [json.dumps({"data": [user, {**user, "rest_id": "2"}], "cursor": "c"}), '{"data": [', json.dumps({"data": None})]
    (tmp_path / "p.json").write_text("\n".join(lines))
    pages = read_search_pages(spark, str(tmp_path)).cache()
    assert pages.filter(F.col(CORRUPT).isNotNull()).count() == 1
    users = explode_users(pages.drop(CORRUPT)).select("user.rest_id", text.first_category(F.col("user.professional")).alias("c"))
    assert sorted(tuple(r) for r in users.collect()) == [("1", None), ("2", None)]


def test_leads(spark, tmp_path):
    (tmp_path / "l.csv").write_text(
        'USERNAME,BIO,FOLLOWERS,SCORE,TAGS,RATIONALE\n'
        'ann,"likes ""tea"", milk",12,0.5,x;y,why\n'
        "bob,short,many,high,t\n"
        "cut,only,three\n"
    )
    rows = {r.username: r for r in delimited.read_leads(spark, str(tmp_path)).collect()}
    assert set(rows) == {"ann", "bob"}
    assert rows["ann"].bio == 'likes "tea", milk' and rows["ann"].followers == 12
    assert (rows["bob"].followers, rows["bob"].score, rows["bob"].rationale) == (0, 0.0, "")


def test_handles_and_progress(spark, tmp_path):
    (tmp_path / "h.txt").write_text(" ann \n\n# no\nbob\n")
    assert [r.handle for r in delimited.read_handles(spark, str(tmp_path / "h.txt")).collect()] == ["ann", "bob"]
    (tmp_path / "p.csv").write_text('HANDLE,LABEL,REASON,CLASS\nAnn,TRUE,"a ""b""",Human\nbob,null,"",robot\n')
    got = {r.handle: (r.label, r.reason, r["class"]) for r in delimited.read_progress(spark, str(tmp_path / "p.csv")).collect()}
    assert got == {"ann": (True, 'a "b"', "human"), "bob": (None, "", None)}


def test_batch_dialects(spark, tmp_path):
    head = "[2]{handle,name,bio,category,followers}:"
    files = {
        "batch-01.toon": f'{head}\n  ann  , Ann A  , likes tea   , null , 12\n  bob,"B, Bob","say ""hi""",Art,7\n',
        "batch-02.toon": f"customers{head}\n  cy\tCy C, PhD\tx\tnull\t3\n",
    }
    for name, body in files.items():
        (tmp_path / name).write_text(body)
    comma = batch_files.read_batches(spark, str(tmp_path / "batch-01.toon")).collect()
    assert [tuple(r) for r in comma] == [(1, "ann", "Ann A", "likes tea", None, 12), (1, "bob", "B, Bob", 'say "hi"', "Art", 7)]
    tab = batch_files.read_batches(spark, str(tmp_path / "batch-02.toon"), "\t").collect()
    assert [tuple(r) for r in tab] == [(2, "cy", "Cy C, PhD", "x", None, 3)]
    sizes = {r.file[-13:]: (r.declared, r.found) for r in batch_files.batch_sizes(spark, str(tmp_path)).collect()}
    assert sizes == {"batch-01.toon": (2, 2), "batch-02.toon": (2, 1)}


def test_label_arrays(spark, tmp_path):
    good = [{"handle": "a", "label": None, "reason": "r"}, {"handle": "b", "label": True, "reason": "s"}]
    (tmp_path / "haiku-07.json").write_text(json.dumps(good))
    (tmp_path / "haiku.08.json").write_text(json.dumps(good[:1]))
    (tmp_path / "haiku-09.json").write_text('[{"handle": "a", "label": true, "reason": "r"},]')
    (tmp_path / "haiku-10.json").write_text("")
    rows = sorted((r.batch_no, r.pos, r.handle, r.label) for r in batch_files.read_label_arrays(spark, str(tmp_path)).collect())
    assert rows == [(7, 0, "a", None), (7, 1, "b", True), (8, 0, "a", None)]


def answers(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "b int, response string")


def test_one_bad_item_rejects_the_answer(spark):
    ok = '[{"handle":"Ann","label":null,"reason":"r"},{"handle":"ghost","label":false,"reason":"r"}]'
    long = json.dumps([{"handle": "ann", "label": True, "reason": "x" * 600}])
    bad = [
        '[{"handle":"ann","label":"true","reason":"r"}]', '[{"handle":"ann","reason":"r"}]', '[{"handle":"ann","label":true}]',
        '[{"handle":1,"label":true,"reason":"r"}]', '{"handle":"ann","label":true,"reason":"r"}', "sorry", '[{"handle":"ann"', None,
    ]
    df = answers(spark, ok, f"```json\n{long}\n```", "[]", *bad)
    known = spark.createDataFrame([(i, "1", "ANN") for i in range(len(bad) + 3)], "b int, twitter_id string, handle string")
    got = match_labels(parse_responses(df, ["b"]), known, ["b"]).collect()
    assert sorted((r.b, r.handle, r.label, len(r.reason)) for r in got) == [(0, "Ann", None, 1), (1, "ann", True, 500)]
    assert tuple(response_errors(df).first()) == (len(bad) + 3, 1, len(bad) - 1)


def test_paging_state(spark):
    rows = [("a", 0, "x"), ("a", 1, None), ("b", 0, ""), ("c", 0, None), ("c", 1, "y")]
    searches = spark.createDataFrame(rows, "keyword string, page bigint, next_page string").withColumn("query_at", F.lit(None).cast("timestamp_ntz"))
    assert {r.keyword: r.has_more for r in latest_pages(searches).collect()} == {"a": False, "b": True, "c": True}
    wanted = spark.createDataFrame([("a",), ("b",), ("new",)], "keyword string")
    got = {r.keyword: (r.page, r.cursor, r.status) for r in resume_points(searches, wanted).collect()}
    assert got == {"a": (2, None, "fully_paged"), "b": (1, "", "ready"), "new": (0, None, "ready")}


def test_system_prompt(spark, tmp_path):
    audience = {"targetProfile": "field biologist", "sector": "academia", "highSignals": ["birds", "plots"], "lowSignals": ["ads"], "domainContext": "Outdoor work."}
    (tmp_path / "a.json").write_text(json.dumps(audience, indent=1))
    prompt = system_prompt(delimited.read_audience(spark, str(tmp_path))).first().system_prompt
    assert "field biologist working in ACADEMIA" in prompt and "- birds\n- plots" in prompt and '[{"handle"' in prompt
