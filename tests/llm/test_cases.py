"""Verdicts against plain Python, and odd inputs: empty tables, nulls, repeats, very long texts, extra columns of clashing names."""

import collections
import math

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from kithscope.llm.op4_url_trust import judge_urls
from kithscope.llm.op5_toxicity_chain import toxicity_chain
from kithscope.llm.op9_quality_votes import measured, quality_votes
from kithscope.llm.queries import URL_RULES
from tests.conftest import SMALL
from tests.llm.fixtures import prose

pytest.importorskip("public_tokenizers")


def plain_votes(r):
    """The rules once more, on one document."""
    words, lines = r["n_words"], r["n_lines"]

    def vote(bad, good):
        return -1 if bad else 1 if good else 0

    def share(name, per=words):
        return r[name] / per if per else None

    def above(x, limit):
        return x is not None and x > limit

    def below(x, limit):
        return x is not None and x < limit

    length, capitals, repeated = share("word_chars"), share("n_upper", r["n_letters"]), share("n_dup_lines", lines)
    return [
        vote(above(share("n_repeat_words"), 0.4), below(share("n_repeat_words"), 0.1)),
        vote(above(share("n_symbols"), 0.2), below(share("n_symbols"), 0.02)),
        vote(above(capitals, 0.25), below(capitals, 0.1)),
        vote(above(share("n_marks"), 0.15), below(share("n_marks"), 0.03)),
        vote(above(share("n_bars"), 0.1), below(share("n_bars"), 0.01)),
        vote(above(repeated, 0.5) and lines >= 8, below(repeated, 0.05) and lines >= 3),
        vote(below(length, 2.5) or above(length, 12), above(length, 3) and below(length, 9)),
        vote(below(share("n_stops"), 0.01) and words >= 60, above(share("n_stops"), 0.03)),
    ]


def plain_posteriors(votes, rounds=50, pseudo=10.0):
    """Expectation-maximisation with one loop per document, rule and state."""
    m = len(votes[0])
    states = range(m + 1)
    start = [[0.01] * m, *[[0.9 if j == k else 0.1 for j in range(m)] for k in range(m)]]
    belief = []
    for v in votes:
        bad = [x == -1 for x in v]
        belief.append([0.0 if any(bad) else 1.0, *(b / max(1, sum(bad)) for b in bad)])
    for _ in range(rounds):
        rate = []
        for s in states:
            spoken = [sum(b[s] for b, v in zip(belief, votes) if v[j] != 0) for j in range(m)]
            against = [sum(b[s] for b, v in zip(belief, votes) if v[j] == -1) for j in range(m)]
            rate.append([(against[j] + pseudo * start[s][j]) / (spoken[j] + pseudo) for j in range(m)])
        shares = [(sum(b[s] for b in belief) + 1) / (len(votes) + m + 1) for s in states]
        belief = []
        for v in votes:
            score = [math.log(shares[s]) + sum(math.log(rate[s][j] if x == -1 else 1 - rate[s][j]) for j, x in enumerate(v) if x) for s in states]
            total = sum(math.exp(x) for x in score)
            belief.append([math.exp(x) / total for x in score])
    return [b[0] for b in belief]


def test_posterior_quality_and_verdicts_are_those_of_plain_python(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [r.asDict() for r in measured(docs).collect()]
    quality = plain_posteriors([plain_votes(r) for r in rows])
    got = {r["doc_id"]: r for r in quality_votes(docs).collect()}
    assert len(got) == len(rows) and 0 < sum(r["kept"] for r in got.values()) < len(rows)
    for r, q in zip(rows, quality, strict=True):
        mine = got[r["doc_id"]]
        assert mine["quality"] == pytest.approx(q, abs=1e-6)
        assert abs(q - 0.5) < 1e-6 or mine["kept"] == (not mine["base_failed"] and q >= 0.5)


def test_pages_with_clashing_columns_long_text_and_none_at_all(spark):
    schema = "page_id long, url string, html string, host string, rank double, verdict string, src string, kind string"
    long = "x" * 3_000_000 + "<a href='http://spam.net/'>"
    rows = [(1, "http://a.org/", long, "h", 1.0, "v", "s", "k"), (2, "http://spam.net/es/1", None, "h", 1.0, "v", "s", "k"), (None, "http://b.org/x", "", None, None, None, None, None)]
    rows.append(rows[0])
    got = judge_urls(spark.createDataFrame(rows, schema), URL_RULES).select("page_id", "host", "verdict").collect()
    assert collections.Counter(tuple(r) for r in got) == {(1, "a.org", "block"): 2, (2, "spam.net", "block"): 1, (None, "b.org", "allow"): 1}
    assert judge_urls(spark.createDataFrame([], schema), URL_RULES).count() == 0


def test_the_chain_on_no_documents_clashing_columns_and_long_text(spark):
    schema = "doc_id long, text string, junk int, toxic int, p_toxic double, features string, fold int"
    docs = [(i, prose(50 + i, 30) + (" vilest" if i % 2 else ""), 9, 9, 9.0, "f", 1) for i in range(120)] + [(500, "vilest " * 200_000, 9, 9, 9.0, "f", 1), (501, None, None, None, None, None, None), (502, "", 1, 1, 1.0, "", 1)]
    labels = spark.createDataFrame([(i, 0, i % 2, "extra") for i in range(100)], "doc_id long, junk int, toxic int, text string")
    got = {r["doc_id"]: r["p_toxic"] for r in toxicity_chain(spark.createDataFrame(docs, schema), labels, ["junk", "toxic"]).collect()}
    assert len(got) == 123 and got[500] > 0.5 and all((got[i] > 0.5) == bool(i % 2) for i in range(120))
    assert toxicity_chain(spark.createDataFrame([], schema), labels, ["junk", "toxic"]).count() == 0


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node long, label string, row string"


@pytest.mark.parametrize("empty", [True, False])
def test_the_stages_take_nothing_nulls_and_extra_columns(spark, empty):
    given = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id").limit(80).collect()]
    texts = [] if empty else [*given, *given[:3], (None, given[20][1] + " x"), (300, None), (400, ""), (500, prose(5, 9000) + ".")]
    rows = [(i, t, "en", None, None, 1, "x", "r") for i, t in texts]
    docs = spark.createDataFrame(rows, SCHEMA)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMALL)
        assert docs.columns == [c.split()[0] for c in SCHEMA.split(", ")], name
    packed = corpus_pipeline.packing(spark, docs, SMALL).agg(F.count_distinct("doc_id").alias("n"), F.count(F.lit(1)).alias("rows")).first()
    assert (packed["rows"] == 0) == empty and docs.filter("text is null").count() == 0
