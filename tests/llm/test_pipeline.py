"""The pipeline's stages on the smallest data, each held against plain Python on its own input; queries against their SQL."""

import collections

import pyarrow as pa
import pytest

import corpus_pipeline
from kithscope.llm.op2_packing import ByteTokenizer
from kithscope.llm.op7_near_duplicates import document_frequencies, shingle_weights, shingles, weighted_jaccard
from kithscope.llm.arrays import slices
from kithscope.llm.queries import QUERIES, SQL
from tests.compare import compare, duck
from tests.conftest import SMALL
from tests.llm.fixtures import ALNUM, WORD, lower

tokens = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def stages(spark):
    """The rows before the first stage and after each."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    out = [docs.persist()]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stage(spark, out[-1], SMALL).persist())
    return out


def test_stages_are_five_and_keep_the_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_dedup", "decontamination", "packing"]
    assert all(s.columns == stages[0].columns for s in stages[:5])
    rows = [{r.doc_id for r in s.collect()} for s in stages]
    assert rows[0] > rows[1] == rows[2] > rows[3] >= rows[4] == rows[5]
    assert all(r.n_chars == len(r.text) for r in stages[4].collect())


def test_rejected_documents_are_bad_and_kept_ones_hold_enough_words(spark, stages):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    kept = {r.doc_id for r in stages[1].collect()}
    for r in stages[0].collect():
        if r.doc_id in kept:
            assert len(WORD.findall(r.text)) >= 50 and labels.get(r.doc_id) != 0
        elif labels.get(r.doc_id) == 1:
            assert len(WORD.findall(r.text)) < 50


def test_no_line_of_three_documents_stays_twice(stages):
    def holders(rows):
        found = collections.defaultdict(set)
        for r in rows:
            for line in r.text.split("\n"):
                if len(key := lower(line.strip(" \t\n\x0b\x0c\r"))) >= 20:
                    found[key].add(r.doc_id)
        return found

    before, after = holders(stages[1].collect()), holders(stages[2].collect())
    assert all(after.get(k, set()) == ({max(v)} if len(v) >= 3 else v) for k, v in before.items())


def test_one_document_of_each_class_stays(stages):
    rows = sorted(stages[2].collect())
    weights = shingle_weights(*document_frequencies(stages[2].select("text"), 5))
    sets = []
    for r in rows:
        ((_, _, part),) = slices(pa.array([r.text]))
        sets.append(shingles(part, 5)[1:3])
    label = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if weighted_jaccard(weights, sets[a], sets[b]) >= 0.8:
                lo, hi = sorted((label[a], label[b]))
                label = [lo if x == hi else x for x in label]
    assert {r.doc_id for r in stages[3].collect()} == {rows[i].doc_id for i in set(label)}


def test_no_benchmark_window_is_left(spark, stages):
    windows = set()
    for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect():
        w = ALNUM.findall(lower(r.text))
        windows |= {tuple(w[k : k + 10]) for k in range(len(w) - 9)}
    held = lambda text: any(tuple(w[k : k + 10]) in windows for w in [ALNUM.findall(lower(text))] for k in range(len(w) - 9))
    before = {r.doc_id: r.text for r in stages[3].collect()}
    after = {r.doc_id: r.text for r in stages[4].collect()}
    assert any(map(held, before.values())) and not any(map(held, after.values()))
    assert all(after[i] == t for i, t in before.items() if not held(t))


def test_all_tokens_are_packed(stages):
    plain = ByteTokenizer(tokens.path("byte_bpe_50k.json"))
    length = collections.Counter()
    bins = collections.Counter()
    for r in stages[5].collect():
        length[r.doc_id] += r.length
        bins[r.sequence_id] += r.length
    assert length == {r.doc_id: len(plain.ids(r.text)) // 4 + 1 for r in stages[4].collect()}
    assert max(bins.values()) <= 2048 and len(bins) <= -(-sum(bins.values()) // 2048) + 2


@pytest.mark.parametrize("name", sorted(SQL))
def test_queries_equal_their_sql(spark, name):
    compare(QUERIES[name](spark, SMALL), duck(SMALL), SQL[name])


def test_there_is_a_query_for_each_operator():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 14)]
