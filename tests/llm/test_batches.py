"""Rows reach Python in batches of bounded size, and no result hangs on that size."""

import pyarrow as pa
import pytest

from kithscope.llm.frames import BATCH_BYTES, BATCH_CONF, bounded_batches, carried


@pytest.fixture
def unset(spark):
    old = spark.conf.get(BATCH_CONF, None)
    spark.conf.unset(BATCH_CONF)
    yield spark
    spark.conf.unset(BATCH_CONF)
    if old is not None:
        spark.conf.set(BATCH_CONF, old)


def sizes(batches):
    for b in batches:
        yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], names=["rows", "bytes"])


def test_long_texts_come_in_small_batches(unset):
    docs = unset.range(0, 300, 1, 1).selectExpr("id as doc_id", "repeat('abcd ', 10000) as text")
    seen = carried(docs, "doc_id", "text", True).mapInArrow(sizes, "rows long, bytes long").collect()
    assert sum(r["rows"] for r in seen) == 300
    assert max(r["bytes"] for r in seen) <= BATCH_BYTES + 200_000


def test_a_size_set_before_stays(unset):
    unset.conf.set(BATCH_CONF, "1m")
    bounded_batches(unset)
    assert unset.conf.get(BATCH_CONF) == "1m"


def test_packing_does_not_hang_on_the_size_of_batches(unset):
    tokens = pytest.importorskip("public_tokenizers")
    from kithscope.llm.op2_packing import pack

    docs = unset.range(0, 400, 1, 2).selectExpr("id as doc_id", "repeat('word of text ', cast(1 + id * 7919 % 600 as int)) as text")
    packed = []
    for size in ("20k", "64m"):
        unset.conf.set(BATCH_CONF, size)
        pieces = pack(docs, tokens.path("byte_bpe_50k.json"))
        packed.append(sorted(tuple(r) for r in pieces.select("doc_id", "piece", "start", "length", "offset").collect()))
    assert packed[0] == packed[1]
