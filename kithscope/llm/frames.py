"""Small helpers of the operators: carried rows and tables written to the shared folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kithscope.session import scratch_path

BATCH_BYTES = 4 << 20
BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Rows go to Python in batches of about ``BATCH_BYTES`` (a longer row alone), for the session, unless it has a size of its own.

    Of Spark's 64 MB, the JVM holds the doubling buffers and the worker the batch, once per core and beside the heap. Batches are
    made when a plan runs, also after an operator has returned, so the setting stays.
    """
    if spark.conf.get(BATCH_CONF, None) is None:
        spark.conf.set(BATCH_CONF, str(BATCH_BYTES))


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written below ``spark.checkpoint.dir`` and read again: computed once, no lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def carried(docs: DataFrame, id_col: str, text_col: str, carry: bool) -> DataFrame:
    """(row, doc_id, text): the input columns travel inside one struct, so none can clash with an operator's own."""
    bounded_batches(docs.sparkSession)
    row = F.struct(*[docs[c] for c in docs.columns]) if carry else F.lit(None).cast("boolean")
    return docs.select(row.alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def carried_schema(docs: DataFrame, carry: bool, *fields: tuple[str, T.DataType]) -> T.StructType:
    row = T.StructField("row", docs.schema if carry else T.BooleanType())
    return T.StructType([row, *(T.StructField(n, t) for n, t in fields)])


def with_text(text: Column, columns: list[str], text_col: str = "text") -> list[Column]:
    """The carried row's columns with another text (and its length, where documents have ``n_chars``)."""
    out = []
    for c in columns:
        if c == text_col:
            out.append(text.alias(c))
        elif c == "n_chars":
            out.append(F.length(text).cast("long").alias(c))
        else:
            out.append(F.col("row").getField(c).alias(c))
    return out
