"""Relational tables: parquet with explicit schemas, bucketed layout, JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kithscope.schemas import TABLES


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One of the seven relational tables, never with an inferred schema."""
    return spark.read.schema(TABLES[name]).parquet(f"{root.rstrip('/')}/{name}")


def read_jdbc(
    spark: SparkSession, url: str, name: str, split_on: str, low: str, high: str, partitions: int, **options: str
) -> DataFrame:
    """The same table from a database, read in parallel over ranges of a numeric or time column."""
    reader = spark.read.format("jdbc").options(
        url=url, dbtable=name, partitionColumn=split_on, lowerBound=low, upperBound=high,
        numPartitions=str(partitions), fetchsize="10000", **options,
    )
    return reader.load()


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int) -> None:
    """Bucket and sort by the account id, so that later joins on it need no shuffle."""
    (
        df.repartition(buckets, key)
        .write.mode("overwrite")
        .bucketBy(buckets, key)
        .sortBy(key)
        .format("parquet")
        .saveAsTable(table)
    )
