"""All queries of the library by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from kithscope.plans import account_queries, evaluation_queries, label_queries, relation_queries, state_queries, stream_queries
from kithscope.plans.catalog import Build
from kithscope.plans.workspace import Workspace

CATALOGS = [account_queries.catalog, relation_queries.catalog, evaluation_queries.catalog, state_queries.catalog, label_queries.catalog, stream_queries.catalog]


def _bind(build: Build) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: build(Workspace(spark, sf_dir))


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _bind(build) for catalog in CATALOGS for name, build in catalog.builders.items()}


def all_sql() -> dict[str, str]:
    return {name: sql for catalog in CATALOGS for name, sql in catalog.sql.items()}
