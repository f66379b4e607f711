"""Registry of runnable queries, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from kithscope.plans.oracle import oracle
from kithscope.plans.workspace import Workspace

Build = Callable[[Workspace], DataFrame]


class Catalog:
    def __init__(self) -> None:
        self.builders: dict[str, Build] = {}
        self.sql: dict[str, str] = {}

    def query(self, name: str, sql: str | None = None, **views: str) -> Callable[[Build], Build]:
        """Register a query; ``sql`` may name any shared view, or one given as a keyword."""

        def add(build: Build) -> Build:
            if name in self.builders:
                raise ValueError(f"query {name} registered twice")
            self.builders[name] = build
            if sql is not None:
                self.sql[name] = oracle(sql, **views)
            return build

        return add
