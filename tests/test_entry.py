"""The driver contract."""

import importlib

entry_module = importlib.import_module("__spark_entry__")


def test_entry_gives_ranked_rows(spark):
    rows = entry_module.entry(spark).collect()
    scores = [r.final_score for r in rows]
    assert rows and scores == sorted(scores, reverse=True)


def test_sql_keys_are_queries():
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
