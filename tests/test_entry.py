"""Driver contract: entry smoke, registered queries and oracle keys."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402


def test_oracles_only_for_registered_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) >= 40


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) >= 1
    assert {"feature", "kind", "statistic", "p_value"} <= set(df.columns)
