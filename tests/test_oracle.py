"""Spark queries vs. their DuckDB oracle SQL on the smallest scale."""

import os
import sys

import duckdb
import pytest

import __spark_entry__ as entry

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
from oracle_check import TABLES, rows_of  # noqa: E402

SF = "/root/testdata/sf0.001"
NAMES = [
    "cosine_run", "rules_time_window", "rules_full_history", "preference_scores", "column_profile",
    "fill_item_from_resource", "segment_recommendations", "user_frequent_priors", "dense_index", "read_results",
    "fill_item_dedupe_map", "segment_recommendations_unseen", "rules_time_window_holdout", "compare_run",
]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    res = duck.execute(entry.oracle_sql()[name])
    want = rows_of([d[0] for d in res.description], res.fetchall())
    assert sorted(df.columns) == sorted(d[0] for d in res.description)
    assert got == want
