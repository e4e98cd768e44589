"""Registered queries against DuckDB. ALL_QUERIES=1 runs every one of them."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from tools.compare import TABLES, rows_of

SF_DIR = "/root/testdata/sf0.001"
SHORT = [
    "label_store", "silver_loan_daily", "quarantine_split", "point_in_time_latest", "trailing_window_features",
    "feature_store", "training_set", "fallback_alignment", "model_metrics", "overall_action", "psi", "exact_percentiles",
]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()) if os.environ.get("ALL_QUERIES") else SHORT)
def test_query_matches_sql(spark, db, name):
    df = entry.queries()[name](spark, SF_DIR)
    result = db.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(columns, result.fetchall())


def test_every_text_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).limit(1).count() == 1


def test_small_files_of_customers_are_dealt_over_tasks_before_the_silver_step(spark, monkeypatch):
    from tenorlake.plans import silver

    parts, process = [], silver.process
    monkeypatch.setattr(silver, "process", lambda df, *rest: parts.append(df.rdd.getNumPartitions()) or process(df, *rest))
    for name in ("silver_rerun", "append_quarantine"):
        entry.queries()[name](spark, SF_DIR)
    assert len(parts) == 3 and min(parts) >= 4
