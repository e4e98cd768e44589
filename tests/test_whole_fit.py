"""The fit of the registry rows: all trees and bins of the job, in Spark and in SQL."""

import datetime

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as entry
from querybook import base, boosted, learning
from tenorlake.operators import ranking
from tenorlake.plans import boosting, training


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    """Loans with a line of month 0 and one of month 6 each, shipped within the first three windows."""
    rng, n = np.random.default_rng(3), 1500
    to = tmp_path_factory.mktemp("tables")
    days = [datetime.datetime(1995, 1, 1) + datetime.timedelta(days=int(d)) for d in rng.integers(0, 1700, n)]
    orders = {"o_orderkey": np.arange(n), "o_custkey": np.arange(n), "o_orderdate": pa.array(days, pa.timestamp("us"))}
    key = np.repeat(np.arange(n), 2)
    lines = {
        "l_orderkey": key, "l_linenumber": pa.array(np.tile([1, 7], n), pa.int32()), "l_quantity": rng.integers(1, 50, 2 * n).astype(float),
        "l_extendedprice": np.round(rng.random(2 * n) * 1000 + 1, 2), "l_discount": rng.integers(0, 11, 2 * n) / 100, "l_tax": rng.integers(0, 9, 2 * n) / 100,
        "l_returnflag": ["A"] * (2 * n), "l_shipdate": pa.array([days[k] + datetime.timedelta(days=int(d)) for k, d in zip(key, rng.integers(1, 90, 2 * n))], pa.timestamp("us")),
    }
    pq.write_table(pa.table(orders), f"{to}/orders.parquet")
    pq.write_table(pa.table(lines), f"{to}/lineitem.parquet")
    return str(to)


def sql(folder, text):
    db = duckdb.connect()
    for table in ("orders", "lineitem"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return sorted(db.execute(base.with_views("v_pair v_windows", text)).fetchall())


def test_registry_rows_come_from_all_trees_and_bins_of_the_job(spark, folder, monkeypatch):
    grown = []

    def leaf(rows, cuts, *rest):
        grown.append(max(len(c) for c in cuts))
        return {1: boosting.Node(1, 0.0)}

    monkeypatch.setattr(boosting, "_grown", leaf)
    rows = {r.model_id: r for r in entry.queries()["training_metadata"](spark, folder).collect()}
    assert len(grown) == training.BOOSTING_PARAMS["max_iter"] == 100
    assert set(grown) == {boosting.MAX_BINS - 1}
    assert set(rows) == {"model_1", "model_2"} and rows["model_2"].train_roc_auc == 0.5


def test_recursion_fits_the_trees_of_the_text_tree_by_tree(folder, monkeypatch):
    monkeypatch.setattr(boosted, "WHOLE", boosted.OPTIONS)
    metrics = "SELECT split, n, round(accuracy, 9), round(roc_auc, 9) FROM ({})"
    one = sql(folder, boosted.fit_sql(learning.FEATURES, metrics.format(boosted.evaluation_sql())))
    assert one == sql(folder, boosted.whole_fit_sql(learning.FEATURES, metrics.format(boosted.evaluation_sql("margin"))))
    assert dict((r[0], r[3]) for r in one)["train"] > 0.5


def test_registry_rows_match_sql(spark, folder, monkeypatch):
    """A few trees with all bins; the text of the query has them all."""
    few = boosted.WHOLE | {"max_iter": 3}
    assert f"tree < {boosted.WHOLE['max_iter']}" in entry.oracle_sql()["training_metadata"]
    monkeypatch.setattr(boosted, "WHOLE", few)
    got = {r.model_id: r for r in entry.queries()["training_metadata"](spark, folder).collect()}["model_2"]
    want = sql(folder, boosted.whole_fit_sql(learning.FEATURES, f"SELECT split, n, round(accuracy, 6), round(roc_auc, 6) FROM ({boosted.evaluation_sql('margin')})"))
    names = {split: c for c, split in learning.METRICS.items()}
    for split, n, accuracy, auc in want:
        if split in names:
            c = names[split]
            assert (got[f"{c}_samples"], got[f"{c}_accuracy"], got[f"{c}_roc_auc"]) == (n, accuracy, auc)


def test_many_percentiles_of_groups_with_ties_and_nulls(spark):
    rng = np.random.default_rng(9)
    rows = [("a", float(v)) for v in rng.normal(size=700)] + [(None, float(v)) for v in rng.integers(0, 6, 500)] + [("b", 2.0), ("b", None), ("c", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    steps = [i / 64 for i in range(65)]
    for cell in (10, 1_000_000):
        got = {(r.g, r.p): r.percentile for r in ranking.percentiles(df, ["g"], "v", steps, cell).collect()}
        want = {g: [v for k, v in rows if k == g and v is not None] for g in ("a", None, "b")}
        assert got == {(g, p): pytest.approx(float(np.quantile(v, p))) for g, v in want.items() for p in steps}
