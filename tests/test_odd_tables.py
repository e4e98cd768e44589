"""Queries against DuckDB on tables with values the test tables lack."""

import os
from fractions import Fraction

import duckdb
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tenorlake.functions import numeric
from tenorlake.operators import tables
from tenorlake.plans import training
from tools.compare import rows_of


def compared(spark, folder, name, **tables):
    """Columns and rows of a query and of its SQL on the given tables, each a SQL text."""
    con = duckdb.connect()
    for table, sql in tables.items():
        path = os.path.join(folder, f"{table}.parquet")
        con.execute(f"COPY ({sql}) TO '{path}' (FORMAT parquet)")
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    df = entry.queries()[name](spark, str(folder))
    want = con.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in want.description]
    return rows_of(df.columns, [tuple(r) for r in df.collect()]), rows_of(columns, want.fetchall())


def test_ages_near_zero(spark, tmp_path):
    balances = "0.01, -0.04, 0.03, 0.0, -0.01, 899.99, 900.0, -60.0, 9000.5"
    customer = f"SELECT row_number() OVER () AS c_custkey, unnest([{balances}])::DOUBLE AS c_acctbal, 'MACHINERY' AS c_mktsegment, 0 AS c_nationkey"
    got, want = compared(spark, tmp_path, "silver_attributes", customer=customer, nation="SELECT 0 AS n_nationkey, 0 AS n_regionkey")
    assert len(want) == 9 and got == want


def test_means_do_not_depend_on_the_order_of_rows(spark):
    """One large value first or last: plain sums lose the small ones in one order and keep them in another."""
    values = [1e16, *[1.0] * 1000, -1e16, 0.1, 0.2, 0.3]
    want = float(sum(map(Fraction, values)) / len(values))
    for own in (values, values[::-1], sorted(values)):
        df = spark.createDataFrame([(v, None) for v in own], "a double, none double").coalesce(1)
        rows = tables.column_stats(df, ["a", "none"]).collect()
        assert [(r.feature, r.n, r["mean"], r["median"]) for r in rows] == [("a", len(values), want, 1.0)]


def test_stats_read_their_source_once(spark):
    df, rows = counting(spark.range(1000, numPartitions=2).selectExpr("cast(id as double) a", "cast(id % 7 as double) b"))
    assert {r.feature: r["median"] for r in tables.column_stats(df, ["a", "b"]).collect()} == {"a": 499.5, "b": 3.0}
    assert rows.value == 1000


def counting(df):
    """The rows, and an accumulator of how many have been read from them."""
    rows = df.sparkSession.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            rows.add(batch.num_rows)
            yield batch

    return df.mapInArrow(seen, df.schema), rows


def test_models_share_their_rows(spark):
    """Two models and their preprocessing read the features once."""
    windows = [{"split": s, "start_date": f"2023-0{i}-01", "end_date": f"2023-0{i}-28"} for i, s in ((1, "train"), (2, "validation"))]
    base = spark.range(400, numPartitions=2).selectExpr(
        "concat('L', id) loan_id", "concat('C', id) Customer_ID", "make_date(2023, cast(1 + id % 2 as int), 5) snapshot_date",
        "pmod(id * 37, 101) / 10D x", "cast(pmod(hash(id), 7) as double) y", "'word' words", "cast(pmod(hash(id, 1), 3) = 0 as int) label", "'d' label_def")
    features, read = counting(base.select("loan_id", "Customer_ID", "snapshot_date", "x", "y", "words"))
    labels = base.select("loan_id", "Customer_ID", "label", "label_def")
    models = {"model_1": {}, "model_2": {"max_iter": 2, "subsample": 1.0}}
    fits = training.train_all(features, labels, windows, models, "2023-12-31")
    assert read.value == 400
    assert [f.preprocessing.features for f in fits.values()] == [("x", "y")] * 2
    for model_id, params in models.items():
        alone = training.train(base.select("loan_id", "Customer_ID", "snapshot_date", "x", "y", "words"), labels, windows, model_id, "2023-12-31", **params)
        assert sorted(alone.evaluation.collect()) == sorted(fits[model_id].evaluation.collect())
    rows, read = counting(base.select("x", "y"))
    training.fit_preprocessing(rows, ["x", "y"])
    assert read.value == 400


def test_texts_as_numbers(spark):
    raw = [" 1.5 ", "-inf", "Infinity", "NaN", "A", "", "1e3", ".5", "5d", "x1", None, "\t7\n", "+nan", "1.0E400"]
    df = spark.createDataFrame([(v,) for v in raw], "x string")
    plain = F.col("x").try_cast("double")
    got = df.select(numeric.to_number(F.col("x"), "string"), F.when(~F.isnan(plain), plain)).collect()
    assert [r[0] for r in got] == [r[1] for r in got]
    assert [r[0] for r in got][:2] == [1.5, float("-inf")]


def test_rows_of_a_small_file_are_dealt(spark, tmp_path):
    """One split per file would leave the work on all its rows to one core."""
    spark.range(2000).selectExpr("id p_partkey").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    rows = entry.queries()["silver_financials_rows"](spark, str(tmp_path))
    held = rows.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    assert len(held) >= spark.sparkContext.defaultParallelism and sum(r["count"] for r in held) == 2000
