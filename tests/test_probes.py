"""Cases in which rows were once lost, left over, or on both sides of a split."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tenorlake.operators import metrics, ranking, tables
from tenorlake.plans import build, monitoring, scoring, silver, specs
from tenorlake.sources import documents, lineage, snapshots


def money(spark, *rows):
    return spark.createDataFrame(rows, "Customer_ID string, Annual_Income string, Type_of_Loan string, snapshot_date string")


def sides(spark, root):
    kept = {(r.Customer_ID, str(r.snapshot_date)) for r in silver.read_kept(spark, root).collect()}
    return kept, {(r.Customer_ID, str(r.snapshot_date)) for r in silver.read_quarantine(spark, root).collect()}


def test_a_corrected_row_is_on_one_side_only(spark, tmp_path):
    root = f"{tmp_path}/s"
    for income, kept in (("5", False), ("50000", True), ("5", False)):
        raw = money(spark, ("CUS_0x1", income, None, "2024-01-01"), ("CUS_0x2", "60000", None, "2024-02-01"))
        silver.write(silver.process(raw, specs.FINANCIALS, "2024-12-31"), root, specs.FINANCIALS)
        keep, aside = sides(spark, root)
        assert (("CUS_0x1", "2024-01-01") in keep, ("CUS_0x1", "2024-01-01") in aside) == (kept, not kept)
        assert ("CUS_0x2", "2024-02-01") in keep
    # a run for one snapshot touches no other, and empties its own
    silver.write(silver.process(money(spark), specs.FINANCIALS, "2024-12-31"), root, specs.FINANCIALS, snapshot="2024-01-01")
    assert sides(spark, root) == ({("CUS_0x2", "2024-02-01")}, set())


def test_new_tokens_are_read(spark, tmp_path):
    root = f"{tmp_path}/s"
    for month, words in (("2024-01-01", ["Auto Loan"]), ("2024-02-01", ["Auto Loan", "Home Loan"])):
        raw = money(spark, ("CUS_0x1", "50000", "Home Loan", month))
        silver.write(silver.process(raw, specs.FINANCIALS, "2024-12-31", words), root, specs.FINANCIALS, snapshot=month)
    rows = silver.read_kept(spark, root).orderBy("snapshot_date").collect()
    assert [(r.has_auto_loan, r.has_home_loan, r.Type_of_Loan_tokens) for r in rows] == [(0, 0, ["Home Loan"]), (0, 1, ["Home Loan"])]


def test_odd_partition_values_are_emptied(spark, tmp_path):
    rows = spark.createDataFrame([("a/b:c=%", 1), (None, 2), ("x y", 3)], "k string, v int")
    snapshots.write_snapshots(rows, f"{tmp_path}/t", ("k",))
    snapshots.write_snapshots(rows.where("v = 3"), f"{tmp_path}/t", ("k",), F.lit(True))
    assert [tuple(r) for r in spark.read.parquet(f"{tmp_path}/t").select("k", "v").collect()] == [("x y", 3)]


def loan_lines(*rows):
    head = "loan_id,Customer_ID,loan_start_date,tenure,installment_num,loan_amt,due_amt,paid_amt,overdue_amt,balance,snapshot_date"
    return "\n".join([head, *[f"{c}_2023_01_01,{c},2023-01-01,10,{mob},1000,100,0,{late},900,{day}" for c, mob, late, day in rows]]) + "\n"


def test_a_row_gone_bad_leaves_the_label_store(spark, tmp_path):
    source = tmp_path / "loans.csv"
    good = [("CUS_0x1", 6, 0, "2023-07-01"), ("CUS_0x2", 6, 0, "2023-08-01")]
    source.write_text(loan_lines(*good))
    layout = build.run(spark, {"loan_daily": str(source)}, f"{tmp_path}/lake", "2024-12-31")
    assert spark.read.parquet(layout.gold("label_store")).count() == 2
    source.write_text(loan_lines(good[0]).replace("CUS_0x1", "broken") + loan_lines(good[1]).split("\n", 1)[1])
    build.run(spark, {"loan_daily": str(source)}, f"{tmp_path}/lake", "2024-12-31")
    assert [r.Customer_ID for r in spark.read.parquet(layout.gold("label_store")).collect()] == ["CUS_0x2"]


def test_one_snapshot_reads_and_writes_its_own(spark, tmp_path):
    source = tmp_path / "loans.csv"
    source.write_text(loan_lines(("CUS_0x1", 6, 0, "2023-07-01"), ("CUS_0x2", 6, 0, "2023-08-01")))
    layout = build.run(spark, {"loan_daily": str(source)}, f"{tmp_path}/lake", "2024-12-31")
    source.write_text(loan_lines(("CUS_0x1", 6, 500, "2023-07-01"), ("CUS_0x2", 6, 500, "2023-08-01")))
    build.run(spark, {"loan_daily": str(source)}, f"{tmp_path}/lake", "2024-12-31", snapshot="2023-08-01")
    labels = {r.Customer_ID: r.label for r in spark.read.parquet(layout.gold("label_store")).collect()}
    assert labels == {"CUS_0x1": 0, "CUS_0x2": 1}
    kept = silver.read_kept(spark, layout.silver("loan_daily")).where("snapshot_date = date'2023-08-01'")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert all(f"isnotnull({c}" in plan.split("PartitionFilters: [")[1].split("PushedFilters")[0] for c in ("route", "snapshot_date"))


def test_documents_come_back_whole(spark, tmp_path):
    rows = spark.createDataFrame([("m", f"2024-0{i}-01", 0.5 + i / 10, i) for i in range(1, 6)], "model_id string, snapshot_date string, roc_auc double, total_samples long")
    documents.write_documents(rows.coalesce(1), f"{tmp_path}/d", ("model_id",))
    want = [(f"2024-0{i}-01", 0.5 + i / 10, i, "m") for i in range(1, 6)]
    for multi_line in (False, True):
        back = documents.read_metric_documents(spark, f"{tmp_path}/d", multi_line)
        assert [(str(r.snapshot_date), r.roc_auc, r.total_samples, r.model_id) for r in back.collect()] == want
    text = spark.read.option("recursiveFileLookup", True).text(f"{tmp_path}/d").first().value
    assert '"model_id":"m"' in text


THRESHOLD = "metric string, priority string, name string, business_threshold double, data_science_threshold double, baseline_enabled boolean, reference string, max_degradation_percent double"


def test_thresholds_on_any_metric(spark):
    table = spark.createDataFrame([("m1", "2024-01-01", 0.9, 0.1, 10), ("m2", "2024-01-01", None, None, 10)], "model_id string, snapshot_date string, roc_auc double, mean_prediction_proba double, total_samples long")
    limits = spark.createDataFrame([("mean_prediction_proba", "P0", "Mean score", 0.2, 0.3, False, None, None)], THRESHOLD)
    got = {r.model_id: (r.action, r.metric_summary) for r in monitoring.actions(table, limits).collect()}
    assert got["m1"][0] == "retrain" and got["m1"][1]["mean_prediction_proba"].status == "CRITICAL"
    assert got["m2"] == ("monitor", {})


def scored_rows(spark, *rows):
    return spark.createDataFrame(rows, "loan_id string, Customer_ID string, inference_date string, prediction_proba double, prediction_label int").selectExpr(
        "loan_id", "Customer_ID", "date(inference_date) inference_date", "prediction_proba", "prediction_label", "'m' model_id", "'t' model_type"
    )


def outcome_rows(spark, *rows):
    return spark.createDataFrame(rows, "loan_id string, Customer_ID string, label int, snapshot_date string").withColumn("snapshot_date", F.to_date("snapshot_date"))


def test_monitor_falls_back_and_tells_of_empty_joins(spark):
    labels = outcome_rows(spark, ("a_2024_01_01", "a", 1, "2024-07-01"), ("b_2024_01_01", "b", 0, "2024-07-01"), ("c_2024_02_01", "c", 1, "2024-09-01"))
    scores = scored_rows(spark, ("a_2024_01_01", "a", "2024-01-01", 0.9, 1), ("b_2024_01_01", "b", "2024-01-01", 0.2, 0), ("c_2024_02_01", "c", "2024-02-01", 0.7, 1))
    offset = monitoring.monitor(scores, labels).collect()
    assert [(str(r.snapshot_date), r.total_samples, r.roc_auc) for r in offset] == [("2024-07-01", 2, 1.0)]
    both = sorted((str(r.snapshot_date), str(r.prediction_snapshot_date), r.total_samples) for r in monitoring.monitor(scores, labels, align="fallback").collect())
    assert both == [("2024-07-01", "2024-01-01", 2), ("2024-09-01", "2024-02-01", 1)]
    with pytest.raises(monitoring.NothingPaired, match="2024, 9, 1.*a_2024_01_01"):
        monitoring.monitor(scores, labels.where("loan_id like 'c%'"))
    with pytest.raises(ValueError):
        monitoring.monitor(scores, labels, align="nearest")


def test_backfill_takes_the_whole_month(spark, monkeypatch):
    rows = spark.createDataFrame([("a", "2024-01-01"), ("b", "2024-01-15"), ("c", "2024-01-31"), ("d", "2024-02-01")], "loan_id string, d string").select("loan_id", F.to_date("d").alias("snapshot_date"))
    monkeypatch.setattr(scoring, "score", lambda model, rows, names, model_id, date_column: rows)
    there = spark.createDataFrame([("m", "2024-02-01")], "model_id string, d string").select("model_id", F.to_date("d").alias("month"))
    got = scoring.backfill({"m": (None, [])}, rows, there, F.lit("2024-02-01").cast("date"), 3)
    assert sorted(r.loan_id for r in got.collect()) == ["a", "b", "c"]


def test_medians_of_small_cells_and_missed_brackets(spark):
    rng = np.random.default_rng(4)
    values = np.c_[rng.normal(size=4_000), rng.integers(0, 3, size=4_000), rng.random(4_000)]
    df = spark.createDataFrame([(*r, None) for r in values.tolist()], "a double, b double, c double, none double").repartition(5)
    want = {n: pytest.approx(float(np.median(values[:, i]))) for i, n in enumerate("abc")}
    for options in ({"rows_per_cell": 7}, {"slack": 0.0}, {"accuracy": 20, "slack": 0.001, "rows_per_cell": 10}):
        got = {r.feature: r["median"] for r in ranking.column_medians(df, ["a", "b", "c", "none"], **options).collect()}
        assert got == want
    assert {r.feature: r["median"] for r in tables.column_stats(df, ["a", "none"]).collect()} == {"a": want["a"]}


def test_any_number_of_splitters(spark):
    df = spark.range(20_000).select((F.col("id") * 7 % 20_011).cast("double").alias("v"))
    cuts = ranking.splitters(df, "v", 2)
    placed = ranking.with_bucket(df, "v", cuts).groupBy("_bucket").count()
    assert df.select(F.size(cuts)).first()[0] > 8_191 and placed.agg(F.max("count")).first()[0] < 60


def test_null_labels_are_in_neither_class(spark):
    df = spark.createDataFrame([(1, 1), (0, 0), (None, 1)], "label int, prediction_label int")
    row = df.agg(*metrics.class_counts()).first()
    assert (row.total_samples, row.actual_positives, row.actual_negatives, row.predicted_positives) == (3, 1, 1, 2)


class _Settings:
    """A session of which only settings and master are asked."""

    def __init__(self, master, **values):
        self.conf = self.sparkContext = self
        self.master, self.values = master, values

    def get(self, key, default=None):
        return self.values.get(key.replace(".", "_"), default)

    def getConf(self):
        return self


def test_shared_folder_is_never_a_machines_own():
    assert lineage.shared_folder(_Settings("yarn", spark_checkpoint_dir="hdfs://x/y/")) == "hdfs://x/y"
    assert lineage.shared_folder(_Settings("yarn"), "s3://given") == "s3://given"
    assert lineage.shared_folder(_Settings("yarn", spark_sql_warehouse_dir="hdfs://w")) == "hdfs://w/_settled"
    assert lineage.shared_folder(_Settings("local[4]", spark_sql_warehouse_dir="file:/w")) == "file:/w/_settled"
    with pytest.raises(ValueError, match=lineage.SETTING):
        lineage.shared_folder(_Settings("spark://h:1", spark_sql_warehouse_dir="file:/w"))


def test_settled_tables_can_be_removed(spark):
    table = lineage.settled(spark.range(5))
    folder = table.inputFiles()[0].rpartition("/")[0]
    lineage.discard(table)
    assert snapshots.read_optional(spark, folder) is None
