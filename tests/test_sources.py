import json

from pyspark.sql import functions as F

from tenorlake.plans import bronze, silver, specs
from tenorlake.sources import config, documents, lineage, snapshots
from tenorlake.streaming import catchup


def test_snapshots_are_replaced_not_appended(spark, tmp_path):
    root = f"{tmp_path}/t"
    months = F.expr("add_months(date'2024-01-01', cast(id % 3 as int))")
    df = spark.range(90).withColumn("snapshot_date", months)
    snapshots.write_snapshots(df, root)
    snapshots.write_snapshots(df.where("id < 3"), root)
    assert spark.read.parquet(root).count() == 3
    snapshots.write_snapshots(df, root)
    snapshots.write_snapshots(df.where("snapshot_date = date'2024-02-01' and id < 10"), root)
    counts = {str(r.snapshot_date): r["count"] for r in spark.read.parquet(root).groupBy("snapshot_date").count().collect()}
    assert counts == {"2024-01-01": 30, "2024-02-01": 3, "2024-03-01": 30}
    assert snapshots.read_snapshots(spark, root, on="2024-02-01").count() == 3
    assert snapshots.read_snapshots(spark, root, up_to="2024-02-01").count() == 33
    plan = snapshots.read_snapshots(spark, root, on="2024-02-01")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan
    assert snapshots.read_glob(spark, f"{root}/snapshot_date=*").count() == 63


def test_optional_and_listed_tables(spark, tmp_path):
    assert snapshots.read_optional(spark, f"{tmp_path}/nothing") is None
    spark.range(5).repartition(2).write.parquet(f"{tmp_path}/base/a.parquet")
    snapshots.write_snapshots(spark.range(5).withColumn("snapshot_date", F.lit("2024-01-01").cast("date")), f"{tmp_path}/base/b")
    assert snapshots.read_optional(spark, f"{tmp_path}/base/a.parquet").count() == 5
    found = {r.table_name: r.n_files for r in snapshots.list_tables(spark, f"{tmp_path}/base").collect()}
    assert found == {"a.parquet": 2, "b": 1}


def test_bronze_from_csv(spark, tmp_path):
    (tmp_path / "in.csv").write_text("loan_id,snapshot_date,amount\na,2024-01-01,1\nb,1/1/24,\nc,2024-02-01,x\nd,junk,2\n")
    kept = bronze.ingest(spark, f"{tmp_path}/in.csv", f"{tmp_path}/one", "2024-01-01")
    assert sorted(r.loan_id for r in kept.collect()) == ["a", "b"]
    bronze.ingest(spark, f"{tmp_path}/in.csv", f"{tmp_path}/all")
    assert spark.read.parquet(f"{tmp_path}/all").count() == 4
    whole = bronze.ingest(spark, f"{tmp_path}/in.csv", f"{tmp_path}/raw", date_column=None)
    assert whole.count() == 4 and dict(whole.dtypes)["amount"] == "string"
    declared = snapshots.read_csv(spark, f"{tmp_path}/in.csv", ["loan_id", "snapshot_date", "amount"])
    assert declared.count() == 4


def test_csv_sink(spark, tmp_path):
    df = spark.range(6).withColumn("snapshot_date", F.expr("add_months(date'2024-01-01', cast(id % 2 as int))"))
    snapshots.write_csv_snapshots(df, f"{tmp_path}/csv")
    assert spark.read.option("header", True).csv(f"{tmp_path}/csv").count() == 6


def test_silver_writes_are_repeatable(spark, tmp_path):
    raw = spark.createDataFrame(
        [("CUS_0x1", "50000", "2024-01-01"), ("CUS_0x2", "5", "2024-01-01"), ("CUS_0x3", "6", "2024-02-01"), ("x", "50000", "2024-02-01")],
        "Customer_ID string, Annual_Income string, snapshot_date string",
    )
    for _ in range(2):
        silver.write(silver.process(raw, specs.FINANCIALS, "2024-12-31"), f"{tmp_path}/s", specs.FINANCIALS)
    assert [r.Customer_ID for r in silver.read_kept(spark, f"{tmp_path}/s").collect()] == ["CUS_0x1"]
    aside = silver.read_quarantine(spark, f"{tmp_path}/s").collect()
    assert sorted((r.Customer_ID, r.source, r.rule) for r in aside) == [
        ("CUS_0x2", "financials", "within_Annual_Income"), ("CUS_0x3", "financials", "within_Annual_Income"),
    ]


def test_new_files_only(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()

    def run():
        catchup.ingest_new_files(spark, str(source), ["id", "snapshot_date"], f"{tmp_path}/out", f"{tmp_path}/progress").awaitTermination()
        return spark.read.parquet(f"{tmp_path}/out").count()

    (source / "1.csv").write_text("id,snapshot_date\na,2024-01-01\nb,2024-02-01\n")
    assert run() == 2
    assert run() == 2
    (source / "2.csv").write_text("id,snapshot_date\nc,2024-03-01\n")
    assert run() == 3


def test_metric_documents(spark, tmp_path):
    for month, auc in (("07", 0.8), ("06", None)):
        doc = {"model_id": "m", "roc_auc": auc, "accuracy": 0.7, "total_samples": 5, "snapshot_date": f"2024-{month}-01", "monitoring_timestamp": "2024-08-01 10:00:00"}
        (tmp_path / f"m_metrics_2024_{month}_01.json").write_text(json.dumps(doc, indent=2))
    rows = documents.read_metric_documents(spark, str(tmp_path), multi_line=True).collect()
    assert [(str(r.snapshot_date), r.roc_auc, r.source_file) for r in rows] == [
        ("2024-06-01", None, "m_metrics_2024_06_01.json"), ("2024-07-01", 0.8, "m_metrics_2024_07_01.json"),
    ]


def test_configuration_tables(spark, tmp_path):
    limits = {
        "metrics": {
            "roc_auc": {
                "priority": "P0", "name": "ROC-AUC", "business_threshold": 0.75, "data_science_threshold": 0.8,
                "baseline_comparison": {"enabled": True, "reference": "oot_roc_auc", "max_degradation_percent": 5.0},
            },
            "recall": {"priority": "P3", "name": "Recall", "business_threshold": None, "data_science_threshold": 0.65, "baseline_comparison": {"enabled": False}},
        },
        "historical_baselines": {"description": "text", "model_1": {"oot_roc_auc": 0.82, "oot_accuracy": 0.76, "test_roc_auc": 0.83, "test_accuracy": 0.75}},
        "model_specific_overrides": {
            "description": "text",
            "model_1": {"enabled": True, "overrides": {"roc_auc": {"business_threshold": 0.7, "data_science_threshold": 0.75}}},
            "model_2": {"enabled": False, "overrides": {}},
        },
    }
    path = tmp_path / "limits.json"
    path.write_text(json.dumps(limits, indent=1))
    rows = {r.metric: r for r in config.read_thresholds(spark, str(path)).collect()}
    defaults = {r.metric: r for r in config.default_thresholds(spark).collect()}
    assert rows["roc_auc"] == defaults["roc_auc"] and rows["recall"] == defaults["recall"]
    assert [tuple(r) for r in config.read_historical_baselines(spark, str(path)).collect()] == [("model_1", 0.82, 0.76, 0.83, 0.75)]
    assert [tuple(r) for r in config.read_threshold_overrides(spark, str(path)).collect()] == [("model_1", "roc_auc", 0.7, 0.75)]

    path = tmp_path / "training.json"
    windows = {"train": {"start_date": "2023-01-01", "end_date": "2023-12-01", "description": "x"}, "oot": {"start_date": "2024-05-01", "end_date": "2024-05-01"}, "description": "text"}
    relative = {"description": "t", "train": {"months_back": 12}, "validation": {"months_after_train_end": 3}, "test": {"months_after_validation_end": 2}, "oot": {"months_after_test_end": 1}}
    path.write_text(json.dumps({"temporal_window_mode": "relative", "temporal_splits": windows, "relative_windows": relative}))
    assert sorted((r.split, str(r.end_date)) for r in config.read_windows(spark, str(path)).collect()) == [("oot", "2024-05-01"), ("train", "2023-12-01")]
    assert tuple(config.read_window_mode(spark, str(path)).first()) == ("relative", 12, 3, 2, 1)
    assert {w["split"]: w["start_date"] for w in config.training_windows(spark, str(path))} == {"train": "2023-01-01", "oot": "2024-05-01"}
    moved = {w["split"]: w["start_date"] for w in config.training_windows(spark, str(path), "2024-06-01")}
    assert moved == {"train": "2023-01-01", "validation": "2024-01-01", "test": "2024-04-01", "oot": "2024-06-01"}


def test_settled_rows_are_read_from_the_shared_folder(spark):
    shared = spark.conf.get(lineage.SETTING)
    table = lineage.settled(spark.range(10).withColumn("x", F.lit(1)))
    assert table.count() == 10
    assert all(f.startswith(f"file://{shared}") for f in table.inputFiles())


def test_inspection(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    rows = {r.column_name: r for r in snapshots.inspect_table(df, ["a", "c"]).collect()}
    assert (rows["a"].data_type, rows["a"].n_filled, rows["b"].n_filled, rows["c"].data_type, rows["c"].is_present) == ("int", 2, 1, None, False)
    assert rows["a"].n_rows == 2


def test_braces_and_escapes_inside_strings_do_not_part_documents(spark, tmp_path):
    kinds = ["a} {b", 'quoted "} {" text', "back\\", 'both \\"} {', "} {", ""]
    one = [json.dumps({"model_id": f"m{i}", "model_type": k, "snapshot_date": "2024-01-01"}, indent=1) for i, k in enumerate(kinds)]
    (tmp_path / "m.json").write_text("\n".join(one[:3]) + one[3] + " \n\n " + "".join(one[4:]) + "\n")
    rows = documents.read_metric_documents(spark, str(tmp_path), multi_line=True).collect()
    assert [(r.model_id, r.model_type) for r in rows] == [(f"m{i}", k) for i, k in enumerate(kinds)]
