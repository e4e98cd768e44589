import datetime as dt

import pytest
from pyspark.sql import functions as F

from tenorlake.operators import trends
from tenorlake.plans import monitoring, training
from tenorlake.sources import config

DAY = dt.date(2024, 6, 1)
COLUMNS = "model_id string, snapshot_date date, roc_auc double, accuracy double, f1_score double, precision double, recall double, total_samples bigint"


def table(spark, rows):
    return spark.createDataFrame(rows, COLUMNS)


def row(model, day, auc, accuracy=0.9, f1=0.9, precision=0.9, recall=0.9, n=100):
    return (model, day, auc, accuracy, f1, precision, recall, n)


def checked(spark, rows, baselines=None, overrides=None):
    values = monitoring.metric_rows(table(spark, rows), [t[0] for t in config.DEFAULT_THRESHOLDS])
    limited = monitoring.with_limits(values, config.default_thresholds(spark), baselines, overrides)
    return monitoring.evaluate(limited)


def test_status_at_the_limits(spark):
    rows = [row(f"m{i}", DAY, v) for i, v in enumerate((0.75, 0.7499, 0.80, 0.7999))]
    out = checked(spark, rows).where("metric = 'roc_auc'").orderBy("model_id").collect()
    assert [r.status for r in out] == ["WARNING", "CRITICAL", "OK", "WARNING"]
    assert out[1].alert == "❌ ROC-AUC (0.7499) below BUSINESS threshold (0.7500)"


def test_degradation_from_baseline(spark):
    baselines = spark.createDataFrame([("m", 0.8472, 0.9)], "model_id string, oot_roc_auc double, oot_accuracy double")
    out = {r.metric: r for r in checked(spark, [row("m", DAY, 0.80)], baselines).collect()}
    assert (out["roc_auc"].status, out["accuracy"].status, out["f1_score"].status) == ("WARNING", "OK", "OK")
    assert out["roc_auc"].alert == "⚠️  ROC-AUC degraded 5.6% from oot_roc_auc baseline (0.8472)"
    assert out["roc_auc"].degradation == pytest.approx(0.0557, abs=1e-4)


def test_overall_action(spark):
    rows = [
        row("all_fine", DAY, 0.9), row("only_f1", DAY, 0.9, f1=0.1), row("warned", DAY, 0.78),
        row("critical", DAY, 0.78, accuracy=0.5), row("no_auc", DAY, None),
    ]
    out = {r.model_id: r for r in monitoring.overall_action(checked(spark, rows)).collect()}
    assert {m: r.action for m, r in out.items()} == {
        "all_fine": "monitor", "only_f1": "monitor", "warned": "active_monitoring", "critical": "retrain", "no_auc": "monitor",
    }
    assert out["critical"].alerts == ["❌ Accuracy (0.5000) below BUSINESS threshold (0.7000)"]
    assert out["only_f1"].alerts == [monitoring.HEALTHY_ALERT]


def test_decision_for_the_newest_snapshot(spark):
    rows = [row("m", DAY, 0.5), row("m", DAY.replace(month=7), 0.9, n=7)]
    decision = monitoring.actions(table(spark, rows), config.default_thresholds(spark)).collect()
    assert [(d.action, d.total_samples, d.monitoring_file) for d in decision] == [("monitor", 7, "unknown")]
    assert decision[0].metric_summary["recall"].status == "OK"


def test_overrides(spark):
    own = spark.createDataFrame(
        [("m", "roc_auc", 0.4, None)], "model_id string, metric string, business_threshold double, data_science_threshold double"
    )
    out = checked(spark, [row("m", DAY, 0.5), row("other", DAY, 0.5)], overrides=own).where("metric = 'roc_auc'")
    assert {r.model_id: r.status for r in out.collect()} == {"m": "WARNING", "other": "CRITICAL"}


def test_trends(spark):
    rows = [row("m", DAY.replace(month=i), a) for i, a in ((1, 0.9), (2, None), (3, 0.95), (4, 0.7))] + [row("single", DAY, 0.5)]
    df = table(spark, rows)
    first = trends.first_to_last(df).collect()
    assert [(r.model_id, r.roc_auc_trend, r.accuracy_trend, r.n_dates) for r in first] == [("m", "degrading", "stable", 4)]
    steps = trends.step_changes(df, "snapshot_date").orderBy("from_period").collect()
    assert [(r.from_period.month, r.to_period.month, r.tag) for r in steps] == [(1, 3, "improving"), (3, 4, "degrading")]
    assert {r.model_id: r.trend for r in trends.overall_trend(df, "snapshot_date").collect()} == {"m": "degrading", "single": "stable"}
    assert trends.argmax(df).first().best_model_id == "m"
    assert monitoring.model_comparison(df).count() == 0


def test_oot_degradation(spark):
    df = spark.createDataFrame(
        [("m", "validation", 0.85), ("m", "oot", 0.84), ("m", "oot1", 0.82), ("m", "oot2", 0.7), ("m", "oot3", None), ("m", "train", 0.9)],
        "model_id string, split string, roc_auc double",
    )
    assert {r.split: r.status for r in trends.oot_degradation(df).collect()} == {
        "oot": "stable", "oot1": "moderate", "oot2": "significant", "oot3": None,
    }


def test_promotion_and_selection(spark):
    columns = "model_id string, train_roc_auc double, val_roc_auc double, val_accuracy double, test_roc_auc double, oot_roc_auc double, val_samples bigint"
    df = spark.createDataFrame(
        [("a", 0.85, 0.84, 0.7, 0.835, 0.825, 500), ("b", 0.95, 0.84, 0.8, 0.835, 0.825, 500), ("c", 0.9, 0.99, 0.9, 0.9, None, 50)], columns
    )
    assert {r.model_id: r.promote for r in training.promotion_check(df).collect()} == {"a": True, "b": False, "c": False}
    current = spark.createDataFrame([("a", 0.82)], "model_id string, oot_roc_auc double")
    assert {r.model_id: r.better_than_current for r in training.promotion_check(df, current).collect()} == {"a": False, "b": True, "c": True}
    assert training.select_model(df).first().model_id == "b"


def test_rollback_classes(spark):
    base = spark.createDataFrame([("m", 0.8)], "model_id string, oot_roc_auc double")
    rows = [row("m", DAY.replace(day=i), a) for i, a in ((1, 0.6), (2, 0.71), (3, 0.75), (4, 0.79), (5, 0.9))]
    out = monitoring.rollback_class(table(spark, rows), base).orderBy("snapshot_date").collect()
    assert [r.rollback for r in out] == ["critical", "high", "medium", "low", "low"]


def test_monitoring_needs_matching_months(spark):
    labels = spark.createDataFrame(
        [("a", "c", 1, "30dpd_6mob", DAY), ("b", "c", 0, "30dpd_6mob", DAY), ("z", "c", 0, "30dpd_6mob", DAY)],
        "loan_id string, Customer_ID string, label int, label_def string, snapshot_date date",
    )
    scores = [(i, "c", p, int(p > 0.5), "m", "t", d) for i, p, d in (("a", 0.9, "2023-12-01"), ("b", 0.2, "2023-12-01"), ("z", 0.9, "2024-01-01"))]
    predictions = spark.createDataFrame(
        scores, "loan_id string, Customer_ID string, prediction_proba double, prediction_label int, model_id string, model_type string, d string"
    ).withColumn("inference_date", F.col("d").cast("date"))
    out = monitoring.monitor(predictions, labels).collect()
    assert [(r.total_samples, r.roc_auc, r.accuracy, str(r.prediction_snapshot_date)) for r in out] == [(2, 1.0, 1.0, "2023-12-01")]
