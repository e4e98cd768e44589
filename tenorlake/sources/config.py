"""Thresholds, baselines and split windows: JSON files to tables, and built-in defaults."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenorlake.functions import dates

THRESHOLD_SCHEMA = (
    "metric string, priority string, name string, business_threshold double, data_science_threshold double, "
    "baseline_enabled boolean, reference string, max_degradation_percent double"
)

# Monitored metrics with priority, business and data-science limit,
# and the largest accepted drop from the out-of-time baseline.
DEFAULT_THRESHOLDS = (
    ("roc_auc", "P0", "ROC-AUC", 0.75, 0.80, True, "oot_roc_auc", 5.0),
    ("accuracy", "P1", "Accuracy", 0.70, 0.75, True, "oot_accuracy", 5.0),
    ("f1_score", "P2", "F1-Score", None, 0.60, False, None, None),
    ("precision", "P3", "Precision", None, 0.60, False, None, None),
    ("recall", "P3", "Recall", None, 0.65, False, None, None),
)

# Limits of the score distribution against its baseline.
DEFAULT_DRIFT_LIMITS = {"mean_prediction_proba": 0.15, "std_prediction_proba": 0.20}

# The dated training windows, both ends inclusive.
DEFAULT_WINDOWS = (
    {"split": "train", "start_date": "2023-01-01", "end_date": "2023-12-01"},
    {"split": "validation", "start_date": "2024-01-01", "end_date": "2024-02-01"},
    {"split": "test", "start_date": "2024-03-01", "end_date": "2024-04-01"},
    {"split": "oot", "start_date": "2024-05-01", "end_date": "2024-05-01"},
)

# Months per window when windows are stacked back from a snapshot.
DEFAULT_WINDOW_MONTHS = {"train": 12, "validation": 3, "test": 2, "oot": 1}

BASELINE_FIELDS = ("oot_roc_auc", "oot_accuracy", "test_roc_auc", "test_accuracy")


def default_thresholds(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(DEFAULT_THRESHOLDS), THRESHOLD_SCHEMA)


def _document(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).json(path)


def _entries(spark: SparkSession, path: str, section: str, entry: str) -> DataFrame:
    """The (key, struct) rows of a JSON object that may also hold plain text entries."""
    doc = _document(spark, path, f"{section} map<string, string>")
    rows = doc.select(F.explode(section).alias("key", "body"))
    return rows.where("body like '{%'").select("key", F.from_json("body", entry).alias("e"))


def read_thresholds(spark: SparkSession, path: str) -> DataFrame:
    """Threshold document to one row per metric."""
    entry = (
        "priority string, name string, business_threshold double, data_science_threshold double, "
        "baseline_comparison struct<enabled:boolean, reference:string, max_degradation_percent:double>"
    )
    return _entries(spark, path, "metrics", entry).select(
        F.col("key").alias("metric"), "e.priority", "e.name", "e.business_threshold", "e.data_science_threshold",
        F.coalesce(F.col("e.baseline_comparison.enabled"), F.lit(False)).alias("baseline_enabled"),
        "e.baseline_comparison.reference", "e.baseline_comparison.max_degradation_percent",
    )


def read_threshold_overrides(spark: SparkSession, path: str) -> DataFrame:
    """Per-model limits that are switched on: (model_id, metric, two limits)."""
    limits = "struct<business_threshold:double, data_science_threshold:double>"
    models = _entries(spark, path, "model_specific_overrides", f"enabled boolean, overrides map<string, {limits}>")
    rows = models.where("e.enabled").select(F.col("key").alias("model_id"), F.explode("e.overrides").alias("metric", "l"))
    return rows.select("model_id", "metric", "l.*")


def read_historical_baselines(spark: SparkSession, path: str) -> DataFrame:
    """Baselines stored in the threshold document, one row per model."""
    fields = ", ".join(f"{f} double" for f in BASELINE_FIELDS)
    models = _entries(spark, path, "historical_baselines", fields)
    return models.select(F.col("key").alias("model_id"), "e.*")


def read_training_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Training metadata documents to one row of baselines per model."""
    splits = ("train", "val", "test", "oot")
    fields = [f"{s}_{m}" for m in ("roc_auc", "accuracy") for s in splits]
    schema = "model_id string, model_type string, training_date string, " + ", ".join(f"{f} double" for f in fields)
    return _document(spark, path, schema)


def read_windows(spark: SparkSession, path: str) -> DataFrame:
    """Dated split windows of a training document, one row per split."""
    rows = _entries(spark, path, "temporal_splits", "start_date string, end_date string")
    ends = [F.col(f"e.{c}").try_cast("date").alias(c) for c in ("start_date", "end_date")]
    return rows.select(F.col("key").alias("split"), *ends)


def training_windows(spark: SparkSession, path: str, snapshot: str | None = None) -> list[dict[str, str]]:
    """The windows a training run uses, as configured: dated, or stacked back from ``snapshot``.

    Relative mode without a snapshot falls back to the dated windows.
    """
    mode = read_window_mode(spark, path).first()
    if mode.mode == "relative" and snapshot:
        lengths = [mode[f"{n}_months"] for n in ("train", "validation", "test", "oot")]
        day = spark.range(1).select(F.lit(snapshot).cast("date").alias("d"))
        rows = day.select(F.inline(dates.backward_windows(F.col("d"), *lengths)))
    else:
        rows = read_windows(spark, path)
    return [{"split": r.split, "start_date": str(r.start_date), "end_date": str(r.end_date)} for r in rows.collect()]


def read_window_mode(spark: SparkSession, path: str) -> DataFrame:
    """Window mode and the months per relative window as one row."""
    fields = {
        "train": "months_back",
        "validation": "months_after_train_end",
        "test": "months_after_validation_end",
        "oot": "months_after_test_end",
    }
    parts = ", ".join(f"{name}:struct<{field}:int>" for name, field in fields.items())
    doc = _document(spark, path, f"temporal_window_mode string, relative_windows struct<{parts}>")
    months = [F.col(f"relative_windows.{n}.{f}").alias(f"{n}_months") for n, f in fields.items()]
    return doc.select(F.coalesce("temporal_window_mode", F.lit("absolute")).alias("mode"), *months)
