"""Ordered analytics over metric tables: one row per model and snapshot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenorlake.functions import encode

TREND_METRICS = ("roc_auc", "accuracy", "f1_score")


def latest_per_key(df: DataFrame, key: str = "model_id", day: str = "snapshot_date") -> DataFrame:
    """The newest row of each key, by a combinable aggregate instead of a sort per key."""
    rest = [c for c in df.columns if c not in (key, day)]
    newest = F.max(F.struct(day, *rest)).alias("_row")
    return df.groupBy(key).agg(newest).select(key, "_row.*").select(df.columns)


def latest_snapshot(df: DataFrame, day: str = "snapshot_date") -> DataFrame:
    """All rows at the table's last date."""
    return df.where(F.col(day) == df.select(F.max(day)).scalar())


def first_to_last(
    df: DataFrame, key: str = "model_id", day: str = "snapshot_date", metrics: Sequence[str] = TREND_METRICS
) -> DataFrame:
    """Last minus first value per key with its direction; keys with one date are left out."""
    changes: dict[str, Column] = {m: F.max_by(m, day) - F.min_by(m, day) for m in metrics}
    spread = df.groupBy(key).agg(
        F.min(day).alias("first_date"),
        F.max(day).alias("last_date"),
        F.count_distinct(day).alias("n_dates"),
        *[c.alias(f"{m}_change") for m, c in changes.items()],
    )
    tagged = spread.withColumns({f"{m}_trend": encode.direction(F.col(f"{m}_change")) for m in metrics})
    return tagged.where("n_dates > 1")


def step_changes(
    df: DataFrame, period: str, metric: str = "roc_auc", key: str = "model_id", band: float = 0.01
) -> DataFrame:
    """Change from each period to the next, periods without a value skipped."""
    order = Window.partitionBy(key).orderBy(period)
    steps = df.where(F.col(metric).isNotNull()).select(
        key,
        F.col(period).alias("from_period"),
        F.lead(period).over(order).alias("to_period"),
        (F.lead(metric).over(order) - F.col(metric)).alias("change"),
    )
    return steps.where("to_period is not null").withColumn("tag", encode.direction(F.col("change"), band, -band))


def overall_trend(df: DataFrame, period: str, metric: str = "roc_auc", key: str = "model_id") -> DataFrame:
    """Last minus first period with a value, classed by the long-run limits."""
    rows = df.where(F.col(metric).isNotNull()).groupBy(key)
    change = F.max_by(metric, period) - F.min_by(metric, period)
    return rows.agg(change.alias("change")).withColumn("trend", encode.long_trend(F.col("change")))


def oot_degradation(evaluation: DataFrame, key: str = "model_id") -> DataFrame:
    """Validation AUC minus the AUC of every out-of-time split, with its class."""
    base = F.max(F.when(F.col("split") == "validation", F.col("roc_auc")))
    per_split = F.collect_list(F.when(F.col("split").startswith("oot"), F.struct("split", "roc_auc")))
    drop = F.col("validation_roc_auc") - F.col("roc_auc")
    return (
        evaluation.groupBy(key)
        .agg(base.alias("validation_roc_auc"), per_split.alias("_oot"))
        .select(key, "validation_roc_auc", F.inline("_oot"))
        .withColumns({"degradation": drop, "status": encode.degradation_class(drop)})
    )


def argmax(df: DataFrame, metric: str = "roc_auc", name: str = "model_id") -> DataFrame:
    """The row name with the highest metric; on a tie the smaller name."""
    filled = df.where(F.col(metric).isNotNull())
    best = F.min(F.struct((-F.col(metric)).alias("_m"), F.col(name)))
    return filled.agg(best[name].alias(f"best_{name}"), F.max(metric).alias(f"best_{metric}"))
