"""Which snapshots are ready for training, scoring and monitoring."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def readiness(
    snapshots: DataFrame, models: DataFrame, predictions: DataFrame, required: Sequence[str],
    first_training: str = "2024-12-01", lag_months: int = 6, day: str = "snapshot_date",
) -> DataFrame:
    """One row per snapshot with the three gates as booleans.

    Scoring needs every required model. Monitoring also needs predictions of
    every model ``lag_months`` earlier. Training needs the first training date.
    """
    wanted = list(required)
    model_count = models.where(F.col("model_id").isin(wanted)).agg(F.count_distinct("model_id")).scalar()
    covered = (
        predictions.where(F.col("model_id").isin(wanted))
        .groupBy(F.col("inference_date").cast("date").alias("_due"))
        .agg(F.count_distinct("model_id").alias("_models"))
    )
    days = snapshots.select(day).distinct().withColumn("_due", F.add_months(day, -lag_months))
    complete = F.coalesce(F.col("_models") == len(wanted), F.lit(False))
    return days.join(covered, "_due", "left").select(
        day,
        (F.col(day) >= F.lit(first_training).cast("date")).alias("can_train"),
        (model_count == len(wanted)).alias("can_score"),
        ((model_count == len(wanted)) & complete).alias("can_monitor"),
    )
