"""Batch scoring, and filling in the months that have no scores yet."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenorlake.operators import joins, schema, tables
from tenorlake.plans.training import MODEL_TYPES, scored
from tenorlake.sources import marks, snapshots

IDS = ("loan_id", "Customer_ID")


def score(
    model: PipelineModel, features: DataFrame, names: Sequence[str], model_id: str, date_column: str = "snapshot_date"
) -> DataFrame:
    """Predictions in the scored-table layout; the inference date is the feature date."""
    aligned = schema.align_features(features, names, [*IDS, date_column])
    numbers = schema.numeric_features(aligned, names)
    return scored(model, numbers).select(
        *IDS,
        "prediction_proba",
        "prediction_label",
        F.lit(model_id).alias("model_id"),
        F.lit(MODEL_TYPES.get(model_id, "unknown")).alias("model_type"),
        F.col(date_column).cast("date").alias("inference_date"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss").alias("inference_timestamp"),
    )


def score_summary(predictions: DataFrame) -> DataFrame:
    """Counts and score range per model and date."""
    positive = F.count_if(F.col("prediction_label") == 1)
    return predictions.groupBy("model_id", "inference_date").agg(
        F.count(F.lit(1)).alias("n"),
        positive.alias("n_default"),
        (100 * positive / F.count(F.lit(1))).alias("default_pct"),
        F.avg("prediction_proba").alias("mean_proba"),
        F.stddev_pop("prediction_proba").alias("std_proba"),
        F.min("prediction_proba").alias("min_proba"),
        F.max("prediction_proba").alias("max_proba"),
    )


def write_predictions(predictions: DataFrame, root: str) -> None:
    snapshots.write_snapshots(predictions, root, ("model_id", "inference_date"))


def backfill(
    models: Mapping[str, tuple[PipelineModel, Sequence[str]]], features: DataFrame, existing: DataFrame,
    snapshot: Column, months: int = 7, date_column: str = "snapshot_date",
) -> DataFrame:
    """Scores for every (model, month) of the last ``months`` that has none, in one job.

    A row belongs to the month its date lies in.

    ``existing`` holds (model_id, month) of scores already there. The missing
    months, at most ``months`` per model, are read first, so that only their
    partitions of the features are scanned.
    """
    spark = features.sparkSession
    known = spark.createDataFrame([(m,) for m in models], "model_id string")
    gaps = joins.missing_outputs(joins.required_outputs(known, snapshot, months), existing).collect()
    parts = []
    for model_id, (model, names) in models.items():
        day = F.col(date_column)
        wanted = [(day >= F.lit(r.month)) & (day < F.add_months(F.lit(r.month), 1)) for r in gaps if r.model_id == model_id]
        rows = features.where(reduce(or_, wanted, F.lit(False)))
        parts.append(score(model, rows, names, model_id, date_column))
    return tables.union_snapshots(parts)


LEDGER = "model_id string, month date, version string, state string, run string"
CLAIMS = "_claims"
OPEN, CLAIMED, FINISHED = "open", "claimed", "finished"


def resume_backfill(
    models: Mapping[str, tuple[PipelineModel, Sequence[str]]], features: DataFrame, root: str, snapshot: Column, run: str,
    version: str, months: int = 7, date_column: str = "snapshot_date", at_most: int | None = None,
) -> list[tuple[str, dt.date]]:
    """Score the last ``months`` of every model, month by month, as a run that can stop anywhere and start again.

    Each (model, month, version) is a task. ``version`` names the state of the features; a new one makes all months open
    again and replaces their scores. A run claims a task, scores its partition of the features and commits. The commit
    itself carries the task's token, so no state lies between scored and finished, and a month is scored once. Tasks
    that another run has claimed are left to it, until :func:`release` says that it is dead. A claim that a run finds under
    its own name is from before it stopped. ``at_most`` tasks are done by this call. Returns those it finished.
    """
    spark = features.sparkSession
    done: list[tuple[str, dt.date]] = []
    for model_id, month in _tasks(spark, models, snapshot, months):
        if len(done) == at_most:
            break
        token, claim = _task(root, model_id, month, version)
        if snapshots.taken(spark, root, token):
            continue
        if not marks.put(spark, claim, {"run": run}) and (marks.get(spark, claim) or {}).get("run") != run:
            continue
        model, names = models[model_id]
        day = F.col(date_column)
        rows = features.where((day >= F.lit(month)) & (day < F.add_months(F.lit(month), 1)))
        scores = score(model, rows, names, model_id, date_column).withColumn("month", F.lit(month))
        whole = (F.col("model_id") == model_id) & (F.col("month") == F.lit(month))
        if snapshots.write_snapshots(scores, root, ("model_id", "month"), whole, token):
            done.append((model_id, month))
    return done


def backfill_ledger(spark: SparkSession, root: str, models: Sequence[str], snapshot: Column, version: str, months: int = 7) -> DataFrame:
    """State of every task, and the run that has claimed it: one row per model and month."""
    rows = []
    for model_id, month in _tasks(spark, models, snapshot, months):
        token, claim = _task(root, model_id, month, version)
        run = (marks.get(spark, claim) or {}).get("run")
        state = FINISHED if snapshots.taken(spark, root, token) else CLAIMED if run else OPEN
        rows.append((model_id, month, version, state, run))
    return spark.createDataFrame(rows, LEDGER)


def release(spark: SparkSession, root: str, run: str) -> int:
    """Give the unfinished tasks of a dead run free; how many there were."""
    folder = f"{root.rstrip('/')}/{CLAIMS}"
    free = 0
    for name in marks.names(spark, folder):
        claim = f"{folder}/{name}.json"
        if (marks.get(spark, claim) or {}).get("run") == run and not snapshots.taken(spark, root, name):
            marks.remove(spark, claim)
            free += 1
    return free


def _tasks(spark: SparkSession, models: Iterable[str], snapshot: Column, months: int) -> list[tuple[str, dt.date]]:
    known = spark.createDataFrame([(m,) for m in models], "model_id string")
    return sorted((r.model_id, r.month) for r in joins.required_outputs(known, snapshot, months).collect())


def _task(root: str, model_id: str, month: dt.date, version: str) -> tuple[str, str]:
    """The token of a task and the place of its claim."""
    token = f"{model_id}-{month:%Y-%m}-{version}"
    return token, f"{root.rstrip('/')}/{CLAIMS}/{token}.json"
