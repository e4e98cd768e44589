"""Monitoring: metrics per model and snapshot, threshold actions, report tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenorlake.functions import numeric
from tenorlake.operators import joins, metrics, ranking, tables, trends
from tenorlake.sources import config, documents, lineage, snapshots

# Texts of an action decision.
BUSINESS_ALERT = "❌ %s (%.4f) below BUSINESS threshold (%.4f)"
SCIENCE_ALERT = "⚠️  %s (%.4f) below DATA SCIENCE threshold (%.4f)"
BASELINE_ALERT = "⚠️  %s degraded %.1f%% from %s baseline (%.4f)"
HEALTHY_ALERT = "✅ All P0 and P1 metrics above data science thresholds"

# Actions by severity, priorities that count, limits of the report alerts.
ACTIONS = ("monitor", "active_monitoring", "retrain")
DECIDING_PRIORITIES = ("P0", "P1")
REPORT_LIMITS = {
    "roc_auc": (0.75, "ROC-AUC below 0.75 - Consider model retraining"),
    "accuracy": (0.70, "Accuracy below 70% - Review model performance"),
    "f1_score": (0.60, "F1-Score below 0.60 - Check precision-recall balance"),
}

KEYS = ("model_id", "snapshot_date")


class NothingPaired(ValueError):
    """No label has a prediction; the text has what stands on either side."""


def paired_rows(
    predictions: DataFrame, labels: DataFrame, lag_months: int = 6, align: str = "offset", strict_priority: bool = False
) -> DataFrame:
    """Labels with their predictions.

    ``align`` "offset" takes predictions ``lag_months`` earlier. "fallback" takes, per label
    snapshot, the first candidate date that has predictions (see ``joins.aligned_snapshots``).
    """
    if align == "offset":
        return joins.lagged(labels, predictions, lag_months=lag_months)
    if align != "fallback":
        raise ValueError(f"unknown alignment: {align}")
    found = joins.aligned_snapshots(labels, predictions.select("inference_date"), lag_months, strict_priority)
    found = found.where("prediction_date is not null").select("label_date", F.col("prediction_date").alias("inference_date"))
    bring = [c for c in joins.LABEL_COLUMNS if c in labels.columns]
    dated = labels.select(*bring, F.col("snapshot_date").alias("label_date")).join(found, "label_date")
    return predictions.join(dated, [*joins.PAIR_KEYS, "inference_date"], "inner")


def monitor(
    predictions: DataFrame, labels: DataFrame, lag_months: int = 6, rows_per_cell: int = ranking.ROWS_PER_CELL,
    align: str = "offset", strict_priority: bool = False,
) -> DataFrame:
    """Metrics of every model and label snapshot, from earlier scores (see ``paired_rows``).

    The paired rows are written once: the metrics read them again. If there are labels and predictions
    but no pair, the keys that have no partner are told in an error.
    """
    paired = paired_rows(predictions, labels, lag_months, align, strict_priority)
    by = ("model_id", "model_type", "snapshot_date", "inference_date")
    rows = paired.withColumn("snapshot_date", F.col("label_date")).select(
        *by, "label", "prediction_proba", "prediction_label"
    )
    rows = lineage.settled(rows, "paired")
    if rows.isEmpty() and not labels.isEmpty() and not predictions.isEmpty():
        sides = joins.unmatched_summary(labels, predictions).collect()
        days = [str(df.agg(F.min(c), F.max(c)).first()[:]) for df, c in ((labels, "snapshot_date"), (predictions, "inference_date"))]
        raise NothingPaired(f"labels of {days[0]} have no predictions, those are of {days[1]}; keys on one side: {[r.asDict() for r in sides]}")
    out = metrics.model_metrics(rows, by, rows_per_cell=rows_per_cell)
    return out.withColumnRenamed("inference_date", "prediction_snapshot_date").withColumns(
        {
            "label_snapshot_date": F.col("snapshot_date"),
            "monitoring_timestamp": F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss"),
        }
    )


def write_metrics(result: DataFrame, root: str) -> None:
    """Parquet by model and snapshot, and the same rows as JSON documents."""
    base = root.rstrip("/")
    result = lineage.settled(result, "metrics")
    snapshots.write_snapshots(result, f"{base}/parquet", KEYS)
    documents.write_documents(result, f"{base}/json", KEYS)


def metric_rows(metric_table: DataFrame, names: Sequence[str], keys: Sequence[str] = KEYS) -> DataFrame:
    """Long form (keys, metric, value), metrics without a value left out."""
    present = [n for n in names if n in metric_table.columns]
    return tables.long_form(metric_table, present, keys, "metric").where("value is not null")


def baseline_rows(baselines: DataFrame) -> DataFrame:
    """Out-of-time baselines as (model_id, metric, baseline_value)."""
    names = [c for c in baselines.columns if c.startswith("oot_")]
    long = tables.long_form(baselines, names, ["model_id"], "metric").where("value is not null")
    return long.select("model_id", F.substring_index("metric", "oot_", -1).alias("metric"), F.col("value").alias("baseline_value"))


def with_limits(
    values: DataFrame, thresholds: DataFrame, baselines: DataFrame | None = None, overrides: DataFrame | None = None
) -> DataFrame:
    """Metric values with their thresholds, and baselines and per-model overrides if given."""
    rows = values.join(thresholds, "metric")
    if overrides is not None:
        limits = ("business_threshold", "data_science_threshold")
        own = overrides.select("model_id", "metric", *[F.col(c).alias(f"_{c}") for c in limits])
        rows = rows.join(own, ["model_id", "metric"], "left")
        rows = rows.withColumns({c: F.coalesce(f"_{c}", c) for c in limits}).drop(*[f"_{c}" for c in limits])
    if baselines is None:
        return rows.withColumn("baseline_value", F.lit(None).cast("double"))
    return rows.join(baseline_rows(baselines), ["model_id", "metric"], "left")


def even_ties(value: Column) -> Column:
    """Four-digit ties that binary holds exactly, rounded to even as alert texts are."""
    return F.when(F.abs(value * 32) % 2 == 1, F.bround(value, 4)).otherwise(value)


def evaluate(limited: DataFrame) -> DataFrame:
    """Status, action and alert text of every metric value."""
    value, base = F.col("value"), F.col("baseline_value")
    drop = F.when(base != 0, (base - value) / base)
    business = value < F.col("business_threshold")
    science = value < F.col("data_science_threshold")
    degraded = F.col("baseline_enabled") & (drop > F.col("max_degradation_percent") / 100.0)
    severity = F.when(business, 2).when(science | degraded, 1).otherwise(0)
    shown = even_ties(value)
    alert = (
        F.when(business, F.format_string(BUSINESS_ALERT, F.col("name"), shown, F.col("business_threshold")))
        .when(science, F.format_string(SCIENCE_ALERT, F.col("name"), shown, F.col("data_science_threshold")))
        .when(degraded, F.format_string(BASELINE_ALERT, F.col("name"), 100 * drop, F.col("reference"), even_ties(base)))
    )
    return limited.withColumns({"degradation": drop, "severity": severity, "alert": alert}).withColumns(
        {
            "status": F.element_at(F.array(*map(F.lit, ("OK", "WARNING", "CRITICAL"))), F.col("severity") + 1),
            "action": F.element_at(F.array(*map(F.lit, ACTIONS)), F.col("severity") + 1),
        }
    )


def overall_action(evaluated: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Worst action of the deciding metrics, with the alerts of that level only."""
    deciding = F.col("priority").isin(list(DECIDING_PRIORITIES))
    level = F.when(deciding, F.col("severity")).otherwise(0)
    found = F.when(deciding & F.col("alert").isNotNull(), F.struct("priority", "metric", "severity", "alert"))
    worst = F.col("_worst")
    own = F.filter(F.array_sort("_found"), lambda a: a["severity"] == worst)
    texts = F.when(worst > 0, F.transform(own, lambda a: a["alert"])).otherwise(F.array(F.lit(HEALTHY_ALERT)))
    return (
        evaluated.groupBy(*keys)
        .agg(F.max(level).alias("_worst"), F.collect_list(found).alias("_found"))
        .select(*keys, F.element_at(F.array(*map(F.lit, ACTIONS)), worst + 1).alias("action"), texts.alias("alerts"))
    )


def decisions(evaluated: DataFrame, metric_table: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """The decision record per model and snapshot."""
    entry = F.struct("metric", F.struct("value", "status", "priority").alias("v"))
    summary = evaluated.groupBy(*keys).agg(
        F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("metric_summary")
    )
    samples = metric_table.select(*keys, "total_samples")
    # the monitoring file is never stored in a metric document, so it is always unknown
    return (
        samples.join(overall_action(evaluated, keys), list(keys), "left")
        .join(summary, list(keys), "left")
        .select(*keys, "action", "alerts", "metric_summary", "total_samples")
        .withColumns(
            {
                "action": F.coalesce("action", F.lit(ACTIONS[0])),
                "alerts": F.coalesce("alerts", F.array(F.lit(HEALTHY_ALERT))),
                "metric_summary": F.coalesce("metric_summary", F.create_map().cast("map<string,struct<value:double,status:string,priority:string>>")),
                "monitoring_file": F.lit("unknown"),
                "evaluation_timestamp": F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss"),
            }
        )
    )


def action_detail(evaluated: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Value, limits, baseline and difference per metric, most important first."""
    delta = F.col("value") - F.col("baseline_value")
    columns = ("priority", "metric", "value", "business_threshold", "data_science_threshold", "baseline_value")
    percent = 100 * numeric.change_share(F.col("value"), F.col("baseline_value"))
    return evaluated.select(
        *keys, *columns, delta.alias("delta"), percent.alias("delta_pct"), "status", "alert"
    ).orderBy(*keys, "priority", "metric")


def actions(
    metric_table: DataFrame, thresholds: DataFrame, baselines: DataFrame | None = None,
    overrides: DataFrame | None = None, latest_only: bool = True,
) -> DataFrame:
    """Decision records, for the newest snapshot of every model or for all of them.

    Every number of the metric table may have a threshold. A model without a rated
    metric is only monitored.
    """
    rows = trends.latest_per_key(metric_table) if latest_only else metric_table
    numbers = ("double", "float", "bigint", "int", "smallint", "tinyint")
    names = [c for c, kind in rows.dtypes if c not in KEYS and (kind in numbers or kind.startswith("decimal"))]
    values = metric_rows(rows, names)
    return decisions(evaluate(with_limits(values, thresholds, baselines, overrides)), rows)


def fixed_alerts(metric_table: DataFrame, limits: Mapping[str, tuple[float, str]] = REPORT_LIMITS) -> DataFrame:
    """Report alerts of the last snapshot, one row per alert."""
    latest = trends.latest_snapshot(metric_table)
    raised = [
        F.when(F.col(m) < limit, F.struct(F.lit(m).alias("metric"), F.col(m).alias("value"), F.lit(text).alias("alert")))
        for m, (limit, text) in limits.items()
    ]
    return latest.select(*KEYS, F.inline(F.array_compact(F.array(*raised))))


def best_model(metric_table: DataFrame) -> DataFrame:
    return trends.argmax(trends.latest_snapshot(metric_table))


def confusion_share(metric_table: DataFrame) -> DataFrame:
    """Confusion counts with their percent of all rows, per model and date."""
    total = sum((F.col(c) for c in metrics.CONFUSION), F.lit(0))
    shares = {f"{c}_pct": F.when(total > 0, 100 * F.col(c) / total) for c in metrics.CONFUSION}
    return metric_table.select(*KEYS, *metrics.CONFUSION).withColumns(shares)


def stability_series(metric_table: DataFrame) -> DataFrame:
    """Score distribution per model and date, in date order."""
    columns = [f"{s}_prediction_proba" for s in ("mean", "std", "median", "min", "max")]
    return metric_table.select(*KEYS, *columns).orderBy(*KEYS)


def model_comparison(metric_table: DataFrame) -> DataFrame:
    """Models side by side at the last snapshot; empty unless there are at least two."""
    latest = trends.latest_snapshot(metric_table)
    columns = ("roc_auc", "accuracy", "f1_score", "precision", "recall", "total_samples")
    enough = latest.agg(F.count(F.lit(1)) >= 2).scalar()
    return latest.where(enough).select(*KEYS, *columns).orderBy("model_id")


def metric_series(
    metric_table: DataFrame, baselines: DataFrame, names: Sequence[str] = trends.TREND_METRICS
) -> DataFrame:
    """Metric values over time next to their out-of-time and test baselines."""
    held = [c for c in baselines.columns if c.startswith(("oot_", "test_"))]
    long = tables.long_form(baselines, held, ["model_id"], "name")
    kind = F.substring_index("name", "_", 1)
    metric = F.expr("substring(name, instr(name, '_') + 1)").alias("metric")
    base = long.groupBy("model_id", metric).agg(
        F.max(F.when(kind == "oot", F.col("value"))).alias("oot_baseline"),
        F.max(F.when(kind == "test", F.col("value"))).alias("test_baseline"),
    )
    return metric_rows(metric_table, names).join(base, ["model_id", "metric"], "left").orderBy(*KEYS, "metric")


def summary_facts(metric_table: DataFrame) -> DataFrame:
    """The facts of the summary report as (section, model_id, item, value) text rows."""
    day = F.date_format("snapshot_date", "yyyy-MM-dd")
    named = metric_table.withColumn("snapshot_date", day)

    def rows(df: DataFrame, section: str, items: Mapping[str, Column], model: Column | None = None) -> DataFrame:
        pairs = [F.struct(F.lit(n).alias("item"), c.cast("string").alias("value")) for n, c in items.items()]
        owner = model if model is not None else F.lit(None).cast("string")
        return df.select(F.lit(section).alias("section"), owner.alias("model_id"), F.inline(F.array(*pairs)))

    extent = tables.date_extent(named)
    latest = trends.latest_snapshot(named)
    shown = ("roc_auc", "accuracy", "f1_score", "precision", "recall")
    model = F.col("model_id")
    trend = trends.first_to_last(named)
    parts = [
        rows(extent, "period", {c: F.col(c) for c in extent.columns}),
        rows(latest, "latest", {c: F.round(c, 4) for c in shown} | {"total_samples": F.col("total_samples")}, model),
        rows(trend, "trend", {m: F.col(f"{m}_trend") for m in trends.TREND_METRICS}, model),
        rows(trends.argmax(latest), "recommendation", {"best_model": F.col("best_model_id")}),
        fixed_alerts(named).select(F.lit("alert").alias("section"), "model_id", F.col("metric").alias("item"), F.col("alert").alias("value")),
    ]
    return tables.union_snapshots(parts).where("value is not null")


def report_tables(metric_table: DataFrame, baselines: DataFrame) -> dict[str, DataFrame]:
    """All tables of the trend report by name."""
    return {
        "metric_series": metric_series(metric_table, baselines),
        "confusion_share": confusion_share(metric_table),
        "stability_series": stability_series(metric_table),
        "model_comparison": model_comparison(metric_table),
        "summary_facts": summary_facts(metric_table),
    }


def population_stability(
    baseline: DataFrame, current: DataFrame, by: Sequence[str], score: str = "prediction_proba", bins: int = 10,
    floor: float = 1e-4, rows_per_cell: int = ranking.ROWS_PER_CELL,
) -> DataFrame:
    """PSI of each current group against the pooled baseline, bins at baseline percentiles.

    A bin counts values above its lower and up to its upper edge; empty shares
    are raised to ``floor``.
    """
    inner = [i / bins for i in range(1, bins)]
    edges = ranking.percentiles(baseline, [], score, inner, rows_per_cell)
    cuts = edges.agg(F.sort_array(F.collect_list("percentile"))).scalar()

    def placed(df: DataFrame) -> DataFrame:
        above = F.aggregate("_cuts", F.lit(0), lambda n, c: n + F.when(F.col(score) > c, 1).otherwise(0))
        return df.where(F.col(score).isNotNull()).withColumn("_cuts", cuts).withColumn("_bin", above).drop("_cuts")

    def histogram(df: DataFrame, keys: Sequence[str]) -> DataFrame:
        counts = [F.count_if(F.col("_bin") == i).cast("double") for i in range(bins)]
        total = F.count(F.lit(1))
        return placed(df).groupBy(*keys).agg(F.array(*[c / total for c in counts]).alias("_share"))

    expected = histogram(baseline, []).select("_share").scalar()

    def term(a: Column, e: Column) -> Column:
        actual, wanted = F.greatest(a, F.lit(floor)), F.greatest(e, F.lit(floor))
        return (actual - wanted) * F.ln(actual / wanted)

    terms = histogram(current, by).withColumn("_expected", expected)
    psi = F.aggregate(F.zip_with("_share", "_expected", term), F.lit(0.0), lambda s, t: s + t)
    return terms.select(*by, psi.alias("psi"))


def score_drift(
    metric_table: DataFrame, baseline: DataFrame, limits: Mapping[str, float] = config.DEFAULT_DRIFT_LIMITS
) -> DataFrame:
    """Absolute change of score mean and std from a per-model baseline row."""
    base = baseline.select("model_id", *[F.col(c).alias(f"_{c}") for c in limits])
    rows = metric_table.select(*KEYS, *limits).join(base, "model_id")
    drift = {f"{c}_drift": F.abs(F.col(c) - F.col(f"_{c}")) for c in limits}
    flags = {f"{c}_alert": F.col(f"{c}_drift") > limit for c, limit in limits.items()}
    return rows.withColumns(drift).withColumns(flags).drop(*[f"_{c}" for c in limits])


def rollback_class(metric_table: DataFrame, baselines: DataFrame) -> DataFrame:
    """Class of the AUC drop against the out-of-time baseline, in percent."""
    base = baselines.select("model_id", "oot_roc_auc")
    rows = metric_table.where("roc_auc is not null").select(*KEYS, "roc_auc").join(base, "model_id")
    drop = -100 * numeric.change_share(F.col("roc_auc"), F.col("oot_roc_auc"))
    # Limits of the rollback classes.
    kind = F.when(F.col("drop_pct") > 15, "critical").when(F.col("drop_pct") >= 10, "high")
    kind = kind.when(F.col("drop_pct") >= 5, "medium").otherwise("low")
    return rows.withColumn("drop_pct", drop).withColumn("rollback", kind)


def group_rates(predictions: DataFrame, group: str) -> DataFrame:
    """Predicted default rate and mean score per group."""
    return predictions.groupBy(group).agg(
        F.avg(F.col("prediction_label").cast("double")).alias("default_rate"),
        F.avg("prediction_proba").alias("mean_proba"),
        F.count(F.lit(1)).alias("n"),
    )
