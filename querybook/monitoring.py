"""Classification metrics, thresholds and actions."""

from pyspark.sql import functions as F

from querybook.base import day, query, rounded
from tenorlake.operators import metrics, ranking, tables, trends
from tenorlake.plans import monitoring, scoring
from tenorlake.sources import config

RATES = ("accuracy", "precision", "recall", "f1_score")
MOMENTS = tuple(f"{m}_prediction_proba" for m in ("mean", "std", "median", "min", "max"))

COUNTS = """count(*) FILTER (label = 0 AND prediction_label = 0) AS tn, count(*) FILTER (label = 0 AND prediction_label = 1) AS fp,
    count(*) FILTER (label = 1 AND prediction_label = 0) AS fn, count(*) FILTER (label = 1 AND prediction_label = 1) AS tp"""
NAMED = "tn AS true_negatives, fp AS false_positives, fn AS false_negatives, tp AS true_positives"


def with_day(df):
    return df.withColumn("snapshot_date", day("snapshot_date"))


@query(f"SELECT lang, {NAMED} FROM (SELECT lang, {COUNTS} FROM v_score GROUP BY lang)", "v_score")
def confusion_matrix(t):
    return metrics.confusion_matrix(t.score, ["lang"])


@query(
    f"""SELECT snapshot_date, model_id, CASE WHEN single THEN 0 ELSE tn END AS true_negatives, fp AS false_positives,
        fn AS false_negatives, CASE WHEN single THEN 0 ELSE tp END AS true_positives
        FROM (SELECT CAST(snapshot_date AS VARCHAR) AS snapshot_date, model_id, {COUNTS},
            fp + fn = 0 AND (tn = 0 OR tp = 0) AS single FROM v_month GROUP BY ALL)""",
    "v_month",
)
def confusion_matrix_zeroed(t):
    return with_day(metrics.confusion_matrix(t.month, ["model_id", "snapshot_date"], zero_single_class=True))


@query(
    f"""SELECT source, {NAMED}, round((tp + tn)::DOUBLE / (tp + tn + fp + fn), 6) AS accuracy,
        round(CASE WHEN tp + fp > 0 THEN tp::DOUBLE / (tp + fp) ELSE 0 END, 6) AS precision,
        round(CASE WHEN tp + fn > 0 THEN tp::DOUBLE / (tp + fn) ELSE 0 END, 6) AS recall,
        round(CASE WHEN 2 * tp + fp + fn > 0 THEN 2.0 * tp / (2 * tp + fp + fn) ELSE 0 END, 6) AS f1_score
        FROM (SELECT source, {COUNTS} FROM v_score GROUP BY source)""",
    "v_score",
)
def classification_metrics(t):
    return rounded(metrics.rates(metrics.confusion_matrix(t.score, ["source"])), 6, *RATES)


@query(
    f"""WITH c AS (SELECT {COUNTS} FROM v_score),
        k AS (SELECT 'No Default' AS class, tn::DOUBLE AS hit, fn::DOUBLE AS wrong, fp::DOUBLE AS missed, tn + fp AS support FROM c
            UNION ALL SELECT 'Default', tp, fp, fn, tp + fn FROM c),
        s AS (SELECT class, support, CASE WHEN hit + wrong > 0 THEN hit / (hit + wrong) ELSE 0 END AS p,
            CASE WHEN hit + missed > 0 THEN hit / (hit + missed) ELSE 0 END AS r,
            CASE WHEN 2 * hit + wrong + missed > 0 THEN 2 * hit / (2 * hit + wrong + missed) ELSE 0 END AS f FROM k)
        SELECT class, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1_score, support::BIGINT AS support FROM s
        UNION ALL SELECT 'accuracy', round((tp + tn)::DOUBLE / (tp + tn + fp + fn), 6), round((tp + tn)::DOUBLE / (tp + tn + fp + fn), 6),
            round((tp + tn)::DOUBLE / (tp + tn + fp + fn), 6), (tp + tn + fp + fn)::BIGINT FROM c
        UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6), sum(support)::BIGINT FROM s
        UNION ALL SELECT 'weighted avg', round(sum(p * support) / sum(support), 6), round(sum(r * support) / sum(support), 6),
            round(sum(f * support) / sum(support), 6), sum(support)::BIGINT FROM s""",
    "v_score",
)
def class_report(t):
    return rounded(metrics.class_report(t.score), 6, "precision", "recall", "f1_score")


AUC_OF = """SELECT {by} CASE WHEN count(*) FILTER (label = 1) > 0 AND count(*) FILTER (label = 0) > 0 THEN round(
        (sum(rk) FILTER (label = 1) - count(*) FILTER (label = 1) * (count(*) FILTER (label = 1) + 1) / 2.0)
        / (count(*) FILTER (label = 1) * count(*) FILTER (label = 0)), 9) END AS roc_auc
    FROM (SELECT *, CAST(rank() OVER (PARTITION BY {part} ORDER BY prediction_proba) AS DOUBLE)
        + (count(*) OVER (PARTITION BY {part}, prediction_proba) - 1) / 2.0 AS rk FROM v_score) GROUP BY ALL"""


@query(AUC_OF.format(by="lang,", part="lang"), "v_score")
def roc_auc(t):
    return rounded(ranking.roc_auc(t.score, ["lang"]), 9, "roc_auc")


@query(AUC_OF.format(by="", part="1"), "v_score")
def roc_auc_overall(t):
    """One group, cut into many cells."""
    return rounded(ranking.roc_auc(t.score, [], rows_per_cell=8), 9, "roc_auc")


@query(
    "SELECT model_id, CAST(snapshot_date AS VARCHAR) AS snapshot_date, round(roc_auc, 9) AS roc_auc FROM v_auc", "v_auc"
)
def auc_by_month(t):
    return rounded(with_day(ranking.roc_auc(t.month, ["model_id", "snapshot_date"])), 9, "roc_auc")


@query(
    """SELECT lang, round(avg(prediction_proba), 6) AS mean_prediction_proba, round(stddev_pop(prediction_proba), 6) AS std_prediction_proba,
        round(min(prediction_proba), 6) AS min_prediction_proba, round(max(prediction_proba), 6) AS max_prediction_proba,
        round(median(prediction_proba), 6) AS median_prediction_proba FROM v_score GROUP BY lang""",
    "v_score",
)
def score_distribution(t):
    return rounded(metrics.score_distribution(t.score, ["lang"]), 6, *MOMENTS)


@query(
    """SELECT l_returnflag, p::DOUBLE AS p, round(v, 4) AS percentile FROM (SELECT l_returnflag, unnest([0.1, 0.25, 0.5, 0.9]) AS p,
        unnest(quantile_cont(l_extendedprice, [0.1, 0.25, 0.5, 0.9])) AS v FROM lineitem GROUP BY l_returnflag)"""
)
def exact_percentiles(t):
    """Large groups cut into cells of about a thousand values."""
    found = ranking.percentiles(t.table("lineitem"), ["l_returnflag"], "l_extendedprice", [0.1, 0.25, 0.5, 0.9], 1_000)
    return rounded(found, 4, "percentile")


@query(
    """SELECT source, count(*) AS total_samples, sum(label)::BIGINT AS actual_positives, sum(1 - label)::BIGINT AS actual_negatives,
        sum(prediction_label)::BIGINT AS predicted_positives, sum(1 - prediction_label)::BIGINT AS predicted_negatives,
        round(100.0 * sum(label) / count(*), 4) AS actual_positives_pct, round(100.0 * sum(1 - label) / count(*), 4) AS actual_negatives_pct,
        round(100.0 * sum(prediction_label) / count(*), 4) AS predicted_positives_pct,
        round(100.0 * sum(1 - prediction_label) / count(*), 4) AS predicted_negatives_pct FROM v_score GROUP BY source""",
    "v_score",
)
def class_balance(t):
    found = metrics.class_balance(t.score, ["source"])
    return rounded(found, 4, *[c for c in found.columns if c.endswith("_pct")])


@query(
    """SELECT model_id, model_type, CAST(snapshot_date AS VARCHAR) AS snapshot_date, tn AS true_negatives, fp AS false_positives,
        fn AS false_negatives, tp AS true_positives, total_samples, tp + fn AS actual_positives, tn + fp AS actual_negatives,
        tp + fp AS predicted_positives, tn + fn AS predicted_negatives, round(roc_auc, 6) AS roc_auc, round(accuracy, 6) AS accuracy,
        round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1_score, 6) AS f1_score,
        round(mean_prediction_proba, 6) AS mean_prediction_proba, round(std_prediction_proba, 6) AS std_prediction_proba,
        round(median_prediction_proba, 6) AS median_prediction_proba, round(min_prediction_proba, 6) AS min_prediction_proba,
        round(max_prediction_proba, 6) AS max_prediction_proba FROM v_metrics""",
    "v_metrics",
)
def model_metrics(t):
    return rounded(with_day(metrics.model_metrics(t.month)), 6, "roc_auc", *RATES, *MOMENTS)


@query(
    """SELECT CAST(snapshot_date AS VARCHAR) AS snapshot_date, model_id, count(*) AS n, sum(prediction_label)::BIGINT AS n_default,
        round(100.0 * sum(prediction_label) / count(*), 4) AS default_pct, round(avg(prediction_proba), 6) AS mean_proba,
        round(stddev_pop(prediction_proba), 6) AS std_proba, round(min(prediction_proba), 6) AS min_proba,
        round(max(prediction_proba), 6) AS max_proba FROM v_month GROUP BY ALL""",
    "v_month",
)
def score_summary(t):
    found = scoring.score_summary(t.month.withColumnRenamed("snapshot_date", "inference_date"))
    found = with_day(found.withColumnRenamed("inference_date", "snapshot_date"))
    return rounded(rounded(found, 4, "default_pct"), 6, "mean_proba", "std_proba", "min_proba", "max_proba")


def checked(t):
    names = [row[0] for row in config.DEFAULT_THRESHOLDS]
    values = monitoring.metric_rows(t.metrics, names)
    return monitoring.evaluate(monitoring.with_limits(values, config.default_thresholds(t.spark), t.baselines))


@query(
    """SELECT model_id, CAST(snapshot_date AS VARCHAR) AS snapshot_date, metric, round(value, 6) AS value, status, action, alert
        FROM v_check""",
    "v_check",
)
def threshold_status(t):
    rows = with_day(checked(t)).select("model_id", "snapshot_date", "metric", "value", "status", "action", "alert")
    return rounded(rows, 6, "value")


@query(
    """SELECT model_id, CAST(snapshot_date AS VARCHAR) AS snapshot_date, metric, round(baseline_value, 6) AS baseline_value,
        round(degradation, 6) AS degradation, status FROM v_check WHERE baseline_value IS NOT NULL""",
    "v_check",
)
def baseline_degradation(t):
    rows = with_day(checked(t)).where("baseline_value is not null")
    rows = rows.select("model_id", "snapshot_date", "metric", "baseline_value", "degradation", "status")
    return rounded(rows, 6, "baseline_value", "degradation")


OVERALL = """
    SELECT model_id, snapshot_date, CASE worst WHEN 2 THEN 'retrain' WHEN 1 THEN 'active_monitoring' ELSE 'monitor' END AS action,
        CASE WHEN worst = 0 THEN '✅ All P0 and P1 metrics above data science thresholds' ELSE alerts END AS alerts
    FROM (SELECT model_id, snapshot_date, max(CASE WHEN priority IN ('P0', 'P1') THEN severity ELSE 0 END) AS worst,
            string_agg(alert, ' | ' ORDER BY priority, metric) FILTER (priority IN ('P0', 'P1') AND severity = top) AS alerts
        FROM (SELECT *, max(CASE WHEN priority IN ('P0', 'P1') THEN severity ELSE 0 END)
            OVER (PARTITION BY model_id, snapshot_date) AS top FROM v_check) GROUP BY ALL)"""


@query(
    f"SELECT * REPLACE (CAST(snapshot_date AS VARCHAR) AS snapshot_date) FROM ({OVERALL})", "v_check"
)
def overall_action(t):
    rows = with_day(monitoring.overall_action(checked(t)))
    return rows.withColumn("alerts", F.array_join("alerts", " | "))


@query(
    """SELECT model_id, CAST(snapshot_date AS VARCHAR) AS snapshot_date, priority, metric, round(value, 6) AS value, business_threshold,
        data_science_threshold, round(baseline_value, 6) AS baseline_value, round(value - baseline_value, 6) AS delta,
        round(100 * (value - baseline_value) / baseline_value, 4) AS delta_pct, status, alert FROM v_check""",
    "v_check",
)
def action_detail(t):
    rows = with_day(monitoring.action_detail(checked(t)))
    return rounded(rounded(rows, 6, "value", "baseline_value", "delta"), 4, "delta_pct")


@query(
    f"""SELECT CAST(o.snapshot_date AS VARCHAR) AS snapshot_date, o.model_id, o.action, o.alerts, m.total_samples, 'unknown' AS monitoring_file,
        (SELECT string_agg(metric || '=' || status || '/' || priority, ',' ORDER BY metric) FROM v_check c
            WHERE c.model_id = o.model_id AND c.snapshot_date = o.snapshot_date) AS metric_summary
        FROM ({OVERALL}) o JOIN v_metrics m ON o.model_id = m.model_id AND o.snapshot_date = m.snapshot_date
        WHERE o.snapshot_date = (SELECT max(snapshot_date) FROM v_metrics x WHERE x.model_id = o.model_id)""",
    "v_check",
)
def decision_record(t):
    """Newest decision of every model."""
    rows = with_day(monitoring.actions(t.metrics, config.default_thresholds(t.spark), t.baselines))
    entries = F.array_sort(F.map_entries("metric_summary"))
    shown = F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"]["status"], F.lit("/"), e["value"]["priority"]))
    return rows.withColumns(
        {"alerts": F.array_join("alerts", " | "), "metric_summary": F.array_join(shown, ",")}
    ).drop("evaluation_timestamp")


@query(
    """WITH o AS (SELECT 'model_2' AS model_id, 'accuracy' AS metric, 0.5 AS b, 0.55 AS s)
        SELECT v.model_id, CAST(snapshot_date AS VARCHAR) AS snapshot_date, v.metric,
            coalesce(o.b, business_threshold)::DOUBLE AS business_threshold,
            CASE WHEN value < coalesce(o.b, business_threshold) THEN 'CRITICAL'
                WHEN value < coalesce(o.s, data_science_threshold) THEN 'WARNING' ELSE 'OK' END AS status
        FROM (SELECT model_id, snapshot_date, metric, value FROM v_check) v JOIN v_limits USING (metric)
        LEFT JOIN o ON o.model_id = v.model_id AND o.metric = v.metric""",
    "v_check",
)
def threshold_overrides(t):
    values = monitoring.metric_rows(t.metrics, [row[0] for row in config.DEFAULT_THRESHOLDS])
    own = t.spark.createDataFrame(
        [("model_2", "accuracy", 0.5, 0.55)],
        "model_id string, metric string, business_threshold double, data_science_threshold double",
    )
    rows = monitoring.evaluate(monitoring.with_limits(values, config.default_thresholds(t.spark), overrides=own))
    return with_day(rows).select("model_id", "snapshot_date", "metric", "business_threshold", "status")


@query(
    """SELECT model_id, metric, count(*) AS n FROM v_limits JOIN v_check USING (metric) GROUP BY ALL""", "v_check"
)
def thresholds_joined(t):
    return tables.group_counts(checked(t), ["model_id", "metric"])


@query(
    """SELECT model_id, CAST(snapshot_date AS VARCHAR) AS snapshot_date, round(roc_auc, 6) AS roc_auc, total_samples
        FROM v_metrics WHERE snapshot_date = (SELECT max(snapshot_date) FROM v_metrics)""",
    "v_metrics",
)
def latest_metrics(t):
    rows = trends.latest_per_key(t.metrics).select("model_id", "snapshot_date", "roc_auc", "total_samples")
    return rounded(with_day(rows), 6, "roc_auc")


@query(
    """SELECT model_id, CAST(snapshot_date AS VARCHAR) AS snapshot_date,
        CASE WHEN mean_prediction_proba < 0.45 OR total_samples < 50 THEN 'retrain' WHEN mean_prediction_proba < 0.5 THEN 'active_monitoring' ELSE 'monitor' END AS action,
        total_samples FROM v_metrics""",
    "v_metrics",
)
def custom_thresholds(t):
    """Limits on metrics other than the built-in five, for every snapshot."""
    limits = t.spark.createDataFrame(
        [("mean_prediction_proba", "P0", "Mean score", 0.45, 0.5, False, None, None), ("total_samples", "P1", "Samples", 50.0, 50.0, False, None, None)],
        config.THRESHOLD_SCHEMA,
    )
    return with_day(monitoring.actions(t.metrics, limits, latest_only=False)).select("model_id", "snapshot_date", "action", "total_samples")
