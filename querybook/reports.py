"""Trends, comparisons and report tables."""

from pyspark.sql import functions as F

from querybook.base import day, query, rounded
from querybook.monitoring import MOMENTS, with_day
from tenorlake.operators import tables, trends
from tenorlake.plans import monitoring, training

SIGN = "CASE WHEN {0} > 0 THEN 'improving' WHEN {0} < 0 THEN 'degrading' WHEN {0} IS NOT NULL THEN 'stable' END"


def _change(metric):
    return f"arg_max({metric}, snapshot_date) FILTER ({metric} IS NOT NULL) - arg_min({metric}, snapshot_date) FILTER ({metric} IS NOT NULL)"


@query(
    f"""SELECT model_id, first_date, last_date, n_dates, round(r, 6) AS roc_auc_change, round(a, 6) AS accuracy_change,
        round(f, 6) AS f1_score_change, {SIGN.format("r")} AS roc_auc_trend, {SIGN.format("a")} AS accuracy_trend,
        {SIGN.format("f")} AS f1_score_trend
        FROM (SELECT model_id, CAST(min(snapshot_date) AS VARCHAR) AS first_date, CAST(max(snapshot_date) AS VARCHAR) AS last_date,
            count(DISTINCT snapshot_date) AS n_dates, arg_max_null(roc_auc, snapshot_date) - arg_min_null(roc_auc, snapshot_date) AS r,
            arg_max_null(accuracy, snapshot_date) - arg_min_null(accuracy, snapshot_date) AS a,
            arg_max_null(f1_score, snapshot_date) - arg_min_null(f1_score, snapshot_date) AS f FROM v_metrics GROUP BY model_id)""",
    "v_metrics",
)
def metric_trend(t):
    rows = trends.first_to_last(t.metrics)
    rows = rows.withColumns({c: day(c) for c in ("first_date", "last_date")})
    return rounded(rows, 6, "roc_auc_change", "accuracy_change", "f1_score_change")


@query(
    """SELECT model_id, CAST(d AS VARCHAR) AS from_period, CAST(n AS VARCHAR) AS to_period, round(c, 6) AS change,
        CASE WHEN c > 0.01 THEN 'improving' WHEN c < -0.01 THEN 'degrading' ELSE 'stable' END AS tag
        FROM (SELECT model_id, snapshot_date AS d, lead(snapshot_date) OVER w AS n, lead(roc_auc) OVER w - roc_auc AS c
            FROM v_metrics WHERE roc_auc IS NOT NULL WINDOW w AS (PARTITION BY model_id ORDER BY snapshot_date))
        WHERE n IS NOT NULL""",
    "v_metrics",
)
def step_change(t):
    rows = trends.step_changes(t.metrics, "snapshot_date")
    return rounded(rows.withColumns({c: day(c) for c in ("from_period", "to_period")}), 6, "change")


@query(
    """SELECT model_id, round(c, 6) AS change, CASE WHEN c < -0.05 THEN 'degrading' WHEN c > 0.02 THEN 'improving' ELSE 'stable' END AS trend
        FROM (SELECT model_id, arg_max(roc_auc, snapshot_date) - arg_min(roc_auc, snapshot_date) AS c
            FROM v_metrics WHERE roc_auc IS NOT NULL GROUP BY model_id)""",
    "v_metrics",
)
def overall_trend(t):
    return rounded(trends.overall_trend(t.metrics, "snapshot_date"), 6, "change")


# the metric rows of calendar years stand for evaluation splits
SPLITS = {1995: "train", 1996: "validation", 1997: "test", 1998: "oot1", 1999: "oot2", 2000: "oot3", 2001: "oot4"}


@query(
    """WITH e AS (SELECT model_id, CASE WHEN year(snapshot_date) = 1996 THEN 'validation' WHEN year(snapshot_date) >= 1998 THEN 'oot' || (year(snapshot_date) - 1997) END AS split,
            max(roc_auc) AS a FROM v_metrics GROUP BY ALL)
        SELECT o.model_id, round(v.a, 6) AS validation_roc_auc, o.split, round(o.a, 6) AS roc_auc, round(v.a - o.a, 6) AS degradation,
            CASE WHEN v.a - o.a > 0.05 THEN 'significant' WHEN v.a - o.a > 0.02 THEN 'moderate' ELSE 'stable' END AS status
        FROM e o JOIN e v ON o.model_id = v.model_id AND v.split = 'validation' WHERE o.split LIKE 'oot%'""",
    "v_metrics",
)
def oot_degradation(t):
    year = F.year("snapshot_date")
    split = F.coalesce(*[F.when(year == y, F.lit(s)) for y, s in SPLITS.items()])
    evaluation = t.metrics.groupBy("model_id", split.alias("split")).agg(F.max("roc_auc").alias("roc_auc"))
    return rounded(trends.oot_degradation(evaluation), 6, "validation_roc_auc", "roc_auc", "degradation")


@query(
    """SELECT model_id AS best_model_id, round(accuracy, 6) AS best_accuracy FROM v_metrics
        WHERE snapshot_date = (SELECT max(snapshot_date) FROM v_metrics) ORDER BY accuracy DESC, model_id LIMIT 1""",
    "v_metrics",
)
def best_by_accuracy(t):
    return rounded(trends.argmax(trends.latest_snapshot(t.metrics), "accuracy"), 6, "best_accuracy")


@query(
    """SELECT first(model_id ORDER BY roc_auc DESC, model_id) AS best_model_id, round(max(roc_auc), 6) AS best_roc_auc FROM v_metrics
        WHERE snapshot_date = (SELECT max(snapshot_date) FROM v_metrics) AND roc_auc IS NOT NULL""",
    "v_metrics",
)
def best_model(t):
    """Of the last snapshot; no model is best where none has an AUC."""
    return rounded(monitoring.best_model(t.metrics), 6, "best_roc_auc")


@query(
    """SELECT model_id, CAST(snapshot_date AS VARCHAR) AS snapshot_date, metric, round(value, 6) AS value, alert
        FROM (SELECT model_id, snapshot_date, unnest(['roc_auc', 'accuracy', 'f1_score']) AS metric, unnest([roc_auc, accuracy, f1_score]) AS value,
            unnest([0.75, 0.70, 0.60]) AS lim, unnest(['ROC-AUC below 0.75 - Consider model retraining',
                'Accuracy below 70% - Review model performance', 'F1-Score below 0.60 - Check precision-recall balance']) AS alert
            FROM v_metrics WHERE snapshot_date = (SELECT max(snapshot_date) FROM v_metrics)) WHERE value < lim""",
    "v_metrics",
)
def fixed_alerts(t):
    return rounded(with_day(monitoring.fixed_alerts(t.metrics)), 6, "value")


@query(
    """SELECT model_id, CAST(snapshot_date AS VARCHAR) AS snapshot_date, tn AS true_negatives, fp AS false_positives, fn AS false_negatives,
        tp AS true_positives, round(100.0 * tn / total_samples, 4) AS true_negatives_pct, round(100.0 * fp / total_samples, 4) AS false_positives_pct,
        round(100.0 * fn / total_samples, 4) AS false_negatives_pct, round(100.0 * tp / total_samples, 4) AS true_positives_pct FROM v_metrics""",
    "v_metrics",
)
def confusion_share(t):
    rows = with_day(monitoring.confusion_share(t.metrics))
    return rounded(rows, 4, *[c for c in rows.columns if c.endswith("_pct")])


@query(
    """SELECT model_id, CAST(snapshot_date AS VARCHAR) AS snapshot_date, round(mean_prediction_proba, 6) AS mean_prediction_proba,
        round(std_prediction_proba, 6) AS std_prediction_proba, round(median_prediction_proba, 6) AS median_prediction_proba,
        round(min_prediction_proba, 6) AS min_prediction_proba, round(max_prediction_proba, 6) AS max_prediction_proba FROM v_metrics""",
    "v_metrics",
)
def stability_series(t):
    return rounded(with_day(monitoring.stability_series(t.metrics)), 6, *MOMENTS)


@query(
    """SELECT model_id, CAST(snapshot_date AS VARCHAR) AS snapshot_date, round(roc_auc, 6) AS roc_auc, round(accuracy, 6) AS accuracy,
        round(f1_score, 6) AS f1_score, round(precision, 6) AS precision, round(recall, 6) AS recall, total_samples
        FROM v_metrics WHERE snapshot_date = (SELECT max(snapshot_date) FROM v_metrics)""",
    "v_metrics",
)
def model_comparison(t):
    rows = with_day(monitoring.model_comparison(t.metrics))
    return rounded(rows, 6, "roc_auc", "accuracy", "f1_score", "precision", "recall")


@query(
    """SELECT model_id, CAST(snapshot_date AS VARCHAR) AS snapshot_date, metric, round(value, 6) AS value,
        round(baseline_value, 6) AS oot_baseline, round(baseline_value - 0.01, 6) AS test_baseline
        FROM (SELECT model_id, snapshot_date, unnest(['roc_auc', 'accuracy', 'f1_score']) AS metric,
            unnest([roc_auc, accuracy, f1_score]) AS value FROM v_metrics) LEFT JOIN v_base USING (model_id, metric)
        WHERE value IS NOT NULL""",
    "v_metrics v_base",
)
def metric_series(t):
    rows = with_day(monitoring.metric_series(t.metrics, t.baselines))
    return rounded(rows, 6, "value", "oot_baseline", "test_baseline")


@query(
    """SELECT CAST(min(snapshot_date) AS VARCHAR) AS first_date, CAST(max(snapshot_date) AS VARCHAR) AS last_date,
        count(DISTINCT snapshot_date) AS n_dates, 'model_1, model_2' AS members FROM v_metrics""",
    "v_metrics",
)
def date_extent(t):
    return tables.date_extent(with_day(t.metrics))


@query(
    f"""WITH x AS (SELECT max(snapshot_date) AS m FROM v_metrics), l AS (SELECT v_metrics.* FROM v_metrics, x WHERE snapshot_date = m),
        p AS (SELECT min(snapshot_date) AS a, max(snapshot_date) AS b, count(DISTINCT snapshot_date) AS n FROM v_metrics),
        g AS (SELECT model_id, {SIGN.format("(" + _change("accuracy") + ")")} AS acc, {SIGN.format("(" + _change("f1_score") + ")")} AS f1,
            {SIGN.format("(arg_max_null(roc_auc, snapshot_date) - arg_min_null(roc_auc, snapshot_date))")} AS auc FROM v_metrics GROUP BY model_id)
        SELECT * FROM (
            SELECT 'period' AS section, NULL AS model_id, unnest(['first_date', 'last_date', 'n_dates', 'members']) AS item,
                unnest([CAST(a AS VARCHAR), CAST(b AS VARCHAR), CAST(n AS VARCHAR), 'model_1, model_2']) AS value FROM p
            UNION ALL SELECT 'latest', model_id, 'total_samples', CAST(total_samples AS VARCHAR) FROM l
            UNION ALL SELECT 'latest', model_id, unnest(['accuracy', 'f1_score', 'precision', 'recall']),
                unnest([CAST(round(accuracy, 4) AS VARCHAR), CAST(round(f1_score, 4) AS VARCHAR), CAST(round(precision, 4) AS VARCHAR),
                    CAST(round(recall, 4) AS VARCHAR)]) FROM l
            UNION ALL SELECT 'latest', model_id, 'roc_auc', CAST(round(roc_auc, 4) AS VARCHAR) FROM l
            UNION ALL SELECT 'trend', model_id, unnest(['accuracy', 'f1_score', 'roc_auc']), unnest([acc, f1, auc]) FROM g
            UNION ALL SELECT 'recommendation', NULL, 'best_model', (SELECT model_id FROM l WHERE roc_auc IS NOT NULL ORDER BY roc_auc DESC, model_id LIMIT 1)
            UNION ALL SELECT 'alert', model_id, 'roc_auc', 'ROC-AUC below 0.75 - Consider model retraining' FROM l WHERE roc_auc < 0.75
            UNION ALL SELECT 'alert', model_id, 'accuracy', 'Accuracy below 70% - Review model performance' FROM l WHERE accuracy < 0.70
            UNION ALL SELECT 'alert', model_id, 'f1_score', 'F1-Score below 0.60 - Check precision-recall balance' FROM l WHERE f1_score < 0.60)
        WHERE value IS NOT NULL""",
    "v_metrics",
)
def summary_facts(t):
    return monitoring.summary_facts(t.metrics)


@query(
    """WITH q AS (SELECT quantile_cont(prediction_proba, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS e FROM v_month WHERE model_id = 'model_1'),
        b AS (SELECT model_id, len(list_filter(e, lambda x: prediction_proba > x)) AS b FROM v_month, q),
        s AS (SELECT m.model_id, k.b, (SELECT count(*) FROM b WHERE b.model_id = m.model_id AND b.b = k.b)::DOUBLE
            / (SELECT count(*) FROM b WHERE b.model_id = m.model_id) AS share FROM (SELECT DISTINCT model_id FROM b) m, (SELECT unnest(range(10)) AS b) k)
        SELECT a.model_id, round(sum((greatest(a.share, 0.0001) - greatest(e.share, 0.0001)) * ln(greatest(a.share, 0.0001) / greatest(e.share, 0.0001))), 6) AS psi
        FROM s a JOIN s e ON a.b = e.b AND e.model_id = 'model_1' GROUP BY a.model_id""",
    "v_month",
)
def psi(t):
    found = monitoring.population_stability(t.month.where("model_id = 'model_1'"), t.month, ["model_id"])
    return rounded(found, 6, "psi")


@query(
    """WITH b AS (SELECT model_id, arg_min(mean_prediction_proba, snapshot_date) AS m, arg_min(std_prediction_proba, snapshot_date) AS s
            FROM v_metrics GROUP BY model_id)
        SELECT v.model_id, CAST(snapshot_date AS VARCHAR) AS snapshot_date, round(mean_prediction_proba, 6) AS mean_prediction_proba,
            round(std_prediction_proba, 6) AS std_prediction_proba, round(abs(mean_prediction_proba - m), 6) AS mean_prediction_proba_drift,
            round(abs(std_prediction_proba - s), 6) AS std_prediction_proba_drift, abs(mean_prediction_proba - m) > 0.15 AS mean_prediction_proba_alert,
            abs(std_prediction_proba - s) > 0.2 AS std_prediction_proba_alert
        FROM v_metrics v JOIN b USING (model_id)""",
    "v_metrics",
)
def score_drift(t):
    first = t.metrics.groupBy("model_id").agg(
        *[F.min_by(c, "snapshot_date").alias(c) for c in ("mean_prediction_proba", "std_prediction_proba")]
    )
    rows = with_day(monitoring.score_drift(t.metrics, first))
    return rounded(rows, 6, *[c for c in rows.columns if c.endswith(("_proba", "_drift"))])


@query(
    """SELECT feature, round(s, 6) AS null_share, s > 0.1 AS too_many FROM (
        SELECT 'tax' AS feature, avg(CASE WHEN tax IS NULL THEN 1 ELSE 0 END) AS s FROM v_feat
        UNION ALL SELECT 'price', avg(CASE WHEN price IS NULL THEN 1 ELSE 0 END) FROM v_feat)""",
    "v_feat",
)
def null_share(t):
    return rounded(tables.null_shares(t.feat, ["tax", "price"]), 6, "null_share")


@query(
    """SELECT model_id, CAST(snapshot_date AS VARCHAR) AS snapshot_date, round(roc_auc, 6) AS roc_auc, round(b, 6) AS oot_roc_auc,
        round(d, 4) AS drop_pct, CASE WHEN d > 15 THEN 'critical' WHEN d >= 10 THEN 'high' WHEN d >= 5 THEN 'medium' ELSE 'low' END AS rollback
        FROM (SELECT v.model_id, snapshot_date, roc_auc, baseline_value AS b, 100 * (baseline_value - roc_auc) / baseline_value AS d
            FROM v_metrics v JOIN v_base b ON v.model_id = b.model_id AND metric = 'roc_auc' WHERE roc_auc IS NOT NULL)""",
    "v_metrics v_base",
)
def rollback_class(t):
    rows = with_day(monitoring.rollback_class(t.metrics, t.baselines))
    return rounded(rounded(rows, 6, "roc_auc", "oot_roc_auc"), 4, "drop_pct")


def _yearly_record(t):
    """One training record per model, its splits being calendar years."""
    def of(year, name):
        return F.max(F.when(F.year("snapshot_date") == year, F.col(name)))

    return t.metrics.groupBy("model_id").agg(
        of(1995, "roc_auc").alias("train_roc_auc"),
        of(1996, "roc_auc").alias("val_roc_auc"),
        of(1996, "accuracy").alias("val_accuracy"),
        of(1997, "roc_auc").alias("test_roc_auc"),
        F.max(F.when(F.year("snapshot_date") >= 1998, F.col("roc_auc"))).alias("oot_roc_auc"),
        F.sum(F.when(F.year("snapshot_date") == 1996, F.col("total_samples"))).alias("val_samples"),
    )


RECORD = """r AS (SELECT model_id, max(roc_auc) FILTER (year(snapshot_date) = 1995) AS tr, max(roc_auc) FILTER (year(snapshot_date) = 1996) AS va,
    max(accuracy) FILTER (year(snapshot_date) = 1996) AS acc, max(roc_auc) FILTER (year(snapshot_date) = 1997) AS te,
    max(roc_auc) FILTER (year(snapshot_date) >= 1998) AS oo, max(roc_auc) FILTER (year(snapshot_date) = 1999 AND model_id = 'model_1') AS cu, sum(total_samples) FILTER (year(snapshot_date) = 1996) AS n
    FROM v_metrics GROUP BY model_id)"""


@query(
    f"""WITH {RECORD}
        SELECT *, oot_high_enough AND oot_near_test AND no_overfit AND better_than_current AS promote FROM (
            SELECT model_id, round(tr, 6) AS train_roc_auc, round(va, 6) AS val_roc_auc, round(te, 6) AS test_roc_auc, round(oo, 6) AS oot_roc_auc,
                round(cu, 6) AS current_oot_roc_auc, coalesce(oo >= 0.8, false) AS oot_high_enough, coalesce(abs(oo - te) / te <= 0.03, false) AS oot_near_test,
                coalesce(tr - va < 0.05, false) AS no_overfit, coalesce(cu IS NULL OR (oo - cu) / cu >= 0.02, false) AS better_than_current FROM r)""",
    "v_metrics",
)
def promotion_check(t):
    """Model 1 against its record of one year, model 2 without a predecessor."""
    of_1999 = F.max(F.when(F.year("snapshot_date") == 1999, F.col("roc_auc"))).alias("oot_roc_auc")
    incumbent = t.metrics.where("model_id = 'model_1'").groupBy("model_id").agg(of_1999)
    rows = training.promotion_check(_yearly_record(t), incumbent)
    return rounded(rows, 6, "train_roc_auc", "val_roc_auc", "test_roc_auc", "oot_roc_auc", "current_oot_roc_auc")


@query(
    f"""WITH {RECORD} SELECT model_id, round(va, 6) AS val_roc_auc, round(acc, 6) AS val_accuracy FROM r
        WHERE n >= 100 ORDER BY va DESC, acc DESC, model_id LIMIT 1""",
    "v_metrics",
)
def model_selection(t):
    rows = training.select_model(_yearly_record(t)).select("model_id", "val_roc_auc", "val_accuracy")
    return rounded(rows, 6, "val_roc_auc", "val_accuracy")


@query(
    """SELECT lang, round(avg(prediction_label), 6) AS default_rate, round(avg(prediction_proba), 6) AS mean_proba, count(*) AS n
        FROM v_score GROUP BY lang""",
    "v_score",
)
def group_rates(t):
    return rounded(monitoring.group_rates(t.score, "lang"), 6, "default_rate", "mean_proba")


@query(
    """SELECT model_id, label, CAST(snapshot_date AS VARCHAR) AS snapshot_date, count(*) AS n FROM v_month GROUP BY ALL""", "v_month"
)
def group_counts(t):
    return tables.group_counts(with_day(t.month), ["model_id", "label", "snapshot_date"])


@query("SELECT DISTINCT model_id, model_type, CAST(snapshot_date AS VARCHAR) AS snapshot_date FROM v_month", "v_month")
def distinct_values(t):
    return tables.distinct_values(with_day(t.month), ["model_id", "model_type", "snapshot_date"])


@query(
    """SELECT 'loans' AS table_name, count(*) AS n, false AS is_empty FROM v_loan
        UNION ALL SELECT 'late_labels', count(*), count(*) = 0 FROM v_loan WHERE snapshot_date > DATE '2010-01-01'""",
    "v_loan",
)
def row_counts(t):
    late = t.loan.where(F.col("snapshot_date") > F.lit("2010-01-01").cast("date"))
    return tables.row_counts({"loans": t.loan, "late_labels": late})


@query(
    """SELECT loan_id, Customer_ID, CAST(snapshot_date AS VARCHAR) AS snapshot_date FROM v_loan
        ORDER BY loan_id, v_loan.snapshot_date, due_amt LIMIT 5""",
    "v_loan",
)
def sample_rows(t):
    rows = tables.sample_rows(t.loan, ["loan_id", "snapshot_date", "due_amt"])
    return with_day(rows.select("loan_id", "Customer_ID", "snapshot_date"))


@query(
    """SELECT l_partkey::VARCHAR AS feature, round(w, 4) AS weight FROM (
        SELECT l_partkey, sum(l_extendedprice * (l_discount - 0.05)) AS w FROM lineitem GROUP BY l_partkey)
        ORDER BY abs(w) DESC, feature LIMIT 20"""
)
def top_features(t):
    weight = F.sum(F.col("l_extendedprice") * (F.col("l_discount") - 0.05)).alias("weight")
    weights = t.table("lineitem").groupBy(F.col("l_partkey").cast("string").alias("feature")).agg(weight)
    return rounded(tables.top_features(weights), 4, "weight")


@query(
    """SELECT o_custkey AS customer, o_orderstatus AS status, CAST(NULL AS VARCHAR) AS priority FROM orders WHERE o_orderstatus = 'F'
        UNION ALL SELECT o_custkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderstatus <> 'F'"""
)
def union_snapshots(t):
    """Two snapshots whose columns differ in order and number."""
    orders = t.table("orders")
    status, customer = F.col("o_orderstatus").alias("status"), F.col("o_custkey").alias("customer")
    first = orders.where("o_orderstatus = 'F'").select(status, customer)
    second = orders.where("o_orderstatus <> 'F'").select(customer, F.col("o_orderpriority").alias("priority"), status)
    return tables.union_snapshots([first, second])
