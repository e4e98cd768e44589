"""Joins: point in time, trailing windows, labels, lags, splits and gaps."""

from pyspark.sql import functions as F

from querybook.base import WINDOWS, day, query, rounded
from tenorlake.functions import dates
from tenorlake.operators import joins, schema, tables
from tenorlake.plans import gold, readiness as gates, training


@query(
    """SELECT s.loan_id, s.Customer_ID, CAST(s.snapshot_date AS VARCHAR) AS snapshot_date, s.mob, o_totalprice, o_orderpriority
        FROM (SELECT loan_id, Customer_ID, snapshot_date, mob FROM v_dpd WHERE mob = 0) s
        LEFT JOIN v_dim d ON s.Customer_ID = d.Customer_ID AND d.snapshot_date <= s.snapshot_date""",
    "v_dpd v_dim",
)
def point_in_time_join(t):
    return joins.history_join(gold.spine(t.dpd), t.dim, "Customer_ID").withColumn("snapshot_date", day("snapshot_date"))


@query(
    """SELECT loan_id, Customer_ID, CAST(snapshot_date AS VARCHAR) AS snapshot_date, mob, o_totalprice, o_orderpriority
        FROM (SELECT s.*, o_totalprice, o_orderpriority, row_number() OVER (PARTITION BY rid
                ORDER BY d.snapshot_date DESC NULLS LAST, o_totalprice DESC, o_orderpriority DESC) AS k
            FROM (SELECT loan_id, Customer_ID, snapshot_date, mob, row_number() OVER () AS rid FROM v_dpd WHERE mob = 0) s
            LEFT JOIN v_dim d ON s.Customer_ID = d.Customer_ID AND d.snapshot_date <= s.snapshot_date)
        WHERE k = 1""",
    "v_dpd v_dim",
)
def point_in_time_latest(t):
    return joins.latest_join(gold.spine(t.dpd), t.dim, "Customer_ID").withColumn("snapshot_date", day("snapshot_date"))


@query(
    """SELECT loan_id, l.Customer_ID, installment_num, balance, segment
        FROM v_loan l LEFT JOIN v_cust c ON l.Customer_ID = c.Customer_ID""",
    "v_loan v_cust",
)
def left_enrich(t):
    side = t.cust.select("Customer_ID", "balance", "segment", F.lit(9).alias("installment_num"))
    return joins.enrich(t.loan.select("loan_id", "Customer_ID", "installment_num"), side, ["Customer_ID"])


TRAILING = """
    SELECT s.event_id, s.user_id, CAST(s.d AS VARCHAR) AS snapshot_date, round(avg(f.fe_1), 6) AS avg_fe_1_last_6m,
        round(avg(f.fe_2), 6) AS avg_fe_2_last_6m, count(f.d) AS clickstream_snapshot_count
    FROM (SELECT event_id, user_id, ts::DATE AS d FROM events WHERE event_type = 'signup') s
    LEFT JOIN (SELECT user_id, ts::DATE AS d, CAST(round(value * 100) AS BIGINT) AS fe_1,
            CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS fe_2
        FROM events WHERE event_type IN ('view', 'click')) f
    ON s.user_id = f.user_id AND f.d BETWEEN s.d - 7 AND s.d
    GROUP BY ALL"""


@query(TRAILING)
def trailing_window_features(t):
    out = joins.trailing_features(t.click_spine, t.click_facts, "user_id", ["fe_1", "fe_2"], 7)
    out = out.withColumn("snapshot_date", day("snapshot_date"))
    return rounded(out, 6, "avg_fe_1_last_6m", "avg_fe_2_last_6m")


FEATURE_STORE = """
    WITH spine AS (SELECT loan_id, Customer_ID, snapshot_date, mob, row_number() OVER () AS rid FROM v_dpd WHERE mob = 0),
    dim AS (SELECT 'CUS_0x' || to_hex(o_custkey) AS Customer_ID, CAST(o_orderdate AS DATE) AS d, o_totalprice AS Outstanding_Debt,
            CASE WHEN contains(o_orderpriority, 'URGENT') THEN 1 ELSE 0 END AS credit_mix_good,
            CASE WHEN contains(o_orderpriority, 'LOW') THEN 1 ELSE 0 END AS credit_mix_bad FROM orders),
    facts AS (SELECT Customer_ID, snapshot_date AS d, CAST(trunc(loan_amt) AS BIGINT) AS fe_1, installment_num AS fe_2 FROM v_loan),
    wide AS (SELECT s.* EXCLUDE (rid), Outstanding_Debt, credit_mix_good, credit_mix_bad FROM spine s
        LEFT JOIN dim ON s.Customer_ID = dim.Customer_ID AND dim.d <= s.snapshot_date{latest})
    SELECT w.loan_id, w.Customer_ID, CAST(w.snapshot_date AS VARCHAR) AS snapshot_date, mob, Outstanding_Debt, credit_mix_good,
        credit_mix_bad, n_regionkey, round(avg(fe_1), 4) AS avg_fe_1_last_6m, round(avg(fe_2), 4) AS avg_fe_2_last_6m,
        count(f.d) AS clickstream_snapshot_count, CAST(w.snapshot_date AS VARCHAR) AS feature_snapshot_date
    FROM wide w LEFT JOIN (SELECT 'CUS_0x' || to_hex(c_custkey) AS cid, n_regionkey
            FROM customer JOIN nation ON c_nationkey = n_nationkey) c ON w.Customer_ID = cid
    LEFT JOIN facts f ON w.Customer_ID = f.Customer_ID AND f.d BETWEEN w.snapshot_date - 180 AND w.snapshot_date
    GROUP BY ALL"""
NEWEST = " QUALIFY row_number() OVER (PARTITION BY s.rid ORDER BY dim.d DESC NULLS LAST, Outstanding_Debt DESC) = 1"


def _features(t, latest_only):
    mix = F.when(F.col("o_orderpriority").contains("URGENT"), "GOOD").when(F.col("o_orderpriority").contains("LOW"), "BAD")
    financials = t.dim.select(
        "Customer_ID", "snapshot_date", F.col("o_totalprice").alias("Outstanding_Debt"), mix.alias("Credit_Mix")
    )
    attributes = t.table("customer").join(t.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    attributes = attributes.select(F.concat(F.lit("CUS_0x"), F.hex("c_custkey")).alias("Customer_ID"), "n_regionkey")
    clicks = t.loan.select(
        "Customer_ID", "snapshot_date", F.col("loan_amt").cast("bigint").alias("fe_1"), F.col("installment_num").alias("fe_2")
    )
    out = gold.features(t.dpd, attributes, financials, clicks, latest_only=latest_only).drop("credit_mix_standard")
    out = out.withColumn("snapshot_date", day("snapshot_date"))
    return rounded(out, 4, "avg_fe_1_last_6m", "avg_fe_2_last_6m")


@query(FEATURE_STORE.format(latest=""), "v_dpd v_loan")
def feature_store(t):
    """Every earlier customer row joined, as the feature table is defined."""
    return _features(t, False)


@query(FEATURE_STORE.format(latest=NEWEST), "v_dpd v_loan")
def feature_store_latest(t):
    """One customer row per application."""
    return _features(t, True)


@query(
    """SELECT split, loan_id, CAST(snapshot_date AS VARCHAR) AS snapshot_date, quantity, price, tax, discount,
        CAST(NULL AS DOUBLE) AS return_text, label, label_def
        FROM v_pair JOIN v_windows ON snapshot_date BETWEEN start_date AND end_date""",
    "v_pair v_windows",
)
def training_set(t):
    rows = training.training_rows(t.feat, gold.labels(t.dpd, 60, 6), WINDOWS).drop("Customer_ID")
    return rows.withColumn("snapshot_date", day("snapshot_date"))


@query(
    """SELECT split, round(avg(label), 6) AS default_rate, count(*) AS n
        FROM v_pair JOIN v_windows ON snapshot_date BETWEEN start_date AND end_date GROUP BY split""",
    "v_pair v_windows",
)
def split_summary(t):
    rows = training.training_rows(t.feat, gold.labels(t.dpd, 60, 6), WINDOWS)
    return rounded(tables.split_balance(rows), 6, "default_rate")


@query(
    """SELECT split FROM v_windows WHERE split NOT IN
        (SELECT split FROM v_loan JOIN v_windows ON snapshot_date BETWEEN start_date AND end_date)""",
    "v_loan v_windows",
)
def empty_splits(t):
    return tables.empty_splits(joins.assign_splits(t.loan, "snapshot_date", WINDOWS), WINDOWS)


@query(
    """WITH l AS (SELECT loan_id, Customer_ID, label, CAST(snapshot_date + to_months(6) AS DATE) AS d FROM v_month WHERE model_id = 'model_1')
        SELECT CAST(l.d AS VARCHAR) AS label_date, CAST(p.snapshot_date AS VARCHAR) AS inference_date, model_id, count(*) AS n,
            sum(l.label)::BIGINT AS n_default, round(sum(prediction_proba), 4) AS proba
        FROM l JOIN v_month p ON l.loan_id = p.loan_id AND l.Customer_ID = p.Customer_ID AND p.snapshot_date = l.d - to_months(6)
        GROUP BY ALL""",
    "v_month",
)
def lag_alignment(t):
    predictions = t.month.drop("label").withColumnRenamed("snapshot_date", "inference_date")
    outcome = t.month.where("model_id = 'model_1'").select(
        "loan_id", "Customer_ID", "label", F.add_months("snapshot_date", 6).alias("snapshot_date")
    )
    rows = joins.lagged(outcome, predictions)
    totals = rows.groupBy("label_date", "inference_date", "model_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("label").alias("n_default"), F.sum("prediction_proba").alias("proba")
    )
    totals = totals.withColumns({c: day(c) for c in ("label_date", "inference_date")})
    return rounded(totals, 4, "proba")


FALLBACK = """
    WITH l AS (SELECT DISTINCT snapshot_date AS t, loan_start_date AS c FROM v_loan WHERE installment_num = 6),
    a AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS c FROM orders WHERE o_orderstatus = 'F'),
    k AS (SELECT t, c, 1 AS r FROM l UNION ALL SELECT DISTINCT t, CAST(t - to_months(6) AS DATE), 0 FROM l
        UNION ALL SELECT DISTINCT t, t, 2 FROM l),
    g AS (SELECT t, c, {rank} AS r FROM k GROUP BY t, c)
    SELECT CAST(t AS VARCHAR) AS label_date, CAST(arg_min(c, (r, c)) FILTER (c IN (SELECT c FROM a)) AS VARCHAR) AS prediction_date,
        CASE min(r) FILTER (c IN (SELECT c FROM a)) WHEN 0 THEN 'offset' WHEN 1 THEN 'id_date' WHEN 2 THEN 'same_day' END AS source
    FROM g GROUP BY t"""


def _fallback(t, strict):
    outcome = t.loan.where("installment_num = 6")
    # Only finished orders have scores, so later days are gaps that alignment has to fall back over.
    scored = t.table("orders").where("o_orderstatus = 'F'").select(F.col("o_orderdate").cast("date").alias("inference_date"))
    rows = joins.aligned_snapshots(outcome, scored, strict_priority=strict)
    return rows.select(day("label_date").alias("label_date"), day("prediction_date").alias("prediction_date"), "source")


@query(FALLBACK.format(rank="CASE WHEN bool_or(r = 1) THEN 1 ELSE min(r) END"), "v_loan")
def fallback_alignment(t):
    return _fallback(t, False)


@query(FALLBACK.format(rank="min(r)"), "v_loan")
def fallback_alignment_strict(t):
    return _fallback(t, True)


@query(
    """SELECT p.loan_id, p.Customer_ID, p.prediction_proba, p.prediction_label, CASE WHEN dpd >= 60 THEN 1 ELSE 0 END AS label
        FROM (SELECT DISTINCT ON (loan_id, Customer_ID) loan_id, Customer_ID, prediction_proba, prediction_label FROM v_month
            WHERE model_id = 'model_1' ORDER BY loan_id, Customer_ID, prediction_proba) p
        JOIN v_dpd d ON p.loan_id = d.loan_id AND p.Customer_ID = d.Customer_ID WHERE mob = 6""",
    "v_month v_dpd",
)
def score_label_join(t):
    lowest = t.month.where("model_id = 'model_1'").groupBy("loan_id", "Customer_ID")
    predictions = lowest.agg(F.min(F.struct("prediction_proba", "prediction_label")).alias("p"))
    predictions = predictions.select("loan_id", "Customer_ID", "p.*")
    return joins.labelled(predictions, gold.labels(t.dpd, 60, 6)).drop("label_def")


@query(
    """WITH a AS (SELECT loan_id, Customer_ID FROM v_loan WHERE installment_num = 0),
        b AS (SELECT loan_id, Customer_ID FROM v_loan WHERE installment_num = 6)
        SELECT (SELECT count(*) FROM a)::BIGINT AS left_rows, (SELECT count(*) FROM b)::BIGINT AS right_rows,
            (SELECT count(*) FROM a JOIN b USING (loan_id, Customer_ID))::BIGINT AS matched""",
    "v_loan",
)
def match_report(t):
    return joins.match_report(t.loan.where("installment_num = 0"), t.loan.where("installment_num = 6"))


@query(
    """WITH a AS (SELECT DISTINCT loan_id FROM v_loan WHERE installment_num = 0),
        b AS (SELECT DISTINCT loan_id FROM v_loan WHERE installment_num = 6),
        u AS (SELECT 'left' AS side, loan_id FROM a WHERE loan_id NOT IN (SELECT loan_id FROM b)
            UNION ALL SELECT 'right', loan_id FROM b WHERE loan_id NOT IN (SELECT loan_id FROM a))
        SELECT side, count(*) AS n_keys, min(right(loan_id, 10)) AS first_start, max(right(loan_id, 10)) AS last_start,
            count(DISTINCT right(loan_id, 10)) AS n_starts, array_to_string(list_sort(list(loan_id))[1:5], ',') AS sample_ids
        FROM u GROUP BY side""",
    "v_loan",
)
def unmatched_keys(t):
    found = joins.unmatched_summary(t.loan.where("installment_num = 0"), t.loan.where("installment_num = 6"))
    return found.withColumn("sample_ids", F.array_join("sample_ids", ","))


@query(
    """SELECT DISTINCT strftime(loan_start_date, '%Y_%m_%d') AS loan_start_date FROM v_loan""",
    "v_loan",
)
def start_dates(t):
    return joins.start_dates(t.loan)


@query(
    """WITH m AS (SELECT DISTINCT model_id, snapshot_date AS month FROM v_month),
        x AS (SELECT max(month) AS last FROM m)
        SELECT model_id, CAST(CAST(last - to_months(k::INTEGER) AS DATE) AS VARCHAR) AS month
        FROM (SELECT DISTINCT model_id FROM m), x, (SELECT unnest(range(8)) AS k)
        WHERE model_id || CAST(CAST(last - to_months(k::INTEGER) AS DATE) AS VARCHAR) NOT IN
            (SELECT model_id || CAST(month AS VARCHAR) FROM m, x WHERE NOT (model_id = 'model_2' AND month >= last - to_months(3)))""",
    "v_month",
)
def missing_outputs(t):
    done = t.month.select("model_id", F.col("snapshot_date").alias("month"))
    last = t.month.select(F.max("snapshot_date")).scalar()
    without_last_months_of_model_2 = ~((F.col("model_id") == "model_2") & (F.col("month") >= F.add_months(last, -3)))
    kept = done.where(without_last_months_of_model_2)
    required = joins.required_outputs(done.select("model_id").distinct(), last, 8)
    return joins.missing_outputs(required, kept).select("model_id", day("month").alias("month"))


@query(
    """WITH f AS (SELECT *, date_trunc('month', snapshot_date) AS m FROM v_feat),
        l AS (SELECT *, date_trunc('month', snapshot_date) AS m FROM v_dpd WHERE mob = 6),
        j AS (SELECT f.m, count(*) AS n FROM f JOIN l ON f.m = l.m AND f.loan_id = l.loan_id AND f.Customer_ID = l.Customer_ID GROUP BY f.m)
        SELECT CAST(CAST(coalesce(a.m, b.m) AS DATE) AS VARCHAR) AS snapshot_date, coalesce(a.n, 0)::BIGINT AS n_features,
            coalesce(b.n, 0)::BIGINT AS n_labels, coalesce(j.n, 0)::BIGINT AS n_joined
        FROM (SELECT m, count(*) AS n FROM f GROUP BY m) a FULL JOIN (SELECT m, count(*) AS n FROM l GROUP BY m) b ON a.m = b.m
        LEFT JOIN j ON j.m = coalesce(a.m, b.m)""",
    "v_feat v_dpd",
)
def availability_report(t):
    def by_month(df):
        return df.withColumn("snapshot_date", F.trunc("snapshot_date", "MM"))

    rows = joins.availability(by_month(t.feat), by_month(gold.labels(t.dpd)))
    return rows.withColumn("snapshot_date", day("snapshot_date"))


@query(
    """WITH s AS (SELECT DISTINCT snapshot_date AS d FROM v_month),
        p AS (SELECT snapshot_date AS d, count(DISTINCT model_id) AS n FROM v_month
            WHERE NOT (model_id = 'model_2' AND snapshot_date < DATE '1996-01-01') GROUP BY 1)
        SELECT CAST(s.d AS VARCHAR) AS snapshot_date, s.d >= DATE '1999-12-01' AS can_train, true AS can_score,
            coalesce(p.n = 2, false) AS can_monitor
        FROM s LEFT JOIN p ON p.d = s.d - to_months(6)""",
    "v_month",
)
def readiness(t):
    first_year_of_model_2 = (F.col("model_id") == "model_2") & (F.col("snapshot_date") < F.lit("1996-01-01").cast("date"))
    predictions = t.month.where(~first_year_of_model_2).withColumnRenamed("snapshot_date", "inference_date")
    rows = gates.readiness(
        t.month, t.month.select("model_id"), predictions, ["model_1", "model_2"], first_training="1999-12-01"
    )
    return rows.withColumn("snapshot_date", day("snapshot_date"))


@query(
    """SELECT event_id, CAST(CAST(d - 180 AS DATE) AS VARCHAR) AS window_start
        FROM (SELECT event_id, ts::DATE AS d FROM events)"""
)
def window_start(t):
    start = dates.window_start(F.col("ts").cast("date"), 180)
    return t.table("events").select("event_id", day(start).alias("window_start"))


@query(
    """SELECT loan_id, quantity, price, CAST(NULL AS DOUBLE) AS trained_but_absent,
        CAST(NULL AS DOUBLE) AS return_text FROM v_feat""",
    "v_feat",
)
def align_features(t):
    names = ["trained_but_absent", "quantity", "return_text", "price"]
    return schema.numeric_features(schema.align_features(t.feat, names, ["loan_id"]), names)
