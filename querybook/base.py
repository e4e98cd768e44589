"""Query registry and the views that give the test tables the shape the operators expect.

Each view exists twice, as a DataFrame and as SQL text, built the same way.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenorlake import settings
from tenorlake.operators import metrics
from tenorlake.plans import silver, specs
from tenorlake.sources import lineage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Orders run from 1995; moved by 25 years they fall into the accepted date range.
SHIFT = 300
AS_OF = "2026-03-31"


def query(sql: str | None = None, views: str = ""):
    """Register a function of ``Tables``; ``views`` names the SQL views the text uses."""

    def register(function):
        name = function.__name__
        QUERIES[name] = lambda spark, sf_dir: function(Tables(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = with_views(views, sql)
        return function

    return register


def with_views(views: str, sql: str) -> str:
    """Put the named views, and those they build on, in front of the text."""
    needed: list[str] = []

    def add(name: str) -> None:
        for other in VIEW_NEEDS.get(name, "").split():
            add(other)
        if name not in needed:
            needed.append(name)

    for name in views.split():
        add(name)
    sql = sql.strip()
    if not needed:
        return sql
    head = "WITH " + ",\n".join(f"{n} AS ({VIEW_SQL[n].strip()})" for n in needed)
    return f"{head},\n{sql[5:]}" if sql.upper().startswith("WITH ") else f"{head}\n{sql}"


def scratch(spark: SparkSession) -> str:
    """A fresh folder all executors see."""
    return lineage.fresh_path(spark, "querybook")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt over all cores: a file of few bytes is one split, however much work its rows are later."""
    return df.repartition(2 * df.sparkSession.sparkContext.defaultParallelism, *keys)


def day(column: str | Column) -> Column:
    """Date as ISO text, the form results are compared in."""
    return F.date_format(column, "yyyy-MM-dd")


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.expr(f"round(cast(`{c}` as double), {digits}) + 0D") for c in columns})


VIEW_NEEDS = {
    "v_dpd": "v_loan",
    "v_auc": "v_month",
    "v_metrics": "v_auc",
    "v_pair": "v_feat v_dpd",
    "v_check": "v_metrics v_limits v_base",
}

VIEW_SQL = {
    "v_loan": """
        SELECT 'CUS_0x' || to_hex(o_custkey) || '_' || strftime(o_orderdate, '%Y_%m_%d') AS loan_id,
            'CUS_0x' || to_hex(o_custkey) AS Customer_ID, CAST(o_orderdate AS DATE) AS loan_start_date,
            l_linenumber - 1 AS installment_num, CAST(l_extendedprice AS FLOAT) AS loan_amt,
            CAST(l_extendedprice / l_quantity AS FLOAT) AS due_amt,
            CAST(l_extendedprice * l_discount AS FLOAT) AS overdue_amt, CAST(l_shipdate AS DATE) AS snapshot_date
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "v_dpd": """
        SELECT *, CASE WHEN overdue_amt > 0 AND first_missed_date IS NOT NULL
                THEN date_diff('day', first_missed_date, snapshot_date) ELSE 0 END AS dpd
        FROM (SELECT *, CASE WHEN installments_missed > 0
                THEN CAST(snapshot_date - to_months(installments_missed) AS DATE) END AS first_missed_date
            FROM (SELECT *, installment_num AS mob, CASE WHEN due_amt > 0
                    THEN CAST(ceil(CAST(overdue_amt AS DOUBLE) / CAST(due_amt AS DOUBLE)) AS INTEGER)
                    ELSE 0 END AS installments_missed
                FROM v_loan))""",
    "v_dim": """
        SELECT 'CUS_0x' || to_hex(o_custkey) AS Customer_ID, CAST(o_orderdate AS DATE) AS snapshot_date,
            o_totalprice, o_orderpriority
        FROM orders""",
    "v_cust": """
        SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN 'cus_' || c_custkey WHEN c_custkey % 11 = 0 THEN NULL
                ELSE 'CUS_0x' || to_hex(c_custkey) END AS Customer_ID,
            CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE c_acctbal END AS balance,
            ' ' || lower(c_mktsegment) || ' ' AS segment, c_nationkey, n_regionkey
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "v_text": """
        SELECT c_custkey, CASE c_custkey % 6 WHEN 0 THEN '$' || s WHEN 1 THEN s || '_' WHEN 2 THEN ' ' || s || ' '
                WHEN 3 THEN '1,' || s WHEN 4 THEN 'abc' || s END AS amount
        FROM (SELECT c_custkey, CAST(c_acctbal AS VARCHAR) AS s FROM customer)""",
    "v_dates": """
        SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN strftime(d, '%-d/%-m/%y') WHEN 1 THEN strftime(d, '%Y-%m-%d')
                WHEN 2 THEN strftime(d, '%-d/%-m/%Y') ELSE 'junk' END AS raw_date, d AS true_date
        FROM (SELECT o_orderkey, CAST(o_orderdate + to_months(300) AS DATE) AS d FROM orders)""",
    "v_part": """
        SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN p_size || ' Years and ' || (p_partkey % 12) || ' Months'
                WHEN 1 THEN '1 Year' WHEN 2 THEN p_size || ' Months' WHEN 3 THEN 'NA' END AS history_age,
            CASE p_partkey % 5 WHEN 0 THEN a || ' Loan, and ' || b || ' Loan' WHEN 1 THEN 'Not Specified'
                WHEN 2 THEN a || ' Loan, ' || a || ' Loan' WHEN 3 THEN '' ELSE b || '-Equity Loan, ' || a END AS loan_types
        FROM (SELECT p_partkey, p_size, split_part(p_name, ' ', 1) AS a, split_part(p_name, ' ', 2) AS b FROM part)""",
    "v_score": """
        SELECT documents.doc_id, lang, source, quality AS label, n_chars / (n_chars + 1000.0::DOUBLE) AS prediction_proba,
            CASE WHEN n_chars / (n_chars + 1000.0::DOUBLE) >= 0.5 THEN 1 ELSE 0 END AS prediction_label
        FROM labels JOIN documents ON labels.doc_id = documents.doc_id""",
    "v_month": """
        SELECT *, CASE WHEN prediction_proba >= 0.5 THEN 1 ELSE 0 END AS prediction_label
        FROM (SELECT 'CUS_0x' || to_hex(o_custkey) || '_' || strftime(o_orderdate, '%Y_%m_%d') AS loan_id,
                'CUS_0x' || to_hex(o_custkey) AS Customer_ID, CAST(date_trunc('month', o_orderdate) AS DATE) AS snapshot_date,
                CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS label, 'model_1' AS model_id,
                'logistic_regression' AS model_type, o_totalprice / (o_totalprice + 150000) AS prediction_proba
            FROM orders
            UNION ALL
            SELECT 'CUS_0x' || to_hex(o_custkey) || '_' || strftime(o_orderdate, '%Y_%m_%d'),
                'CUS_0x' || to_hex(o_custkey), CAST(date_trunc('month', o_orderdate) AS DATE),
                CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END, 'model_2', 'gradient_boosting',
                (o_totalprice + 1000 * (o_custkey % 97)) / (o_totalprice + 1000 * (o_custkey % 97) + 200000)
            FROM orders)""",
    "v_auc": """
        SELECT model_id, model_type, snapshot_date,
            CASE WHEN count(*) FILTER (label = 1) > 0 AND count(*) FILTER (label = 0) > 0 THEN
                (sum(rk) FILTER (label = 1) - count(*) FILTER (label = 1) * (count(*) FILTER (label = 1) + 1) / 2.0)
                / (count(*) FILTER (label = 1) * count(*) FILTER (label = 0)) END AS roc_auc
        FROM (SELECT *, CAST(rank() OVER (PARTITION BY model_id, snapshot_date ORDER BY prediction_proba) AS DOUBLE)
                + (count(*) OVER (PARTITION BY model_id, snapshot_date, prediction_proba) - 1) / 2.0 AS rk
            FROM v_month)
        GROUP BY ALL""",
    "v_metrics": """
        SELECT c.*, roc_auc, CAST(tp + tn AS DOUBLE) / total_samples AS accuracy,
            CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / (tp + fp) ELSE 0.0 END AS precision,
            CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / (tp + fn) ELSE 0.0 END AS recall,
            CASE WHEN 2 * tp + fp + fn > 0 THEN 2.0 * tp / (2 * tp + fp + fn) ELSE 0.0 END AS f1_score
        FROM (SELECT model_id, model_type, snapshot_date,
                count(*) FILTER (label = 0 AND prediction_label = 0) AS tn,
                count(*) FILTER (label = 0 AND prediction_label = 1) AS fp,
                count(*) FILTER (label = 1 AND prediction_label = 0) AS fn,
                count(*) FILTER (label = 1 AND prediction_label = 1) AS tp,
                count(*) AS total_samples, avg(prediction_proba) AS mean_prediction_proba,
                stddev_pop(prediction_proba) AS std_prediction_proba, min(prediction_proba) AS min_prediction_proba,
                max(prediction_proba) AS max_prediction_proba, median(prediction_proba) AS median_prediction_proba
            FROM v_month GROUP BY ALL) c
        JOIN v_auc USING (model_id, model_type, snapshot_date)""",
    "v_limits": """
        SELECT * FROM (VALUES ('roc_auc', 'P0', 'ROC-AUC', 0.75::DOUBLE, 0.80::DOUBLE, true, 'oot_roc_auc', 5.0::DOUBLE),
            ('accuracy', 'P1', 'Accuracy', 0.70, 0.75, true, 'oot_accuracy', 5.0),
            ('f1_score', 'P2', 'F1-Score', NULL, 0.60, false, NULL, NULL),
            ('precision', 'P3', 'Precision', NULL, 0.60, false, NULL, NULL),
            ('recall', 'P3', 'Recall', NULL, 0.65, false, NULL, NULL))
        AS t(metric, priority, name, business_threshold, data_science_threshold, baseline_enabled, reference, max_drop)""",
    "v_base": """
        SELECT model_id, metric, arg_min(v, snapshot_date) AS baseline_value
        FROM (SELECT model_id, snapshot_date, unnest(['roc_auc', 'accuracy']) AS metric, unnest([roc_auc, accuracy]) AS v
            FROM v_metrics) WHERE v IS NOT NULL GROUP BY ALL""",
    "v_check": """
        SELECT *, CASE severity WHEN 2 THEN 'CRITICAL' WHEN 1 THEN 'WARNING' ELSE 'OK' END AS status,
            CASE severity WHEN 2 THEN 'retrain' WHEN 1 THEN 'active_monitoring' ELSE 'monitor' END AS action
        FROM (SELECT *, CASE WHEN value < business_threshold THEN 2 WHEN value < data_science_threshold THEN 1
                WHEN baseline_enabled AND degradation > max_drop / 100.0 THEN 1 ELSE 0 END AS severity,
                CASE WHEN value < business_threshold
                    THEN printf('❌ %s (%.4f) below BUSINESS threshold (%.4f)', name, value, business_threshold)
                WHEN value < data_science_threshold
                    THEN printf('⚠️  %s (%.4f) below DATA SCIENCE threshold (%.4f)', name, value, data_science_threshold)
                WHEN baseline_enabled AND degradation > max_drop / 100.0
                    THEN printf('⚠️  %s degraded %.1f%% from %s baseline (%.4f)', name, 100 * degradation, reference, baseline_value)
                END AS alert
            FROM (SELECT *, (baseline_value - value) / baseline_value AS degradation
                FROM (SELECT model_id, snapshot_date, unnest(['roc_auc', 'accuracy', 'f1_score', 'precision', 'recall']) AS metric,
                    unnest([roc_auc, accuracy, f1_score, precision, recall]) AS value FROM v_metrics)
                JOIN v_limits USING (metric) LEFT JOIN v_base USING (model_id, metric)
                WHERE value IS NOT NULL))""",
    "v_feat": """
        SELECT 'CUS_0x' || to_hex(o_custkey) || '_' || strftime(o_orderdate, '%Y_%m_%d') AS loan_id,
            'CUS_0x' || to_hex(o_custkey) AS Customer_ID, CAST(l_shipdate AS DATE) AS snapshot_date,
            l_quantity AS quantity, l_extendedprice AS price, CASE WHEN l_tax > 0 THEN l_tax END AS tax,
            l_discount + 0.0 AS discount, l_returnflag AS return_text
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "v_pair": """
        SELECT f.*, CASE WHEN dpd >= 60 THEN 1 ELSE 0 END AS label, '60dpd_6mob' AS label_def
        FROM v_feat f JOIN v_dpd d ON f.loan_id = d.loan_id AND f.Customer_ID = d.Customer_ID WHERE d.mob = 6""",
}

# Split windows for the order years; they leave gaps and overlap on purpose.
WINDOWS = (
    {"split": "train", "start_date": "1995-01-01", "end_date": "1997-12-31"},
    {"split": "validation", "start_date": "1998-02-01", "end_date": "1998-12-31"},
    {"split": "test", "start_date": "1999-01-01", "end_date": "1999-12-31"},
    {"split": "oot1", "start_date": "2000-01-01", "end_date": "2000-08-31"},
    {"split": "oot2", "start_date": "2000-07-01", "end_date": "2001-12-31"},
    {"split": "oot3", "start_date": "2005-01-01", "end_date": "2005-12-31"},
)


def _windows_sql() -> str:
    rows = ", ".join(f"('{w['split']}', DATE '{w['start_date']}', DATE '{w['end_date']}')" for w in WINDOWS)
    return f"SELECT * FROM (VALUES {rows}) AS w(split, start_date, end_date)"


VIEW_SQL["v_windows"] = _windows_sql()


def _hex_id(column: str) -> Column:
    return F.concat(F.lit("CUS_0x"), F.hex(column))


class Tables:
    """The test tables and views of one directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = settings.prepare(spark), sf_dir
        self._read: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._read:
            self._read[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._read[name]

    @cached_property
    def _lines(self) -> DataFrame:
        return self.table("lineitem").join(self.table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))

    @cached_property
    def loan(self) -> DataFrame:
        return self._lines.select(
            self._loan_id.alias("loan_id"),
            _hex_id("o_custkey").alias("Customer_ID"),
            F.col("o_orderdate").cast("date").alias("loan_start_date"),
            (F.col("l_linenumber") - 1).alias("installment_num"),
            F.col("l_extendedprice").cast("float").alias("loan_amt"),
            (F.col("l_extendedprice") / F.col("l_quantity")).cast("float").alias("due_amt"),
            (F.col("l_extendedprice") * F.col("l_discount")).cast("float").alias("overdue_amt"),
            F.col("l_shipdate").cast("date").alias("snapshot_date"),
        )

    @property
    def _loan_id(self) -> Column:
        return F.concat(_hex_id("o_custkey"), F.lit("_"), F.date_format("o_orderdate", "yyyy_MM_dd"))

    @cached_property
    def dpd(self) -> DataFrame:
        return silver.derive(self.loan, specs.LOAN_DAILY)

    @cached_property
    def dim(self) -> DataFrame:
        return self.table("orders").select(
            _hex_id("o_custkey").alias("Customer_ID"),
            F.col("o_orderdate").cast("date").alias("snapshot_date"),
            "o_totalprice",
            "o_orderpriority",
        )

    @cached_property
    def cust(self) -> DataFrame:
        key = F.col("c_custkey")
        bad_id = F.concat(F.lit("cus_"), key.cast("string"))
        joined = self.table("customer").join(self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        return joined.select(
            "c_custkey",
            F.when(key % 7 == 0, bad_id).when(key % 11 != 0, _hex_id("c_custkey")).alias("Customer_ID"),
            F.when(key % 10 != 0, F.col("c_acctbal")).alias("balance"),
            F.concat(F.lit(" "), F.lower("c_mktsegment"), F.lit(" ")).alias("segment"),
            "c_nationkey",
            "n_regionkey",
        )

    @cached_property
    def text(self) -> DataFrame:
        s, kind = F.col("c_acctbal").cast("string"), F.col("c_custkey") % 6
        forms = [F.concat(F.lit("$"), s), F.concat(s, F.lit("_")), F.concat(F.lit(" "), s, F.lit(" "))]
        forms += [F.concat(F.lit("1,"), s), F.concat(F.lit("abc"), s)]
        amount = F.coalesce(*[F.when(kind == i, f) for i, f in enumerate(forms)])
        return self.table("customer").select("c_custkey", amount.alias("amount"))

    @cached_property
    def dates(self) -> DataFrame:
        d, kind = F.add_months(F.col("o_orderdate").cast("date"), SHIFT), F.col("o_orderkey") % 4
        raw = F.when(kind == 0, F.date_format(d, "d/M/yy")).when(kind == 1, F.date_format(d, "yyyy-MM-dd"))
        raw = raw.when(kind == 2, F.date_format(d, "d/M/yyyy")).otherwise("junk")
        return self.table("orders").select("o_orderkey", raw.alias("raw_date"), d.alias("true_date"))

    @cached_property
    def part(self) -> DataFrame:
        kind, size = F.col("p_partkey") % 5, F.col("p_size").cast("string")
        a, b = (F.split_part("p_name", F.lit(" "), F.lit(i)) for i in (1, 2))
        months = (F.col("p_partkey") % 12).cast("string")
        age = (
            F.when(kind == 0, F.concat(size, F.lit(" Years and "), months, F.lit(" Months")))
            .when(kind == 1, "1 Year")
            .when(kind == 2, F.concat(size, F.lit(" Months")))
            .when(kind == 3, "NA")
        )
        types = (
            F.when(kind == 0, F.concat(a, F.lit(" Loan, and "), b, F.lit(" Loan")))
            .when(kind == 1, "Not Specified")
            .when(kind == 2, F.concat(a, F.lit(" Loan, "), a, F.lit(" Loan")))
            .when(kind == 3, "")
            .otherwise(F.concat(b, F.lit("-Equity Loan, "), a))
        )
        return self.table("part").select("p_partkey", age.alias("history_age"), types.alias("loan_types"))

    @cached_property
    def click_spine(self) -> DataFrame:
        signups = self.table("events").where("event_type = 'signup'")
        return signups.select("event_id", "user_id", F.col("ts").cast("date").alias("snapshot_date"))

    @cached_property
    def click_facts(self) -> DataFrame:
        facts = self.table("events").where("event_type in ('view', 'click')")
        cents = F.round(F.col("value") * 100).cast("bigint")
        is_click = F.when(F.col("event_type") == "click", 1).otherwise(0)
        return facts.select(
            "user_id", F.col("ts").cast("date").alias("snapshot_date"), cents.alias("fe_1"), is_click.alias("fe_2")
        )

    @cached_property
    def score(self) -> DataFrame:
        proba = F.col("n_chars") / (F.col("n_chars") + F.lit(1000.0))
        rows = self.table("labels").join(self.table("documents"), "doc_id")
        return rows.select(
            "doc_id", "lang", "source", F.col("quality").alias("label"), proba.alias("prediction_proba")
        ).withColumn("prediction_label", F.when(F.col("prediction_proba") >= 0.5, 1).otherwise(0))

    @cached_property
    def month(self) -> DataFrame:
        price = F.col("o_totalprice")
        moved = price + 1000 * (F.col("o_custkey") % 97)
        model = F.struct(F.lit("model_1"), F.lit("logistic_regression"), price / (price + 150000))
        other = F.struct(F.lit("model_2"), F.lit("gradient_boosting"), moved / (moved + 200000))
        names = "struct<model_id:string,model_type:string,prediction_proba:double>"
        return (
            self.table("orders")
            .select(
                self._loan_id.alias("loan_id"),
                _hex_id("o_custkey").alias("Customer_ID"),
                F.trunc("o_orderdate", "MM").alias("snapshot_date"),
                F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("label"),
                F.inline(F.array(model.cast(names), other.cast(names))),
            )
            .withColumn("prediction_label", F.when(F.col("prediction_proba") >= 0.5, 1).otherwise(0))
        )

    @cached_property
    def metrics(self) -> DataFrame:
        """The metric table; written once, as reports read it several times."""
        return lineage.settled(metrics.model_metrics(self.month), "metrics")

    @cached_property
    def baselines(self) -> DataFrame:
        """First value of each model as its baseline."""
        found = self.metrics.groupBy("model_id").agg(
            *[F.min_by(m, F.when(F.col(m).isNotNull(), F.col("snapshot_date"))).alias(f"oot_{m}") for m in ("roc_auc", "accuracy")]
        )
        return found.withColumns({f"test_{m}": F.col(f"oot_{m}") - 0.01 for m in ("roc_auc", "accuracy")})

    @cached_property
    def feat(self) -> DataFrame:
        return self._lines.select(
            self._loan_id.alias("loan_id"),
            _hex_id("o_custkey").alias("Customer_ID"),
            F.col("l_shipdate").cast("date").alias("snapshot_date"),
            F.col("l_quantity").alias("quantity"),
            F.col("l_extendedprice").alias("price"),
            F.when(F.col("l_tax") > 0, F.col("l_tax")).alias("tax"),
            (F.col("l_discount") + 0.0).alias("discount"),
            F.col("l_returnflag").alias("return_text"),
        )
