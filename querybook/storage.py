"""Sources and sinks: written, read back, compared with what went in."""

from pyspark.sql import functions as F

from querybook.base import AS_OF, SHIFT, WINDOWS, day, query, scratch, spread
from querybook.monitoring import with_day
from tenorlake.operators import rules
from tenorlake.operators.rules import Strategy
from tenorlake.plans import bronze, build, monitoring, silver, specs
from tenorlake.sources import config, documents, lineage, snapshots
from tenorlake.streaming import catchup


def by_month(t):
    return t.loan.select("loan_id", "due_amt", F.trunc("snapshot_date", "MM").alias("snapshot_date"))


@query(
    """SELECT CAST(CAST(date_trunc('month', snapshot_date) AS DATE) AS VARCHAR) AS snapshot_date, count(*) AS n,
        count(DISTINCT loan_id) AS n_loans FROM v_loan WHERE snapshot_date < DATE '1999-07-01' GROUP BY 1""",
    "v_loan",
)
def roundtrip_parquet(t):
    """Write all snapshots, write one of them again, read up to a cutoff."""
    root = scratch(t.spark) + "/loans"
    rows = by_month(t)
    snapshots.write_snapshots(rows, root)
    snapshots.write_snapshots(rows.where("snapshot_date = date'1998-03-01'"), root)
    back = snapshots.read_snapshots(t.spark, root, up_to="1999-06-01")
    counts = back.groupBy("snapshot_date").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("loan_id").alias("n_loans"))
    return with_day(counts)


@query(
    """WITH m AS (SELECT CAST(date_trunc('month', snapshot_date) AS DATE) AS d, count(*) AS n, count(DISTINCT loan_id) AS n_loans FROM v_loan GROUP BY 1)
        SELECT 'staged' AS state, CAST(d AS VARCHAR) AS snapshot_date, n, n_loans FROM m
        UNION ALL SELECT 'committed', CAST(d AS VARCHAR), n, n_loans FROM m WHERE d >= DATE '1998-03-01'""",
    "v_loan",
)
def commit_interrupted(t):
    """A rewrite from the table's own rows that stops before its commit is invisible, one that stops after it is whole."""
    root = scratch(t.spark) + "/loans"
    snapshots.write_snapshots(by_month(t), root)
    later = snapshots.read_snapshots(t.spark, root).where("snapshot_date >= date'1998-03-01'")
    staged = snapshots.stage(later, root, replaces=F.lit(True))

    def state(name):
        rows = snapshots.read_snapshots(t.spark, root).groupBy("snapshot_date").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("loan_id").alias("n_loans"))
        return lineage.settled(with_day(rows).withColumn("state", F.lit(name)), name)

    before = state("staged")
    snapshots.commit(t.spark, root, staged)  # and no more: whoever reads next puts the folders into place
    return before.unionByName(state("committed"))


@query(
    """SELECT count(*) AS n, CAST(min(snapshot_date) AS VARCHAR) AS first_day, count(DISTINCT snapshot_date) AS n_days FROM v_loan""",
    "v_loan",
)
def read_glob(t):
    """All partitions by a path pattern."""
    root = scratch(t.spark) + "/loans"
    snapshots.write_snapshots(t.loan.withColumn("part", F.year("snapshot_date")), root, ("part",))
    back = snapshots.read_glob(t.spark, f"{root}/part=*")
    return back.agg(
        F.count(F.lit(1)).alias("n"),
        day(F.min("snapshot_date")).alias("first_day"),
        F.count_distinct("snapshot_date").alias("n_days"),
    )


@query(
    """SELECT CAST(CAST(date_trunc('month', snapshot_date) AS DATE) AS VARCHAR) AS snapshot_date, installment_num, count(*) AS n
        FROM v_loan GROUP BY ALL""",
    "v_loan",
)
def roundtrip_csv(t):
    """CSV source to bronze to typed rows; the single-digit date form comes back as a date."""
    root = scratch(t.spark)
    month = F.trunc("snapshot_date", "MM")
    plain = t.loan.select("loan_id", "installment_num", F.date_format(month, "d/M/yy").alias("snapshot_date"))
    plain.write.option("header", True).csv(f"{root}/source")
    bronze.ingest(t.spark, f"{root}/source", f"{root}/bronze")
    back = snapshots.read_snapshots(t.spark, f"{root}/bronze")
    # years before 2000 written with two digits read as 2095 to 2099
    century = F.when(F.year("snapshot_date") > 2090, F.add_months("snapshot_date", -1200)).otherwise(F.col("snapshot_date"))
    typed = back.select(F.col("installment_num").cast("int").alias("installment_num"), century.alias("snapshot_date"))
    return with_day(typed.groupBy("snapshot_date", "installment_num").agg(F.count(F.lit(1)).alias("n")))


@query(
    """SELECT CAST(CAST(date_trunc('month', snapshot_date) AS DATE) AS VARCHAR) AS snapshot_date, count(*) AS n
        FROM v_loan GROUP BY 1""",
    "v_loan",
)
def catch_up_ingest(t):
    """New files only, twice: the second run finds nothing to add."""
    root = scratch(t.spark)
    plain = t.loan.select("loan_id", day(F.trunc("snapshot_date", "MM")).alias("snapshot_date"))
    plain.write.option("header", True).csv(f"{root}/source")
    for _ in range(2):
        run = catchup.ingest_new_files(
            t.spark, f"{root}/source", ["loan_id", "snapshot_date"], f"{root}/bronze", f"{root}/progress"
        )
        run.awaitTermination()
    back = t.spark.read.parquet(f"{root}/bronze")
    return with_day(back.groupBy("snapshot_date").agg(F.count(F.lit(1)).alias("n")))


@query(
    """SELECT 'customers' AS source, 'within_Annual_Income' AS rule, CAST(d AS VARCHAR) AS snapshot_date, count(*) AS n
        FROM (SELECT DATE '2024-01-01' + (n_regionkey::INTEGER) AS d FROM v_cust
            WHERE NOT (c_custkey % 7 = 0 OR c_custkey % 11 = 0) AND balance < 1000) GROUP BY d""",
    "v_cust",
)
def append_quarantine(t):
    """The same run twice leaves one copy of the rejected rows."""
    root = scratch(t.spark)
    raw = spread(t.cust).select(
        "Customer_ID",
        F.col("balance").cast("string").alias("Annual_Income"),
        day(F.date_add(F.lit("2024-01-01").cast("date"), F.col("n_regionkey"))).alias("snapshot_date"),
    )
    routed = silver.process(raw, specs.FINANCIALS, AS_OF)
    for _ in range(2):
        silver.write(routed, f"{root}/silver", specs.FINANCIALS)
    aside = silver.read_quarantine(t.spark, f"{root}/silver")
    for _ in range(2):
        snapshots.write_quarantine(aside, f"{root}/quarantine", "customers")
    back = t.spark.read.parquet(f"{root}/quarantine")
    return with_day(back.groupBy("source", "rule", "snapshot_date").agg(F.count(F.lit(1)).alias("n")))


@query(
    """SELECT model_id, CAST(snapshot_date AS VARCHAR) AS snapshot_date, total_samples, round(accuracy, 6) AS accuracy,
        roc_auc IS NULL AS no_auc FROM v_metrics""",
    "v_metrics",
)
def metric_documents(t):
    """Metrics to JSON documents and back to a table."""
    root = scratch(t.spark) + "/metrics"
    documents.write_documents(with_day(t.metrics), root)
    back = documents.read_metric_documents(t.spark, root, multi_line=False)
    rows = with_day(back).withColumn("no_auc", F.col("roc_auc").isNull())
    return rows.select(
        "model_id", "snapshot_date", "total_samples", F.round("accuracy", 6).alias("accuracy"), "no_auc"
    ).where(back["source_file"].isNotNull())


@query(
    """SELECT column_name, is_present, is_expected, n_filled, n_rows FROM (
        SELECT 'c_custkey' AS column_name, true AS is_present, true AS is_expected, count(c_custkey) AS n_filled, count(*) AS n_rows FROM v_cust
        UNION ALL SELECT 'balance', true, false, count(balance), count(*) FROM v_cust
        UNION ALL SELECT 'Customer_ID', true, false, count(Customer_ID), count(*) FROM v_cust
        UNION ALL SELECT 'mob', false, true, NULL, count(*) FROM v_cust)""",
    "v_cust",
)
def inspect_table(t):
    rows = t.cust.select("c_custkey", "balance", "Customer_ID")
    return snapshots.inspect_table(rows, ["c_custkey", "mob"]).drop("data_type")


@query(
    """SELECT 'loans' AS table_name, count(*) > 0 AS has_files FROM v_loan
        UNION ALL SELECT 'customers.parquet', count(*) > 0 FROM v_cust""",
    "v_loan v_cust",
)
def list_tables(t):
    """A partitioned and a plain table below one folder; file sizes are not a matter of SQL."""
    root = scratch(t.spark)
    snapshots.write_snapshots(by_month(t), f"{root}/loans")
    t.cust.write.parquet(f"{root}/customers.parquet")
    found = snapshots.list_tables(t.spark, root)
    return found.select("table_name", ((F.col("n_files") > 0) & (F.col("n_bytes") > 0)).alias("has_files"))


@query(
    """SELECT CAST(d AS VARCHAR) AS snapshot_date, count(*) FILTER (mob = 6) AS n_labels,
        count(*) FILTER (mob = 6 AND overdue_amt > 0 AND missed > 0 AND date_diff('day', CAST(d - to_months(missed) AS DATE), d) >= 30) AS n_default,
        count(*) FILTER (mob = 0) AS n_features
        FROM (SELECT CAST(date_trunc('month', snapshot_date) + to_months(300) AS DATE) AS d, installment_num AS mob, overdue_amt,
            CASE WHEN due_amt > 0 THEN CAST(ceil(CAST(overdue_amt AS DOUBLE) / CAST(due_amt AS DOUBLE)) AS INTEGER) ELSE 0 END AS missed
            FROM v_loan)
        WHERE d <= DATE '2026-03-31' GROUP BY d HAVING count(*) FILTER (mob IN (0, 6)) > 0""",
    "v_loan",
)
def data_build(t):
    """CSV source to bronze, silver, label store and feature store, counted per month."""
    root = scratch(t.spark)
    month = F.add_months(F.trunc("snapshot_date", "MM"), SHIFT)
    text = [F.col(c).cast("string").alias(c) for c in ("installment_num", "due_amt", "overdue_amt")]
    raw = t.loan.select("loan_id", "Customer_ID", *text, day(month).alias("snapshot_date"))
    raw.write.option("header", True).csv(f"{root}/loans")
    layout = build.run(t.spark, {"loan_daily": f"{root}/loans"}, f"{root}/lake", AS_OF)
    outcome = t.spark.read.parquet(layout.gold("label_store")).select("snapshot_date", "label")
    rows = t.spark.read.parquet(layout.gold("feature_store")).select("snapshot_date", F.lit(None).cast("int").alias("label"))
    counts = outcome.unionByName(rows).groupBy("snapshot_date").agg(
        F.count("label").alias("n_labels"),
        F.count_if(F.col("label") == 1).alias("n_default"),
        F.count_if(F.col("label").isNull()).alias("n_features"),
    )
    return with_day(counts)


@query("SELECT c_custkey, Customer_ID, CAST(NULL AS INTEGER) AS score FROM v_cust WHERE c_custkey IS NOT NULL", "v_cust")
def optional_source(t):
    """An absent side table leaves its column null."""
    scores = snapshots.read_optional(t.spark, f"{t.sf_dir}/no_such_table.parquet")
    rows = t.cust.select("c_custkey", "Customer_ID")
    if scores is not None:
        return rows.join(scores, "c_custkey", "left")
    return rows.withColumn("score", F.lit(None).cast("int"))


@query(
    """SELECT model_id, CAST(snapshot_date AS VARCHAR) AS snapshot_date, CAST(CAST(snapshot_date - to_months(6) AS DATE) AS VARCHAR) AS prediction_snapshot_date,
            count(*) AS total_samples, sum(label)::BIGINT AS actual_positives, round(avg(prediction_proba), 6) AS mean_prediction_proba
        FROM (SELECT p.model_id, CAST(p.snapshot_date + to_months(6) AS DATE) AS snapshot_date, l.label, p.prediction_proba
            FROM v_month p JOIN v_month l ON l.model_id = 'model_1' AND l.loan_id = p.loan_id AND l.Customer_ID = p.Customer_ID AND l.snapshot_date = p.snapshot_date)
        GROUP BY ALL""",
    "v_month",
)
def monitor_run(t):
    """Scores with the outcome of six months later, to metrics, written and read back."""
    root = scratch(t.spark) + "/monitoring"
    predictions = t.month.drop("label").withColumnRenamed("snapshot_date", "inference_date")
    outcome = t.month.where("model_id = 'model_1'").select(
        "loan_id", "Customer_ID", "label", F.add_months("snapshot_date", 6).alias("snapshot_date")
    )
    monitoring.write_metrics(monitoring.monitor(predictions, outcome), root)
    back = t.spark.read.parquet(f"{root}/parquet")
    rows = back.withColumn("mean_prediction_proba", F.round("mean_prediction_proba", 6))
    return with_day(rows.withColumn("prediction_snapshot_date", day("prediction_snapshot_date"))).select(
        "model_id", "snapshot_date", "prediction_snapshot_date", "total_samples", "actual_positives", "mean_prediction_proba"
    )


@query(
    """SELECT CASE WHEN balance > 0 THEN 'keep' ELSE 'quarantine' END AS route, count(*) AS n FROM
        (SELECT coalesce(balance, -1) AS balance FROM v_cust) GROUP BY 1""",
    "v_cust",
)
def quarantine_null_flags(t):
    """The option that keeps rows with a null flag on the quarantine side."""
    rule = rules.Rule("balance", lambda c: c > 0, "valid_balance", Strategy.QUARANTINE)
    routed = rules.route_rows(t.cust, [rule], null_flag="quarantine")
    return rules.route_counts(routed).drop("rule")


@query(
    """SELECT route, count(*) AS n, sum(c_custkey)::BIGINT AS keys FROM (SELECT c_custkey,
            CASE WHEN c_custkey % 7 = 0 OR c_custkey % 11 = 0 THEN 'drop' WHEN c_custkey % 3 = 0 THEN 'gone'
                WHEN balance < 1000 AND c_custkey % 2 = 0 THEN 'keep' WHEN balance < 1000 THEN 'quarantine' ELSE 'keep' END AS route
        FROM v_cust) WHERE route IN ('keep', 'quarantine') GROUP BY route""",
    "v_cust",
)
def silver_rerun(t):
    """A corrected source over the first one: rows that changed sides or are gone leave nothing behind."""
    root = scratch(t.spark) + "/silver"
    month = F.add_months(F.lit("2024-01-01").cast("date"), (F.col("c_custkey") % 12).cast("int"))
    income = F.col("balance").cast("string")

    def written(rows, amount):
        raw = rows.select("c_custkey", "Customer_ID", amount.alias("Annual_Income"), day(month).alias("snapshot_date"))
        silver.write(silver.process(raw, specs.FINANCIALS, AS_OF), root, specs.FINANCIALS)

    customers = spread(t.cust.select("c_custkey", "Customer_ID", "balance"))
    written(customers, income)
    mended = F.when((F.col("balance") < 1000) & (F.col("c_custkey") % 2 == 0), F.lit("5000")).otherwise(income)
    written(customers.where("c_custkey % 3 <> 0"), mended)
    sides = {"keep": silver.read_kept(t.spark, root), "quarantine": silver.read_quarantine(t.spark, root)}
    rows = [df.select("c_custkey", F.lit(route).alias("route")) for route, df in sides.items()]
    return rows[0].unionByName(rows[1]).groupBy("route").agg(F.count(F.lit(1)).alias("n"), F.sum("c_custkey").alias("keys"))


@query(
    """SELECT p_partkey, loan_types LIKE '%green Loan%' AS a, p_partkey % 2 = 1 AND loan_types LIKE '%blue Loan%' AS b FROM (
        SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'green Loan' WHEN 1 THEN 'blue Loan, and green Loan' ELSE '' END AS loan_types FROM part)"""
)
def silver_new_tokens(t):
    """The second month knows one token more than the first; both are read with all columns."""
    root = scratch(t.spark) + "/silver"
    kinds = F.when(F.col("p_partkey") % 3 == 0, "green Loan").when(F.col("p_partkey") % 3 == 1, "blue Loan, and green Loan").otherwise("")
    rows = t.table("part").select("p_partkey", _id().alias("Customer_ID"), F.lit("50000").alias("Annual_Income"), kinds.alias("Type_of_Loan"))
    for parity, snapshot, words in ((0, "2024-01-01", ["green Loan"]), (1, "2024-02-01", ["blue Loan", "green Loan"])):
        raw = rows.where(F.col("p_partkey") % 2 == parity).withColumn("snapshot_date", F.lit(snapshot))
        silver.write(silver.process(raw, specs.FINANCIALS, AS_OF, words), root, specs.FINANCIALS, snapshot=snapshot)
    back = silver.read_kept(t.spark, root)
    return back.select("p_partkey", (F.col("has_green_loan") == 1).alias("a"), (F.col("has_blue_loan") == 1).alias("b"))


@query(
    """SELECT p_partkey, (p_partkey % 3 < 2)::INT AS has_green_loan, (p_partkey % 3 = 1)::INT AS has_blue_loan, (p_partkey % 6 = 5)::INT AS has_red_loan FROM part"""
)
def silver_vocabulary(t):
    """Each month brings its own tokens; columns come from the data, and an earlier month has 0 for a later token."""
    root = scratch(t.spark)
    key = F.col("p_partkey")
    kinds = F.when(key % 3 == 0, "green Loan").when(key % 3 == 1, "blue Loan, and green Loan").when(key % 6 == 5, "red Loan").otherwise("")
    rows = t.table("part").select("p_partkey", _id().alias("Customer_ID"), F.lit("50000").alias("Annual_Income"), kinds.alias("Type_of_Loan"))
    for rest, snapshot in (([0, 2], "2024-01-01"), ([1, 3, 4, 5], "2024-02-01")):
        raw = rows.where((key % 6).isin(rest)).withColumn("snapshot_date", F.lit(snapshot))
        words = silver.grown_vocabulary(raw, specs.FINANCIALS, f"{root}/vocabulary")
        silver.write(silver.process(raw, specs.FINANCIALS, AS_OF, words), f"{root}/silver", specs.FINANCIALS, snapshot=snapshot)
    return silver.read_kept(t.spark, f"{root}/silver").select("p_partkey", "has_green_loan", "has_blue_loan", "has_red_loan")


def _id():
    return F.concat(F.lit("CUS_0x"), F.hex("p_partkey"))


@query(
    """SELECT CAST(d AS VARCHAR) AS snapshot_date, count(*) FILTER (mob = 6) AS n_labels,
        count(*) FILTER (mob = 6 AND d = DATE '2023-06-01') AS n_default
        FROM (SELECT CAST(date_trunc('month', snapshot_date) + to_months(300) AS DATE) AS d, installment_num AS mob FROM v_loan)
        WHERE mob = 6 AND d <= DATE '2026-03-31' GROUP BY d""",
    "v_loan",
)
def build_one_snapshot(t):
    """After a whole build one month is built again, from a source in which every loan is in default."""
    root = scratch(t.spark)
    month = F.add_months(F.trunc("snapshot_date", "MM"), SHIFT)

    def source(overdue, name):
        raw = t.loan.select("loan_id", "Customer_ID", F.col("installment_num").cast("string"), F.lit("100").alias("due_amt"), F.lit(overdue).alias("overdue_amt"), day(month).alias("snapshot_date"))
        raw.write.option("header", True).csv(f"{root}/{name}")
        return {"loan_daily": f"{root}/{name}"}

    build.run(t.spark, source("0", "first"), f"{root}/lake", AS_OF)
    layout = build.run(t.spark, source("500", "second"), f"{root}/lake", AS_OF, snapshot="2023-06-01")
    labels = t.spark.read.parquet(layout.gold("label_store"))
    counts = labels.groupBy("snapshot_date").agg(F.count("label").alias("n_labels"), F.count_if(F.col("label") == 1).alias("n_default"))
    return with_day(counts)


@query(
    """SELECT CAST(CAST(date_trunc('month', snapshot_date) AS DATE) AS VARCHAR) AS snapshot_date, count(*) AS n, round(sum(due_amt::DOUBLE), 1) AS due
        FROM v_loan GROUP BY 1""",
    "v_loan",
)
def csv_snapshots(t):
    """Snapshots as partitioned CSV and back."""
    root = scratch(t.spark) + "/csv"
    snapshots.write_csv_snapshots(by_month(t).select(F.col("due_amt").cast("double"), "snapshot_date"), root)
    back = t.spark.read.option("header", True).csv(root)
    counts = back.groupBy(F.col("snapshot_date").cast("date").alias("snapshot_date")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(F.col("due_amt").cast("double")), 1).alias("due"))
    return with_day(counts)


@query(
    """SELECT 'threshold' AS document, metric AS item, business_threshold::VARCHAR AS value FROM v_limits WHERE business_threshold IS NOT NULL
        UNION ALL SELECT 'baseline', model_id, round(max(roc_auc), 3)::VARCHAR FROM v_metrics GROUP BY model_id
        UNION ALL SELECT 'window', split, strftime(start_date, '%Y-%m-%d') FROM v_windows""",
    "v_limits v_metrics v_windows",
)
def configuration_documents(t):
    """Thresholds, baselines and windows written as configuration documents and read from there."""
    root = scratch(t.spark)
    limits = config.default_thresholds(t.spark)
    compared = F.struct(F.col("baseline_enabled").alias("enabled"), "reference", "max_degradation_percent")
    entry = F.struct("priority", "name", "business_threshold", "data_science_threshold", compared.alias("baseline_comparison"))
    best = t.metrics.groupBy("model_id").agg(F.round(F.max("roc_auc"), 3).alias("oot_roc_auc"))
    pairs = lambda df, key, value: df.agg(F.map_from_entries(F.collect_list(F.struct(key, value))).alias("m")).scalar()
    windows = t.spark.createDataFrame([(w["split"], w["start_date"], w["end_date"]) for w in WINDOWS], "split string, start_date string, end_date string")
    one = t.spark.range(1).select(
        pairs(limits, F.col("metric"), entry).alias("metrics"),
        pairs(best, F.col("model_id"), F.struct("oot_roc_auc")).alias("historical_baselines"),
        pairs(windows, F.col("split"), F.struct("start_date", "end_date")).alias("temporal_splits"),
    )
    one.coalesce(1).write.json(f"{root}/config")
    text = lambda c: F.col(c).cast("string")
    parts = [
        config.read_thresholds(t.spark, f"{root}/config").where("business_threshold is not null").select(F.lit("threshold").alias("document"), F.col("metric").alias("item"), text("business_threshold").alias("value")),
        config.read_historical_baselines(t.spark, f"{root}/config").select(F.lit("baseline").alias("document"), F.col("model_id").alias("item"), text("oot_roc_auc").alias("value")),
        config.read_windows(t.spark, f"{root}/config").select(F.lit("window").alias("document"), F.col("split").alias("item"), day("start_date").alias("value")),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    """SELECT 'model_1' AS model_id, CAST(s AS VARCHAR) AS snapshot_date, CAST(min(d) AS VARCHAR) AS prediction_snapshot_date, count(*) AS total_samples
        FROM (SELECT *, CAST(d + to_months(6) AS DATE) AS s FROM (SELECT DISTINCT loan_id, CAST(loan_start_date AS DATE) AS d FROM v_loan)
            QUALIFY d = min(d) OVER (PARTITION BY s)) GROUP BY s""",
    "v_loan",
)
def monitor_fallback(t):
    """Outcomes dated six months after the loan's start date, scores dated that very day: the ids tell which scores to take."""
    first = t.loan.select("loan_id", "Customer_ID", F.col("loan_start_date").alias("inference_date")).distinct()
    scores = first.select("*", F.lit(0.4).alias("prediction_proba"), F.lit(0).alias("prediction_label"), F.lit("model_1").alias("model_id"), F.lit("logistic_regression").alias("model_type"))
    outcome = first.select("loan_id", "Customer_ID", F.lit(0).alias("label"), F.add_months("inference_date", 6).alias("snapshot_date"))
    rows = monitoring.monitor(scores, outcome, align="fallback")
    return with_day(rows.withColumn("prediction_snapshot_date", day("prediction_snapshot_date"))).select("model_id", "snapshot_date", "prediction_snapshot_date", "total_samples")
