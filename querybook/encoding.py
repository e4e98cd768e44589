"""Category features, token lists, windows and month sequences."""

from pyspark.sql import functions as F

from querybook.base import WINDOWS, day, query
from tenorlake.functions import dates, encode, text
from tenorlake.operators import joins, schema
from tenorlake.plans import gold, silver, specs


@query(
    """SELECT c_custkey, CASE WHEN trim(segment) = 'building' THEN 1 ELSE 0 END AS is_building,
        CASE WHEN trim(segment) = 'furniture' THEN 1 ELSE 0 END AS is_furniture FROM v_cust""",
    "v_cust",
)
def onehot(t):
    made = encode.one_hot(F.trim("segment"), {"is_building": "building", "is_furniture": "furniture"})
    return t.cust.withColumns(made).select("c_custkey", *made)


@query(
    """SELECT c_custkey, CASE WHEN upper(trim(segment)) IN ('BUILDING', 'HOUSEHOLD') THEN 1 ELSE 0 END AS is_member
        FROM v_cust""",
    "v_cust",
)
def membership(t):
    value = text.standardise(F.col("segment"))
    return t.cust.select("c_custkey", encode.membership(value, ["BUILDING", "HOUSEHOLD"]).alias("is_member"))


@query(
    """SELECT Customer_ID, CAST(snapshot_date AS VARCHAR) AS snapshot_date, o_totalprice,
        CASE WHEN contains(o_orderpriority, 'HIGH') THEN 1 ELSE 0 END AS spending_level,
        CASE WHEN contains(o_orderpriority, 'URGENT') THEN 2 WHEN contains(o_orderpriority, 'MEDIUM') THEN 1 ELSE 0 END AS value_size
        FROM v_dim""",
    "v_dim",
)
def contains_features(t):
    value = F.col("o_orderpriority")
    return t.dim.select(
        "Customer_ID",
        day("snapshot_date").alias("snapshot_date"),
        "o_totalprice",
        text.contains_level(value, {"HIGH": 1}).alias("spending_level"),
        text.contains_level(value, {"URGENT": 2, "MEDIUM": 1}).alias("value_size"),
    )


@query(
    """SELECT c_custkey, CASE WHEN segment = 'machinery' THEN 1 ELSE 0 END AS "is_PMET",
        CASE WHEN c_custkey % 3 = 0 THEN 1 ELSE 0 END AS payment_min_yes, CASE WHEN c_custkey % 3 = 2 THEN 1 ELSE 0 END AS payment_min_nm,
        0 AS credit_mix_good, CASE WHEN segment = 'building' THEN 1 ELSE 0 END AS credit_mix_standard, 0 AS credit_mix_bad,
        CASE WHEN c_custkey % 2 = 0 THEN 1 ELSE 0 END AS spending_level, 1 AS value_size
        FROM (SELECT c_custkey, trim(segment) AS segment FROM v_cust)""",
    "v_cust",
)
def dimension_features(t):
    """Category encoding of a customer table with the raw columns gone."""
    minimum = F.element_at(F.array(*map(F.lit, ("YES", "NO", "NM"))), (F.col("c_custkey") % 3 + 1).cast("int"))
    half = F.when(F.col("c_custkey") % 2 == 0, "HIGH").otherwise("LOW")
    raw = t.cust.select(
        "c_custkey",
        F.when(F.trim("segment") == "machinery", "ENGINEER").otherwise("CLERK").alias("Occupation"),
        minimum.alias("Payment_of_Min_Amount"),
        F.when(F.trim("segment") == "building", "STANDARD").alias("Credit_Mix"),
        F.concat(half, F.lit("_SPENT_MEDIUM_VALUE_PAYMENTS")).alias("Payment_Behaviour"),
        F.lit("x").alias("SSN"),
    )
    return gold.dimension(raw).drop("Payment_Behaviour")


@query(
    """SELECT DISTINCT trim(token) AS token
        FROM (SELECT unnest(string_split(replace(loan_types, ' and ', ','), ',')) AS token FROM v_part)
        WHERE contains(token, 'Loan')""",
    "v_part",
)
def split_tokens(t):
    return schema.token_vocabulary(t.part, "loan_types", "Loan")


@query(
    r"""SELECT p_partkey, has_any_loan, CAST(has_red AS INTEGER) AS has_red_loan, CAST(has_eq AS INTEGER) AS has_ring_equity_loan
        FROM (SELECT p_partkey, CASE WHEN loan_types NOT IN ('', 'Not Specified') THEN 1 ELSE 0 END AS has_any_loan,
            regexp_matches(loan_types, '\bred Loan\b') AS has_red, regexp_matches(loan_types, '\bring-Equity Loan\b') AS has_eq FROM v_part)""",
    "v_part",
)
def multi_hot(t):
    rows = t.part.withColumn("Type_of_Loan", text.sentinel_to_null(F.col("loan_types"), ""))
    flagged = schema.with_token_flags(rows, "Type_of_Loan", ["red Loan", "ring-Equity Loan"])
    return flagged.select("p_partkey", "has_any_loan", "has_red_loan", "has_ring_equity_loan")


@query(
    r"""SELECT token, count(*) AS n_parts FROM (
        SELECT DISTINCT p_partkey, trim(unnest(string_split(replace(loan_types, ' and ', ','), ','))) AS token FROM v_part)
        WHERE contains(token, 'Loan') GROUP BY token""",
    "v_part",
)
def token_rows(t):
    """Token counts from the long form, which needs no vocabulary."""
    rows = schema.token_flag_rows(t.part, "p_partkey", "loan_types", "Loan")
    return rows.groupBy("token").agg(F.count(F.lit(1)).alias("n_parts"))


@query(
    r"""SELECT token, sum(CASE WHEN regexp_matches(v_part.loan_types, '\b' || token || '\b') THEN 1 ELSE 0 END)::BIGINT AS n_parts
        FROM v_part, (SELECT DISTINCT trim(token) AS token
            FROM (SELECT unnest(string_split(replace(loan_types, ' and ', ','), ',')) AS token FROM v_part)
            WHERE contains(token, 'Loan')) GROUP BY token""",
    "v_part",
)
def multi_hot_all(t):
    """Data-dependent columns: the vocabulary is read once, then every token gets a column."""
    part = t.part.withColumn("Type_of_Loan", text.sentinel_to_null(F.col("loan_types"), ""))
    words = silver.vocabulary(part, specs.FINANCIALS)
    flagged = schema.with_token_flags(part, "Type_of_Loan", words)
    totals = flagged.agg(*[F.sum(text.token_column(w)).alias(text.token_column(w)) for w in words])
    pairs = [F.struct(F.lit(w).alias("token"), F.col(text.token_column(w)).alias("n_parts")) for w in words]
    return totals.select(F.inline(F.array(*pairs)))


@query(
    """WITH m AS (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS s FROM orders)
        SELECT CAST(s AS VARCHAR) AS snapshot_date, split, CAST(CAST(s - to_months(a) AS DATE) AS VARCHAR) AS start_date,
            CAST(CAST(s - to_months(b) AS DATE) AS VARCHAR) AS end_date
        FROM m, (VALUES ('train', 17, 6), ('validation', 5, 3), ('test', 2, 1), ('oot', 0, 0)) AS w(split, a, b)"""
)
def relative_windows(t):
    months = t.table("orders").select(F.trunc("o_orderdate", "MM").alias("snapshot_date")).distinct()
    rows = months.select("snapshot_date", F.inline(dates.backward_windows(F.col("snapshot_date"))))
    return rows.select("split", *[day(c).alias(c) for c in ("snapshot_date", "start_date", "end_date")])


@query(
    """WITH c AS (SELECT o_custkey, CAST(date_trunc('month', max(o_orderdate)) AS DATE) AS m FROM orders GROUP BY o_custkey)
        SELECT o_custkey, CAST(CAST(m - to_months(k::INTEGER) AS DATE) AS VARCHAR) AS month
        FROM c, (SELECT unnest(range(8)) AS k)"""
)
def month_sequence(t):
    last = t.table("orders").groupBy("o_custkey").agg(F.max("o_orderdate").cast("date").alias("d"))
    return last.select("o_custkey", F.explode(dates.month_starts(F.col("d"), 8)).alias("m")).select(
        "o_custkey", day("m").alias("month")
    )


@query(
    """SELECT loan_id, due_amt, '30dpd_6mob' AS label_def, 'model_1' AS model_id, length(loan_id) AS id_length FROM v_loan""",
    "v_loan",
)
def projections(t):
    """Wanted, unwanted and metadata columns; names that are not there are no error."""
    rows = schema.drop_columns(t.loan, ["Customer_ID", "loan_amt", "overdue_amt", "no_such_column"])
    rows = schema.keep_columns(rows, ["loan_id", "due_amt", "absent"])
    made = {"label_def": encode.label_definition(30, 6), "model_id": "model_1", "id_length": F.length("loan_id").cast("bigint")}
    return schema.with_literals(rows, made)


@query(
    """SELECT split, CAST(snapshot_date AS VARCHAR) AS snapshot_date, count(*) AS n
        FROM v_loan JOIN v_windows ON snapshot_date BETWEEN start_date AND end_date GROUP BY ALL""",
    "v_loan v_windows",
)
def split_windows(t):
    rows = joins.assign_splits(t.loan, "snapshot_date", WINDOWS)
    counts = rows.groupBy("split", "snapshot_date").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("snapshot_date", day("snapshot_date"))


@query(
    """WITH w AS (SELECT c_custkey AS split, DATE '1995-01-01' + (c_custkey * 37 % 2500)::INT AS start_date, DATE '1995-01-01' + (c_custkey * 37 % 2500 + c_custkey % 90)::INT AS end_date FROM customer)
        SELECT split, count(*) AS n FROM v_loan JOIN w ON snapshot_date BETWEEN start_date AND end_date GROUP BY split""",
    "v_loan",
)
def split_windows_table(t):
    """As many overlapping windows as there are customers, from a table."""
    begin = (F.col("c_custkey") * 37 % 2500).cast("int")
    first = F.lit("1995-01-01").cast("date")
    windows = t.table("customer").select(
        F.col("c_custkey").alias("split"), F.date_add(first, begin).alias("start_date"), F.date_add(first, begin + (F.col("c_custkey") % 90).cast("int")).alias("end_date")
    )
    days = t.loan.groupBy("snapshot_date").agg(F.count(F.lit(1)).alias("n"))
    return joins.assign_split_table(days, "snapshot_date", windows).groupBy("split").agg(F.sum("n").alias("n"))
