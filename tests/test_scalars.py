import datetime as dt

from pyspark.sql import functions as F

from tenorlake.functions import dates, encode, numeric, text
from tenorlake.operators import schema


def d(day):
    return dt.date.fromisoformat(day)


def column(spark, values, kind, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}").repartition(1)
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


def test_numbers_from_text(spark):
    raw = ["1,234", "$ 5_0", "12.7", "5.0", "-3.9", "abc", "", None, "1.0E3", "99999999999"]
    df = spark.createDataFrame([(i, v, v) for i, v in enumerate(raw)], "i int, a string, b string")
    rows = schema.apply_schema(df, {"a": "int", "b": "float", "c": "int"}).orderBy("i").collect()
    assert [r.a for r in rows] == [1234, 50, 12, 5, -3, None, None, None, None, None]
    assert [r.b for r in rows][:3] == [1234.0, 50.0, 12.699999809265137]
    assert [r.a_original for r in rows] == raw


def test_unknown_type_is_an_error(spark):
    import pytest

    with pytest.raises(ValueError):
        schema.apply_schema(spark.range(1), {"id": "decimal"})


def test_dates_from_text(spark):
    raw = ["1/5/23", "2023-01-01", "31/12/23", "2023-1-5", "1/5/2023", "junk", None]
    want = [d("2023-05-01"), d("2023-01-01"), d("2023-12-31"), d("2023-01-05"), None, None, None]
    assert column(spark, raw, "string", dates.parse_date(F.col("x"))) == want


def test_instalments_and_days_past_due(spark):
    rows = [
        (0, 0.0, 100.0, "2023-03-01"), (1, 100.0, 100.0, "2023-03-01"), (2, 101.0, 100.0, "2023-03-31"),
        (3, 50.0, 0.0, "2023-03-01"), (4, None, 100.0, "2023-03-01"), (5, 90.0, 100.0, "2023-03-31"),
    ]
    df = spark.createDataFrame(rows, "i int, overdue float, due float, s string")
    missed = numeric.instalments_missed(F.col("overdue"), F.col("due"))
    df = df.withColumn("s", F.col("s").cast("date")).withColumn("missed", missed)
    df = df.withColumn("first", dates.first_missed_date(F.col("s"), F.col("missed")))
    df = df.withColumn("dpd", dates.days_past_due(F.col("s"), F.col("first"), F.col("overdue")))
    out = df.withColumn("label", encode.threshold_label(F.col("dpd"), 30)).orderBy("i").collect()
    assert [r.missed for r in out] == [0, 1, 2, 0, 0, 1]
    assert [r.first for r in out] == [None, d("2023-02-01"), d("2023-01-31"), None, None, d("2023-02-28")]
    assert [r.dpd for r in out] == [0, 28, 59, 0, 0, 31]
    assert [r.label for r in out] == [0, 0, 1, 0, 0, 1]


def test_threshold_label(spark):
    assert column(spark, [28, 30, 31, None], "int", encode.threshold_label(F.col("x"), 30)) == [0, 1, 1, 0]


def test_cap_age(spark):
    assert column(spark, [-1, 17, 151, None], "int", numeric.cap_age(F.col("x"))) == [18, 17, 65, None]


def test_duration(spark):
    raw = ["10 Years and 9 Months", "1 Year", "5 Months", "NA", None]
    assert column(spark, raw, "string", text.duration_months(F.col("x"))) == [129, 12, 5, 0, None]


def test_tokens_and_flags(spark):
    raw = ["Auto Loan, and Payday Loan", "Not Specified", "Auto Loan, Auto Loan", None, "Home Equity Loan"]
    found = column(spark, raw, "string", text.tokens(F.col("x"), "Loan"))
    assert [sorted(f) if f is not None else None for f in found] == [
        ["Auto Loan", "Payday Loan"], [], ["Auto Loan"], None, ["Home Equity Loan"],
    ]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(raw)], "i int, x string")
    flags = schema.with_token_flags(df, "x", ["Home Equity Loan", "Auto Loan"]).orderBy("i").collect()
    assert [r.has_auto_loan for r in flags] == [1, 0, 1, 0, 0]
    assert [r.has_home_equity_loan for r in flags] == [0, 0, 0, 0, 1]
    assert [r.has_any_loan for r in flags] == [1, 0, 1, 0, 1]
    assert schema.with_token_flags(df, "x", ["A+B (x)"]).select("has_a+b_(x)").count() == 5


def test_null_aware_sum_and_ratio(spark):
    df = spark.createDataFrame([(1, None, 2), (None, None, None)], "a int, b int, c int")
    total = numeric.null_aware_sum(*map(F.col, "abc"))
    assert [r[0] for r in df.select(total).collect()] == [3, None]
    df = spark.createDataFrame([(10.0, 0.0), (10.0, None), (10.0, 4.0)], "a double, b double")
    assert [r[0] for r in df.select(numeric.guarded_ratio(F.col("a"), F.col("b"))).collect()] == [None, None, 2.5]


def test_id_suffix_and_levels(spark):
    assert column(spark, ["CUS_0x1_2023_01_02", "CUS_0x1", None], "string", text.id_date_suffix(F.col("x"))) == [
        "2023_01_02", "", None,
    ]
    level = text.contains_level(F.col("x"), {"LARGE": 2, "MEDIUM": 1})
    assert column(spark, ["A_LARGE", "MEDIUM_B", "SMALL", None], "string", level) == [2, 1, 0, 0]


def test_backward_windows(spark):
    df = spark.sql("select date'2024-06-01' as s")
    rows = df.select(F.inline(dates.backward_windows(F.col("s"), 12, 3, 2, 1))).collect()
    assert {r.split: (str(r.start_date), str(r.end_date)) for r in rows} == {
        "train": ("2023-01-01", "2023-12-01"), "validation": ("2024-01-01", "2024-03-01"),
        "test": ("2024-04-01", "2024-05-01"), "oot": ("2024-06-01", "2024-06-01"),
    }
    matured = df.select(F.inline(dates.backward_windows(F.col("s"), maturity_months=6))).where("split = 'oot'").first()
    assert str(matured.end_date) == "2023-12-01"


def test_month_starts(spark):
    import pytest

    df = spark.sql("select date'2024-12-15' as s")
    months = df.select(dates.month_starts(F.col("s"), 8)).first()[0]
    assert [str(m) for m in months] == [f"2024-{m:02d}-01" for m in range(5, 13)]
    with pytest.raises(ValueError):
        dates.month_starts(F.col("s"), 0)


def test_numeric_features(spark):
    df = spark.createDataFrame(
        [("1.5", True, float("nan"), 3), ("x", None, 2.0, None)], "t string, b boolean, n double, i int"
    )
    rows = schema.numeric_features(df, ["t", "b", "n", "i"]).collect()
    assert [tuple(r) for r in rows] == [(1.5, 1.0, None, 3.0), (None, None, 2.0, None)]
