import pytest
from pyspark.sql import functions as F

from tenorlake.functions import numeric, text
from tenorlake.operators import rules, schema
from tenorlake.operators.rules import Rule, Strategy
from tenorlake.plans import silver, specs


@pytest.fixture(scope="module")
def flagged(spark):
    # the rule is true, false and null in turn
    return spark.createDataFrame([(1, 5), (2, -5), (3, None)], "id int, x int").cache()


def outcome(df, strategy, default=None, null_flag="lost"):
    routed = rules.route_rows(df, [Rule("x", lambda c: c > 0, "ok", strategy, default)], null_flag)
    kept = {r.id: r.x for r in rules.kept(routed).collect()}
    return kept, sorted(r.id for r in rules.quarantined(routed).collect())


@pytest.mark.parametrize(
    "strategy, default, kept, aside",
    [
        (Strategy.DROP_ROW, None, {1: 5}, []),
        (Strategy.FLAG_ONLY, None, {1: 5, 2: -5, 3: None}, []),
        (Strategy.NULL_VALUE, None, {1: 5, 2: None, 3: None}, []),
        (Strategy.DEFAULT_VALUE, 0, {1: 5, 2: 0, 3: 0}, []),
        (Strategy.DEFAULT_VALUE, None, {1: 5, 2: -5, 3: None}, []),
        (Strategy.QUARANTINE, None, {1: 5}, [2]),
    ],
)
def test_strategies(flagged, strategy, default, kept, aside):
    assert outcome(flagged, strategy, default) == (kept, aside)


def test_null_flags_can_be_set_aside(flagged):
    assert outcome(flagged, Strategy.QUARANTINE, null_flag="quarantine") == ({1: 5}, [2, 3])


def test_customer_ids(spark):
    df = spark.createDataFrame([("CUS_0x1aF",), ("cus_0x1",), (None,)], "Customer_ID string")
    assert [r.valid_customer_id for r in rules.apply_rules(df, [rules.customer_id()]).collect()] == [True, False, None]


def test_date_range(spark):
    days = [None, "2019-12-31", "2020-01-01", "2024-05-01", "2024-05-02"]
    df = spark.createDataFrame([(d,) for d in days], "d string").withColumn("d", F.col("d").cast("date"))
    out = rules.apply_rules(df, [rules.date_range("d", "2024-05-01")]).collect()
    assert [r.valid_d for r in out] == [False, False, True, True, False]
    assert [str(r.d) for r in out] == ["None", "None", "2020-01-01", "2024-05-01", "None"]


def test_rows_are_conserved_and_the_first_rule_wins(spark):
    df = spark.range(1000).select((F.col("id") % 13 - 6).alias("a"), F.when(F.col("id") % 5 > 0, F.col("id")).alias("b"))
    chain = [
        Rule("a", lambda c: c > -5, "ok_a", Strategy.DROP_ROW),
        rules.extreme_outlier("b", 10, 900),
        Rule("a", lambda c: c < 5, "ok_high", Strategy.QUARANTINE),
        Rule("b", lambda c: c % 2 == 0, "even", Strategy.QUARANTINE),
    ]
    counts = {(r.route, r.rule): r.n for r in rules.route_counts(rules.route_rows(df, chain)).collect()}
    assert sum(counts.values()) == 1000
    want = {}
    for i in range(1000):
        a, b = i % 13 - 6, i if i % 5 else None
        if not a > -5:
            key = ("drop", "ok_a")
        elif b is not None and not 10 <= b <= 900:
            key = ("quarantine", "within_b")
        elif not a < 5:
            key = ("quarantine", "ok_high")
        elif b is None:
            key = ("lost", "even")
        else:
            key = ("keep", None) if b % 2 == 0 else ("quarantine", "even")
        want[key] = want.get(key, 0) + 1
    assert counts == want


def test_financials_edges(spark):
    raw = spark.createDataFrame(
        [
            ("CUS_0x1", "$50,000", "4000", "2", "3_", "4", "Auto Loan, and Payday Loan", "10 Years and 9 Months", "100", "Good", "NM"),
            ("CUS_0x2", "500", "4000", "2", "3", "4", "", "NA", None, "_", "Yes"),
            ("CUS_0x3", None, "50", None, None, None, None, None, "-1", None, None),
            ("bad", "50000", "4000", "2", "3", "4", "Not Specified", "1 Year", "1", "Bad", "No"),
        ],
        "Customer_ID string, Annual_Income string, Monthly_Inhand_Salary string, Num_Bank_Accounts string, Num_Credit_Card string,"
        "Num_of_Loan string, Type_of_Loan string, Credit_History_Age string, Total_EMI_per_month string, Credit_Mix string,"
        "Payment_of_Min_Amount string",
    ).withColumn("snapshot_date", F.lit("1/5/23"))
    words = silver.vocabulary(raw, specs.FINANCIALS)
    assert words == ["Auto Loan", "Payday Loan"]
    routed = silver.process(raw, specs.FINANCIALS, "2024-12-31", words)
    rows = {r.Customer_ID: r for r in routed.collect()}
    assert {k: r[rules.ROUTE] for k, r in rows.items()} == {
        "CUS_0x1": None, "CUS_0x2": "quarantine", "CUS_0x3": "quarantine", "bad": "drop",
    }
    assert rows["CUS_0x2"][rules.ROUTE_RULE] == "within_Annual_Income"
    one = rows["CUS_0x1"]
    assert (one.Num_Fin_Pdts, one.Credit_History_Age_Months, one.has_auto_loan, one.has_any_loan) == (9, 129, 1, 1)
    assert one.Loans_per_Credit_Item == pytest.approx(0.8) and one.EMI_to_Salary == pytest.approx(0.025)
    assert (one.Credit_Mix, one.valid_credit_mix, one.valid_payment_of_min_amount) == ("GOOD", True, False)
    assert (rows["CUS_0x2"].Credit_Mix, rows["CUS_0x2"].Type_of_Loan) == (None, None)
    assert (rows["CUS_0x3"].Num_Fin_Pdts, rows["CUS_0x3"].Total_EMI_per_month) == (None, 0.0)


def test_any_number_of_tokens(spark):
    df = spark.range(1200).select(F.format_string("CUS_0x%d", "id").alias("Customer_ID"), F.format_string("T%d Loan, and T7 Loan", "id").alias("Type_of_Loan"))
    rows = silver.process(df, specs.FINANCIALS, "2024-12-31")
    got = {r.Customer_ID: r.Type_of_Loan_tokens for r in rows.collect()}
    assert len(got) == 1200 and got["CUS_0x5"] == ["T5 Loan", "T7 Loan"] and got["CUS_0x7"] == ["T7 Loan"]
    assert len(silver.vocabulary(df, specs.FINANCIALS)) == 1200


def test_unknown_table_spec():
    with pytest.raises(ValueError):
        specs.get("nothing")


def test_casts_and_rules_are_worked_out_once_in_a_silver_write(spark):
    raw = spark.createDataFrame([("CUS_0x1", "50_000", "2024-01-01"), ("CUS_0x2", "5", "2024-01-01"), ("x", "50000", "2024-01-01")], "Customer_ID string, Annual_Income string, snapshot_date string")
    rows = silver.written_rows(silver.process(raw, specs.FINANCIALS, "2024-12-31"), specs.FINANCIALS)
    assert sorted((r.Customer_ID, r.Annual_Income, r.route, r.rule) for r in rows.collect()) == [("CUS_0x1", 50000.0, "keep", None), ("CUS_0x2", 5.0, "quarantine", "within_Annual_Income")]
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Filter" not in plan and plan.count("RLIKE(Annual_Income") == 1


def test_dates_stay_as_they_are_and_plain_digits_are_cast(spark):
    dated = spark.createDataFrame([("2024-01-01",)], "d string").select(F.col("d").cast("date").alias("snapshot_date"))
    plan = schema.apply_schema(dated, {"snapshot_date": "date"})._jdf.queryExecution().executedPlan().toString()
    assert "gettimestamp" not in plan
    odd = ["7", "007", "999999999", "9999999999", "-3", "+3", "1,2", "12.7", "5\n", " 5", "\x005", "5\x00", "٣", "1e3", "_", "", None]
    df = spark.createDataFrame([(o,) for o in odd], "x string")
    got = df.select(numeric.clean_int(F.col("x")).alias("a"), numeric.to_int(F.regexp_replace("x", text.NUMBER_NOISE, "")).alias("b"), text.clean_number(F.col("x")).alias("c"), F.regexp_replace("x", text.NUMBER_NOISE, "").alias("d"))
    assert all(r.a == r.b and r.c == r.d for r in got.collect())
