import pytest
from pyspark.sql import functions as F

from tenorlake.plans import build, gold
from tenorlake.sources import snapshots

MONTHS = [f"2023-{m:02d}-01" for m in range(1, 8)]


@pytest.fixture(scope="module")
def sources(tmp_path_factory):
    folder = tmp_path_factory.mktemp("sources")
    loans = ["loan_id,Customer_ID,loan_start_date,tenure,installment_num,loan_amt,due_amt,paid_amt,overdue_amt,balance,snapshot_date"]
    for i, overdue in ((1, 0), (2, 150)):
        for mob, day in enumerate(MONTHS):
            late = overdue if mob == 6 else 0
            loans.append(f"CUS_0x{i}_2023_01_01,CUS_0x{i},2023-01-01,10,{mob},1000,100.0,0,{late},900_,{day}")
    loans.append("bad_2023_01_01,broken,2023-01-01,10,0,1000,100,0,0,900,2023-01-01")
    clicks = ["Customer_ID,snapshot_date," + ",".join(f"fe_{i}" for i in range(1, 21))]
    clicks += [f"CUS_0x1,{day}," + ",".join(str(v + i) for i in range(20)) for day, v in (("2022-07-04", 100), ("2022-07-05", -5), ("2023-01-01", 10))]
    people = ["Customer_ID,Name,Age,SSN,Occupation,snapshot_date", "CUS_0x1,A,30_,123-45-6789, Engineer,2022-12-01", "CUS_0x2,B,-1,#,Clerk,2023-02-01"]
    money = ["Customer_ID,Annual_Income,Monthly_Inhand_Salary,Type_of_Loan,Credit_Mix,Payment_of_Min_Amount,Payment_Behaviour,snapshot_date"]
    money += ["CUS_0x1,50000,4000,Auto Loan and Home Equity Loan,Good,NM,High_spent_Large_value_payments,1/12/22"]
    money += ["CUS_0x1,60000,4000,Auto Loan,_,Yes,Low_spent_Small_value_payments,2023-01-01", "CUS_0x2,5,4000,Auto Loan,Bad,No,x,2023-01-01"]
    paths = {}
    for name, lines in (("loan_daily", loans), ("clickstream", clicks), ("attributes", people), ("financials", money)):
        (folder / f"{name}.csv").write_text("\n".join(lines) + "\n")
        paths[name] = f"{folder}/{name}.csv"
    return paths


def test_whole_build(spark, sources, tmp_path):
    layout = build.run(spark, sources, str(tmp_path), "2024-12-31", vocabulary=["Auto Loan", "Home Equity Loan"], latest_only=False)
    labels = spark.read.parquet(layout.gold("label_store"))
    assert sorted((r.Customer_ID, r.label, r.label_def, str(r.snapshot_date)) for r in labels.collect()) == [
        ("CUS_0x1", 0, "30dpd_6mob", "2023-07-01"), ("CUS_0x2", 1, "30dpd_6mob", "2023-07-01"),
    ]
    rows = spark.read.parquet(layout.gold("feature_store")).orderBy("Customer_ID", "Annual_Income").collect()
    assert [(r.Customer_ID, r.Annual_Income, r.is_PMET) for r in rows] == [("CUS_0x1", 50000.0, 1), ("CUS_0x1", 60000.0, 1), ("CUS_0x2", None, None)]
    first = rows[0]
    assert (first.credit_mix_good, first.payment_min_nm, first.spending_level, first.value_size) == (1, 1, 1, 2)
    assert (first.has_auto_loan, first.has_home_equity_loan, first.has_any_loan) == (1, 1, 1)
    assert first.Type_of_Loan_tokens == ["Auto Loan", "Home Equity Loan"]
    # the window starts 180 days before 2023-01-01, on 2022-07-05, where the negative value counts as 0
    assert (first.avg_fe_1_last_6m, first.clickstream_snapshot_count, first.feature_snapshot_date) == (5.0, 2, "2023-01-01")
    assert (rows[2].avg_fe_20_last_6m, rows[2].clickstream_snapshot_count) == (None, 0)
    assert not {"Name", "SSN", "Occupation", "Credit_Mix"} & set(first.asDict())


def test_rerun_changes_nothing_and_options_hold(spark, sources, tmp_path):
    layout = build.run(spark, sources, str(tmp_path), "2024-12-31")
    before = sorted(map(str, spark.read.parquet(layout.gold("feature_store")).collect()))
    build.run(spark, sources, str(tmp_path), "2024-12-31")
    assert sorted(map(str, spark.read.parquet(layout.gold("feature_store")).collect())) == before
    build.publish(spark, layout, dpd=90)
    latest = spark.read.parquet(layout.gold("feature_store"))
    assert [(r.Customer_ID, r.Annual_Income) for r in latest.orderBy("Customer_ID").collect()] == [("CUS_0x1", 60000.0), ("CUS_0x2", None)]
    assert spark.read.parquet(layout.gold("label_store")).agg(F.max("label")).first()[0] == 0


def test_loans_are_required(spark, sources, tmp_path):
    layout = build.Layout(str(tmp_path))
    with pytest.raises(FileNotFoundError):
        build.publish(spark, layout)
    build.ingest(spark, {"loan_daily": sources["loan_daily"]}, layout, "2023-01-01")
    build.refine(spark, layout, "2024-12-31")
    build.publish(spark, layout)
    assert spark.read.parquet(layout.gold("feature_store")).count() == 2


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    loans = spark.range(10).selectExpr("cast(id as string) loan_id", "'c' Customer_ID", "cast(id % 7 as int) mob", "1 dpd", "date'2024-01-01' snapshot_date", "'wide' other")
    snapshots.write_snapshots(loans, f"{tmp_path}/t")
    plan = gold.labels(snapshots.read_snapshots(spark, f"{tmp_path}/t", on="2024-01-01"))._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(mob,6)" in plan and "other" not in plan
