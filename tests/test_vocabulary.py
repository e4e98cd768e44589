"""Columns of their own for tokens found in the data."""

from tenorlake.plans import build, silver, specs


def money(spark, *kinds):
    return spark.createDataFrame([("CUS_0x1", "50000", k, "2024-01-01") for k in kinds], "Customer_ID string, Annual_Income string, Type_of_Loan string, snapshot_date string")


def test_positions_stay_and_width_holds(spark, tmp_path):
    grown = lambda *kinds, width=3: silver.grown_vocabulary(money(spark, *kinds), specs.FINANCIALS, f"{tmp_path}/v", width)
    assert grown("Home Loan, and Car Loan", None, "junk") == ["Car Loan", "Home Loan"]
    assert grown("Auto Loan", "Home Loan") == ["Car Loan", "Home Loan", "Auto Loan"]
    assert grown("Boat Loan") == ["Car Loan", "Home Loan", "Auto Loan"]
    assert grown("Boat Loan", width=4) == ["Car Loan", "Home Loan", "Auto Loan", "Boat Loan"]
    stored = spark.read.parquet(f"{tmp_path}/v")
    assert sorted((r.position, r.token) for r in stored.collect()) == [(0, "Car Loan"), (1, "Home Loan"), (2, "Auto Loan"), (3, "Boat Loan")]


def test_a_build_makes_the_columns_of_its_data(spark, tmp_path):
    source = tmp_path / "money.csv"
    source.write_text("Customer_ID,Annual_Income,Type_of_Loan,snapshot_date\nCUS_0x1,50000,Auto Loan and Home Loan,2024-01-01\nCUS_0x2,50000,Car Loan,2024-02-01\n")
    layout = build.Layout(f"{tmp_path}/lake")
    for month in ("2024-01-01", "2024-02-01"):
        build.ingest(spark, {"financials": str(source)}, layout, month)
        build.refine(spark, layout, "2024-12-31", month)
    rows = silver.read_kept(spark, layout.silver("financials")).orderBy("Customer_ID").collect()
    assert [(r.has_auto_loan, r.has_home_loan, r.has_car_loan) for r in rows] == [(1, 1, 0), (0, 0, 1)]
