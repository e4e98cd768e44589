"""Stored daily sums against trailing means made from all facts."""

import datetime as dt
import random

from pyspark.sql import functions as F

from tenorlake.operators import joins
from tenorlake.plans import rolling

FACTS = "Customer_ID string, snapshot_date date, v int"
SPINE = "loan_id string, Customer_ID string, snapshot_date date"


def plain(df):
    return sorted(map(str, df.collect()))


def tables(spark, seed=5):
    rng = random.Random(seed)
    start = dt.date(2023, 1, 1)
    some = lambda: rng.choice(["a", "b", "c", "hot", "hot", "hot", None])
    facts = [(some(), rng.choice([None, start + dt.timedelta(rng.randrange(700))]), rng.choice([None, rng.randrange(50)])) for _ in range(900)]
    spine = [(f"l{i}", some(), rng.choice([None, start + dt.timedelta(rng.randrange(750))])) for i in range(120)]
    return spark.createDataFrame(facts, FACTS), spark.createDataFrame(spine + spine[:5], SPINE)


def test_stored_sums_give_the_same_means(spark, tmp_path):
    facts, spine = tables(spark)
    root = f"{tmp_path}/sums"
    rolling.update(facts, root, "Customer_ID", ["v"])
    want = joins.trailing_features(spine, facts, "Customer_ID", ["v"])
    assert plain(rolling.trailing_features(spine, root, "Customer_ID", ["v"])) == plain(want)
    empty = spine.limit(0)
    assert rolling.trailing_features(empty, root, "Customer_ID", ["v"]).collect() == []


def test_a_month_is_replaced_alone_and_can_lose_all_its_facts(spark, tmp_path):
    facts, spine = tables(spark)
    root = f"{tmp_path}/sums"
    rolling.update(facts, root, "Customer_ID", ["v"])
    july = F.trunc("snapshot_date", "MM") == F.lit("2023-07-01").cast("date")
    june = F.trunc("snapshot_date", "MM") == F.lit("2023-06-01").cast("date")
    changed = facts.withColumn("v", F.when(july, F.col("v") + 7).otherwise(F.col("v"))).where(~F.coalesce(june, F.lit(False)))
    rolling.update(changed, root, "Customer_ID", ["v"], month="2023-07-01")
    rolling.update(changed, root, "Customer_ID", ["v"], month="2023-06-01")
    want = joins.trailing_features(spine, changed, "Customer_ID", ["v"])
    assert plain(rolling.trailing_features(spine, root, "Customer_ID", ["v"])) == plain(want)


def test_a_snapshot_reads_seven_months(spark, tmp_path):
    facts, spine = tables(spark)
    root = f"{tmp_path}/sums"
    rolling.update(facts, root, "Customer_ID", ["v"])
    daily = rolling.sums_between(spark, root, dt.date(2023, 10, 1) - dt.timedelta(days=180), "2023-10-01")
    read = daily.select(F.input_file_name().alias("f")).distinct().collect()
    months = {r.f.partition("block_month=")[2][:7] for r in read}
    assert months == {f"2023-{m:02}" for m in range(4, 10)} | {"2023-10"} or months == {f"2023-{m:02}" for m in range(4, 10)}
    plan = daily._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(block_month" in plan and "block_month#" in plan
    one = spine.where("snapshot_date = date'2023-10-01'").unionByName(spark.createDataFrame([("x", "hot", dt.date(2023, 10, 1))], SPINE))
    got = rolling.trailing_features(one, root, "Customer_ID", ["v"], between=("2023-10-01", "2023-10-01"))
    assert plain(got) == plain(joins.trailing_features(one, facts, "Customer_ID", ["v"]))
