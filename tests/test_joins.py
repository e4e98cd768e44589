import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

import tenorlake

from tenorlake.operators import joins, tables
from tenorlake.plans import gold, readiness

DAY = dt.date(2023, 6, 1)


def days(n):
    return DAY + dt.timedelta(days=n)


@pytest.fixture(scope="module")
def skewed(spark):
    """Spine and history in which one key holds more than a third of the rows."""
    rng = random.Random(7)
    keys = ["hot"] * 120 + [f"k{i}" for i in range(40)] * 5
    spine = [(f"L{i}", rng.choice(keys), days(rng.randint(0, 60)), 0) for i in range(300)] + [("L0", None, DAY, 0), ("L1", "hot", None, 0)]
    history = [(rng.choice(keys), days(rng.randint(-40, 60)), rng.randint(0, 9), rng.choice(["a", "b", None])) for _ in range(400)]
    history += [(None, DAY, 1, "x"), ("hot", None, 1, "x")]
    return (
        spark.createDataFrame(spine, "loan_id string, Customer_ID string, snapshot_date date, mob int"),
        spark.createDataFrame(history, "Customer_ID string, snapshot_date date, v int, w string"),
        spine, history,
    )


def plain(df):
    return sorted(map(str, (tuple(r) for r in df.collect())))


def test_history_join_matches_brute_force(skewed):
    spine_df, history_df, spine, history = skewed
    want = []
    for s in spine:
        hits = [h for h in history if s[1] is not None and s[2] is not None and h[0] == s[1] and h[1] is not None and h[1] <= s[2]]
        want += [(*s, h[2], h[3]) for h in hits] or [(*s, None, None)]
    assert plain(joins.history_join(spine_df, history_df, "Customer_ID")) == sorted(map(str, want))


def test_latest_join_matches_brute_force(skewed):
    spine_df, history_df, spine, history = skewed
    want = []
    for s in spine:
        hits = [h for h in history if None not in (s[1], s[2], h[1]) and h[0] == s[1] and h[1] <= s[2]]
        best = max(hits, key=lambda h: (h[1], h[2], h[3] or ""), default=None)
        want.append((*s, best[2], best[3]) if best else (*s, None, None))
    assert plain(joins.latest_join(spine_df, history_df, "Customer_ID")) == sorted(map(str, want))


def test_trailing_features_match_brute_force(skewed):
    spine_df, history_df, spine, history = skewed
    want = set()
    for s in spine:
        hits = [
            h for h in history
            if None not in (s[1], s[2], h[1]) and h[0] == s[1] and s[2] - dt.timedelta(days=30) <= h[1] <= s[2]
        ]
        mean = sum(h[2] for h in hits) / len(hits) if hits else None
        want.add((*s, mean, len(hits)))
    out = joins.trailing_features(spine_df, history_df, "Customer_ID", ["v"], 30)
    assert plain(out) == sorted(map(str, want))


def test_trailing_window_edges(spark):
    spine = spark.createDataFrame([("a", "c", DAY, 0)] * 2 + [("b", "none", DAY, 0)], "loan_id string, Customer_ID string, snapshot_date date, mob int")
    facts = spark.createDataFrame(
        [("c", days(-181), 1), ("c", days(-180), 2), ("c", DAY, 4), ("c", days(1), 8), ("c", days(-3), None)],
        "Customer_ID string, snapshot_date date, fe_1 int",
    )
    rows = {r.loan_id: r for r in joins.trailing_features(spine, facts, "Customer_ID", ["fe_1"]).collect()}
    assert (rows["a"].avg_fe_1_last_6m, rows["a"].clickstream_snapshot_count) == (3.0, 6)
    assert (rows["b"].avg_fe_1_last_6m, rows["b"].clickstream_snapshot_count) == (None, 0)
    kept = joins.trailing_features(spine, facts, "Customer_ID", ["fe_1"], collapse_duplicates=False)
    assert sorted((r.loan_id, r.clickstream_snapshot_count) for r in kept.collect()) == [("a", 3), ("a", 3), ("b", 0)]


def test_copies_of_customer_rows_are_counted(spark):
    """Joining first and grouping by every column afterwards gives the same counts."""
    loans = spark.createDataFrame([("a", "c", DAY, 0)] * 2 + [("b", "d", DAY, 0)], "loan_id string, Customer_ID string, snapshot_date date, mob int")
    people = spark.createDataFrame([("c", 1), ("c", 1), ("c", 2)], "Customer_ID string, size int")
    money = spark.createDataFrame([("c", days(-9), 5.0), ("c", days(-8), 5.0)], "Customer_ID string, snapshot_date date, debt double")
    clicks = spark.createDataFrame([("c", days(-1), 4), ("c", DAY, 6), ("d", DAY, 7)], "Customer_ID string, snapshot_date date, fe_1 int")
    rows = gold.features(loans, people, money, clicks).collect()
    got = sorted((r.loan_id, r["size"] or 0, r.debt, r.avg_fe_1_last_6m, r.clickstream_snapshot_count) for r in rows)
    # two loan rows, two debt rows alike but for their date, two clicks
    assert got == [("a", 1, 5.0, 5.0, 16), ("a", 2, 5.0, 5.0, 8), ("b", 0, None, 7.0, 1)]
    assert rows[0].__fields__[4:] == ["size", "debt", "avg_fe_1_last_6m", "clickstream_snapshot_count", "feature_snapshot_date"]


def test_feature_store_switches(spark):
    loans = spark.createDataFrame([("a", "c", DAY, 0), ("a", "c", days(180), 6)], "loan_id string, Customer_ID string, snapshot_date date, mob int")
    money = spark.createDataFrame(
        [("c", days(-30), "GOOD", "YES", 1.0), ("c", DAY, None, "NM", 2.0), ("c", days(9), "BAD", "NO", 3.0)],
        "Customer_ID string, snapshot_date date, Credit_Mix string, Payment_of_Min_Amount string, debt double",
    )
    every = gold.features(loans, financials=money)
    assert sorted(r.debt for r in every.collect()) == [1.0, 2.0]
    latest = gold.features(loans, financials=money, latest_only=True).collect()
    assert [(r.debt, r.credit_mix_good, r.payment_min_nm, r.feature_snapshot_date) for r in latest] == [(2.0, 0, 1, "2023-06-01")]
    bare = gold.features(loans, financials=money, encode_before_drop=False)
    assert bare.columns == ["loan_id", "Customer_ID", "snapshot_date", "mob", "debt", "feature_snapshot_date"]
    assert gold.features(loans).count() == 1


def test_hot_customers_are_split(spark, tmp_path):
    """Two joins in a row on the customer, a third of the applications being one customer's."""
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "40k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    key = "if(id % 3 = 0, 'hot', concat('k', id % 5000))"
    loans = spark.range(30_000).selectExpr("cast(id as string) loan_id", f"{key} Customer_ID", "date_add(date'2023-01-01', cast(id % 400 as int)) snapshot_date", "0 mob")
    sides = [spark.range(5000).selectExpr("if(id < 3, 'hot', concat('k', id)) Customer_ID", "date'2023-01-01' snapshot_date", f"id as {c}") for c in "xy"]
    for name, df in (("l", loans), ("x", sides[0]), ("y", sides[1])):
        df.write.parquet(f"{tmp_path}/{name}")
    tenorlake.prepare(spark)
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        out = gold.features(*[spark.read.parquet(f"{tmp_path}/{n}") for n in "lxy"])
        assert len(out.collect()) == 10_000 * 9 + 20_000
        plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert plan.count("SortMergeJoin(skew=true)") == 2
    finally:
        for k in small:
            spark.conf.unset(k)


def test_splits_overlap_and_leave_gaps(spark):
    windows = [
        {"split": "train", "start_date": "2023-01-01", "end_date": "2023-03-01"},
        {"split": "oot", "start_date": "2023-03-01", "end_date": "2023-04-01"},
        {"split": "empty", "start_date": "2030-01-01", "end_date": "2030-04-01"},
    ]
    df = spark.sql("select explode(array(date'2023-01-01', date'2023-03-01', date'2023-05-01')) as d")
    rows = joins.assign_splits(df, "d", windows)
    assert sorted((str(r.d), r.split) for r in rows.collect()) == [
        ("2023-01-01", "train"), ("2023-03-01", "oot"), ("2023-03-01", "train"),
    ]
    assert {r.split: r.n for r in tables.split_sizes(rows, windows).collect()} == {"train": 2, "oot": 1, "empty": 0}
    assert [r.split for r in tables.empty_splits(rows, windows).collect()] == ["empty"]


def test_unmatched_keys(spark):
    left = spark.createDataFrame([("x_2023_01_01", "c"), ("y_2023_02_01", "c"), ("x_2023_01_01", "c")], "loan_id string, Customer_ID string")
    right = spark.createDataFrame([("y_2023_02_01", "c"), ("z_2023_03_01", "c")], "loan_id string, Customer_ID string")
    rows = {r.side: r for r in joins.unmatched_summary(left, right).collect()}
    assert rows["left"].sample_ids == ["x_2023_01_01"] and rows["right"].first_start == "2023_03_01"
    assert joins.match_report(left, right).first().asDict() == {"left_rows": 3, "right_rows": 2, "matched": 1}
    empty = joins.match_report(left.limit(0), right.limit(0)).first()
    assert (empty.left_rows, empty.matched) == (0, 0)


def test_aligned_snapshots(spark):
    labels = spark.createDataFrame(
        [("a_2024_01_01", "2024-07-01"), ("b_2023_12_01", "2024-07-01"), ("c", "2024-09-01"), ("d", "2030-01-01")], "loan_id string, s string"
    ).select("loan_id", F.col("s").cast("date").alias("snapshot_date"))

    def chosen(available, strict=False):
        there = spark.createDataFrame([(a,) for a in available], "s string").select(F.col("s").cast("date").alias("inference_date"))
        rows = joins.aligned_snapshots(labels, there, strict_priority=strict).collect()
        return {str(r.label_date): (str(r.prediction_date), r.source) for r in rows}

    both = ["2024-01-01", "2023-12-01", "2024-09-01"]
    assert chosen(both) == {
        "2024-07-01": ("2023-12-01", "id_date"), "2024-09-01": ("2024-09-01", "same_day"), "2030-01-01": ("None", None),
    }
    assert chosen(both, strict=True)["2024-07-01"] == ("2024-01-01", "offset")


def test_missing_outputs_and_readiness(spark):
    models = spark.createDataFrame([("model_1",), ("model_2",)], "model_id string")
    need = joins.required_outputs(models, F.lit("2024-12-01").cast("date"), 3)
    have = need.where("model_id = 'model_1' or month = date'2024-12-01'")
    gaps = joins.missing_outputs(need, have)
    assert sorted((r.model_id, str(r.month)) for r in gaps.collect()) == [("model_2", "2024-10-01"), ("model_2", "2024-11-01")]
    assert joins.missing_outputs(need, have.unionByName(gaps)).count() == 0
    snapshots = spark.sql("select explode(array(date'2024-11-01', date'2024-12-01')) as snapshot_date")
    done = spark.createDataFrame([("model_1", "2024-06-01"), ("model_2", "2024-06-01"), ("model_1", "2024-05-01")], "model_id string, inference_date string")
    rows = {str(r.snapshot_date): r for r in readiness.readiness(snapshots, models, done, ["model_1", "model_2"]).collect()}
    assert (rows["2024-12-01"].can_train, rows["2024-12-01"].can_score, rows["2024-12-01"].can_monitor) == (True, True, True)
    assert (rows["2024-11-01"].can_train, rows["2024-11-01"].can_monitor) == (False, False)


def test_union_goes_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "n int, s string")
    b = spark.createDataFrame([("y", 2, True)], "s string, n int, extra boolean")
    assert [tuple(r) for r in tables.union_snapshots([a, b]).orderBy("n").collect()] == [(1, "x", None), (2, "y", True)]


def test_windows_from_a_table(spark):
    windows = [("a", "2024-01-15", "2024-03-02"), ("b", "2024-02-01", "2024-02-01"), ("c", "2024-05-01", "2024-04-01"), ("d", None, "2024-04-01")]
    table = spark.createDataFrame(windows, "split string, start_date string, end_date string")
    rows = spark.createDataFrame([(d, "x") for d in ("2024-01-14", "2024-01-15", "2024-02-01", "2024-03-02", "2024-03-03", None)], "day string, split string")
    found = joins.assign_split_table(rows.withColumn("day", F.col("day").cast("date")), "day", table)
    assert sorted((r.split, str(r.day)) for r in found.collect()) == [("a", "2024-01-15"), ("a", "2024-02-01"), ("a", "2024-03-02"), ("b", "2024-02-01")]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner, (" in plan and "_month" in plan


def test_availability_counts_feature_keys_in_no_task(spark):
    rows = [("2024-01-01", "a", "c"), ("2024-01-01", "a", "c"), ("2024-01-01", "b", "c"), ("2024-02-01", None, "c"), (None, "a", "c")]
    features = spark.createDataFrame(rows, "snapshot_date string, loan_id string, Customer_ID string")
    labels = features.where("loan_id is null or loan_id = 'a'").unionByName(spark.createDataFrame([("2024-03-01", "a", "c")], features.schema))
    found = joins.availability(features, labels)
    got = {r.snapshot_date: (r.n_features, r.n_labels, r.n_joined) for r in found.collect()}
    assert got == {"2024-01-01": (3, 2, 4), "2024-02-01": (1, 1, 1), "2024-03-01": (0, 1, 0), None: (1, 1, 1)}
    assert [d for _, d in found.dtypes] == ["string", "bigint", "bigint", "bigint"]
    physical = found._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in physical and "SortMergeJoin" not in physical
