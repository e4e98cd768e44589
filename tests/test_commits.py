"""Writes of snapshot tables that stop at any point."""

import dataclasses
import os

import pytest
from pyspark.sql import functions as F

from tenorlake.sources import snapshots


def rows(spark, n, months=3):
    return spark.range(n).withColumn("snapshot_date", F.expr(f"add_months(date'2024-01-01', cast(id % {months} as int))"))


def counts(df):
    return {str(r.snapshot_date): r["count"] for r in df.groupBy("snapshot_date").count().collect()}


WHOLE = {"2024-01-01": 10, "2024-02-01": 10, "2024-03-01": 10}


@pytest.fixture()
def root(spark, tmp_path):
    snapshots.write_snapshots(rows(spark, 30), f"{tmp_path}/t")
    return f"{tmp_path}/t"


def test_a_staged_write_is_invisible(spark, root):
    snapshots.stage(rows(spark, 4, 2), root, replaces=F.lit(True))
    assert counts(spark.read.parquet(root)) == counts(snapshots.read_snapshots(spark, root)) == WHOLE
    snapshots.write_snapshots(rows(spark, 2, 1), root)
    assert counts(spark.read.parquet(root)) == WHOLE | {"2024-01-01": 2}


def test_a_committed_write_is_finished_by_the_next_reader(spark, root):
    staged = snapshots.stage(rows(spark, 4, 2), root, replaces=F.lit(True))
    snapshots.commit(spark, root, staged)
    assert counts(snapshots.read_optional(spark, root)) == {"2024-01-01": 2, "2024-02-01": 2}
    snapshots.finish(spark, root)
    assert counts(spark.read.parquet(root)) == {"2024-01-01": 2, "2024-02-01": 2}
    assert os.listdir(f"{root}/_commits") == [] or all(f.startswith(".") for f in os.listdir(f"{root}/_commits"))


def test_a_half_finished_write_is_finished_whole(spark, root):
    staged = snapshots.stage(rows(spark, 4, 2), root, replaces=F.lit(True))
    snapshots.commit(spark, root, staged)
    os.rename(f"{root}/snapshot_date=2024-01-01", f"{root}/_old")
    os.rename(f"{root}/_staged/{staged.name}/snapshot_date=2024-01-01", f"{root}/snapshot_date=2024-01-01")
    assert counts(snapshots.read_snapshots(spark, root)) == {"2024-01-01": 2, "2024-02-01": 2}


def test_a_table_can_be_rewritten_from_itself(spark, root):
    mine = snapshots.read_snapshots(spark, root).where("id % 5 = 0 and snapshot_date < date'2024-03-01'")
    snapshots.write_snapshots(mine, root, replaces=F.lit(True))
    assert counts(spark.read.parquet(root)) == {"2024-01-01": 2, "2024-02-01": 2}


def test_stale_partitions_go_without_jobs_and_the_last_keeps_the_columns(spark, root):
    one = snapshots.only("2024-02-01")
    snapshots.write_snapshots(rows(spark, 0), root, replaces=one)
    assert counts(spark.read.parquet(root)) == {"2024-01-01": 10, "2024-03-01": 10}
    assert not os.path.exists(f"{root}/snapshot_date=2024-02-01")
    snapshots.write_snapshots(rows(spark, 0), root, replaces=F.lit(True))
    left = spark.read.parquet(root)
    assert left.count() == 0 and left.columns == ["id", "snapshot_date"]


def test_rows_are_evaluated_once(spark, root):
    seen = spark.sparkContext.accumulator(0)

    def passing(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = rows(spark, 30).mapInArrow(passing, "id long, snapshot_date date")
    snapshots.write_snapshots(df, root, replaces=F.lit(True))
    assert seen.value == 30


def test_an_append_counts_once_whatever_stops(spark, root):
    more = rows(spark, 6, 3)
    assert snapshots.append_snapshots(more, root, "batch-0")
    assert not snapshots.append_snapshots(more, root, "batch-0")
    assert counts(snapshots.read_snapshots(spark, root)) == {m: 12 for m in WHOLE}
    # stopped before the commit: invisible, and the repeated batch counts once
    snapshots.stage(more, root)
    assert counts(snapshots.read_snapshots(spark, root)) == {m: 12 for m in WHOLE}
    # stopped after the commit, with one file moved already
    staged = dataclasses.replace(snapshots.stage(more, root), joins=True, token="batch-1")
    snapshots.commit(spark, root, staged)
    folder = f"{root}/_staged/{staged.name}/snapshot_date=2024-01-01"
    file = next(f for f in os.listdir(folder) if f.startswith("part-"))
    os.rename(f"{folder}/{file}", f"{root}/snapshot_date=2024-01-01/{file}")
    assert not snapshots.append_snapshots(more, root, "batch-1")
    assert counts(snapshots.read_snapshots(spark, root)) == {m: 14 for m in WHOLE}
    snapshots.write_snapshots(rows(spark, 1, 1), root)
    assert counts(spark.read.parquet(root)) == {m: 14 for m in WHOLE} | {"2024-01-01": 1}
