"""The next document by id, in blocks that stay small whatever the ids are."""

import random

import pytest
from pyspark.sql import functions as F

from tenorlake.llm import spotsigs

SCHEMA = "k long, t string"


def tables():
    rng = random.Random(3)
    dense = [(i, f"d{i}") for i in range(3000)]
    return {
        "outliers": [*dense, (2**60, "far"), (-(2**62), "low"), (2**63 - 1, "end"), (-(2**63), "start")],
        "nulls": [*dense, *[(None, f"n{i}") for i in range(1500)]],
        "only nulls": [(None, f"n{i}") for i in range(600)],
        "one id": [*dense[:1000], *[(77, f"same{i}") for i in range(1500)]],
        "greatest id twice": [*dense[:600], *[(2**63 - 1, f"z{i}") for i in range(400)]],
        "clusters": [(c * 10**12 + rng.randrange(10**9), f"c{c}{i}") for c in range(5) for i in range(700)],
        "one": [(5, "x")],
        "two": [(None, "x"), (5, "y")],
        "none": [],
    }


@pytest.mark.parametrize("case", list(tables()))
def test_blocks_are_bounded_and_lead_to_the_next_row(spark, case):
    given = tables()[case]
    df = spark.createDataFrame(given, SCHEMA)
    blocks = spotsigs.in_blocks(df, "k", "t", per_block=32, segments=64)
    sizes = [r["count"] for r in blocks.groupBy("block").count().collect()]
    assert sum(sizes) == len(given)
    assert max(sizes, default=0) <= 32 * 4
    ties = {t: h for t, h in df.select("t", F.xxhash64("t").alias("h")).collect()}
    order = sorted(given, key=lambda r: (r[0] is not None, r[0] or 0, ties[r[1]]))
    want = {(r, order[(i + 1) % len(order)][1]) for i, r in enumerate(order)}
    got = [((r.k, r.t), r.next_t) for r in spotsigs.with_next(df, "k", "t", ["t"], per_block=32, segments=64).collect()]
    assert len(got) == len(given) and set(got) == want
