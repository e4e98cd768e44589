"""Counts, distinct values, unions, samples and top rows."""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping, Sequence
from fractions import Fraction
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenorlake.operators import ranking
from tenorlake.sources import lineage


def union_snapshots(tables: Iterable[DataFrame]) -> DataFrame:
    """Union by column name; a column absent from one table is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def distinct_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).distinct()


def group_counts(df: DataFrame, columns: Sequence[str], name: str = "n") -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias(name)).orderBy(*columns)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per named table with its count and whether it is empty."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n", (F.col("n") == 0).alias("is_empty"))
        for name, df in tables.items()
    ]
    return union_snapshots(counted)


def date_extent(df: DataFrame, day: str = "snapshot_date", member: str = "model_id") -> DataFrame:
    """First and last date, number of dates and the sorted members of a metric table."""
    return df.agg(
        F.min(day).alias("first_date"),
        F.max(day).alias("last_date"),
        F.count_distinct(day).alias("n_dates"),
        F.array_join(F.array_sort(F.collect_set(member)), ", ").alias("members"),
    )


def split_balance(df: DataFrame, label: str = "label") -> DataFrame:
    """Share of the positive class and size per split."""
    return df.groupBy("split").agg(
        F.avg(F.col(label).cast("double")).alias("default_rate"), F.count(F.lit(1)).alias("n")
    )


def split_sizes(df: DataFrame, windows: Sequence[Mapping[str, str]]) -> DataFrame:
    """Size of every configured split, 0 for those without rows."""
    names = [w["split"] for w in windows]
    counts = [F.count_if(F.col("split") == n).alias(n) for n in names]
    pairs = [F.struct(F.lit(n).alias("split"), F.col(n).alias("n")) for n in names]
    return df.agg(*counts).select(F.inline(F.array(*pairs)))


def empty_splits(df: DataFrame, windows: Sequence[Mapping[str, str]]) -> DataFrame:
    return split_sizes(df, windows).where("n = 0").select("split")


def sample_rows(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    """The first n rows in a stated order."""
    return df.orderBy(*order).limit(n)


def top_features(weights: DataFrame, weight: str = "weight", n: int = 20) -> DataFrame:
    """Largest weights by absolute value, names breaking ties."""
    return weights.orderBy(F.abs(weight).desc(), "feature").limit(n)


def column_stats(df: DataFrame, features: Sequence[str], stored: bool = False) -> DataFrame:
    """Filled values, mean, population std and exact median of each feature, one row per feature.

    Features without any value have no row. The features are read several times, so they are written once
    before, unless ``df`` is a table already (``stored``). One row per feature and pass reaches the driver.
    """
    rows = [(f, *row) for f, row in feature_stats(df, features, stored)[1].items()]
    return df.sparkSession.createDataFrame(rows, "feature string, n long, mean double, std double, median double")


def feature_stats(df: DataFrame, features: Sequence[str], stored: bool = False) -> tuple[int, dict[str, tuple[int, float, float, float]]]:
    """Number of rows, and for each feature with values their number, mean, std and median."""
    table = df.select(*[F.col(f).cast("double").alias(f) for f in features])
    if not stored:
        table = lineage.settled(table, "stats")
    moments = [F.struct(F.count(f).alias("n"), F.max(F.abs(f)).alias("most"), F.avg(f).alias("mean"), F.stddev_pop(f).alias("std")) for f in features]
    n_rows, found = table.agg(F.count(F.lit(1)), F.array(*moments)).first()
    own = {f: r for f, r in zip(features, found, strict=True) if r.n}
    means = exact_means(table, {f: (r.n, r.most) for f, r in own.items() if math.isfinite(r.most)}) if own else {}
    middle = {r.feature: r["median"] for r in ranking.column_medians(table, list(own)).collect()} if own else {}
    if not stored:
        lineage.discard(table)
    return n_rows, {f: (r.n, means.get(f, r["mean"]), r["std"], middle.get(f)) for f, r in own.items()}


def exact_means(df: DataFrame, known: Mapping[str, tuple[int, float]]) -> dict[str, float]:
    """Means of finite columns, rounded once, so that they don't depend on the order of the rows.

    ``known`` has the number of values of each column and the largest absolute one. A value is cut into whole
    multiples of a power of two and whole multiples of a smaller one, whose sums fit 64 bits.
    """
    if not known:
        return {}
    sums, scales = [], {}
    for f, (n, most) in known.items():
        fine = 62 - n.bit_length()
        coarse = min(fine - math.frexp(most)[1], 1000)
        scales[f] = coarse, fine
        scaled = F.col(f) * F.lit(math.ldexp(1.0, coarse))
        rest = (scaled - F.floor(scaled)) * F.lit(math.ldexp(1.0, fine))
        sums.append(F.struct(F.sum(F.floor(scaled)).alias("high"), F.sum(F.floor(rest)).alias("low")))
    found = df.agg(F.array(*sums).alias("s")).first().s
    means = {}
    for f, r in zip(known, found, strict=True):
        coarse, fine = scales[f]
        total = Fraction(r.high) + Fraction(r.low, 1 << fine)
        means[f] = float(total / known[f][0] / Fraction(2) ** coarse)
    return means


def null_shares(df: DataFrame, features: Sequence[str], limit: float = 0.10) -> DataFrame:
    """Share of nulls per feature in one aggregate, flagged above the limit."""
    pairs = [F.struct(F.lit(f).alias("feature"), F.col(f"_{i}").alias("null_share")) for i, f in enumerate(features)]
    shares = [F.avg(F.col(f).isNull().cast("double")).alias(f"_{i}") for i, f in enumerate(features)]
    return df.agg(*shares).select(F.inline(F.array(*pairs))).withColumn("too_many", F.col("null_share") > limit)


def long_form(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = (), name: str = "feature") -> DataFrame:
    """Columns as (name, value) rows, values as doubles."""
    pairs = [F.struct(F.lit(c).alias(name), F.col(c).cast("double").alias("value")) for c in columns]
    return df.select(*keep, F.inline(F.array(*pairs)))
