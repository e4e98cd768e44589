"""Trailing means kept up to date: daily sums of facts as a table by month, of which a new snapshot reads its window.

Sums and counts add up, so facts are reduced once, when their month arrives, to one row per key and day. The features of a
snapshot then read the months its window touches (seven, for 180 days) and no fact at all.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenorlake.operators import joins
from tenorlake.sources import snapshots

BLOCK = "block_month"


def update(
    facts: DataFrame, root: str, key: str, columns: Sequence[str], fact_date: str = "snapshot_date", month: str | None = None
) -> None:
    """Put the daily sums of whole months in place of those there; with ``month`` (its first day) of that month alone.

    Without ``month`` the facts stand for the whole table: months that they no longer have go. A month that has lost all
    its facts loses its block. Facts without key or date are in no window and left out.
    """
    day = F.col(fact_date).cast("date")
    if month is not None:
        facts = facts.where((day >= _date(month)) & (day < F.add_months(_date(month), 1)))
    daily = joins.daily_sums(facts, key, columns, fact_date).withColumn(BLOCK, F.trunc("_day", "MM"))
    snapshots.write_snapshots(daily, root, (BLOCK,), snapshots.only(month, BLOCK))


def sums_between(spark: SparkSession, root: str, first: str | dt.date, last: str | dt.date) -> DataFrame:
    """Daily sums from ``first`` to ``last``, both included; other months' folders are not opened."""
    block = F.col(BLOCK).between(F.trunc(_date(first), "MM"), F.trunc(_date(last), "MM"))
    return snapshots.read_snapshots(spark, root).where(block & F.col("_day").between(_date(first), _date(last))).drop(BLOCK)


def trailing_features(
    spine: DataFrame, root: str, key: str, columns: Sequence[str], days: int = 180, spine_date: str = "snapshot_date",
    between: tuple[str, str] | None = None, **names,
) -> DataFrame:
    """What ``joins.trailing_features`` returns, from the stored sums.

    ``between`` names the first and last day of the spine where the caller knows them, as for one snapshot; otherwise one
    aggregate finds them. ``names`` are those of ``joins.trailing_from_sums``.
    """
    first, last = between or spine.agg(*[f(F.col(spine_date).cast("date")) for f in (F.min, F.max)]).first()
    if first is None:  # no dated row: no window
        first = last = dt.date(1970, 1, 1)
    first = dt.date.fromisoformat(first) if isinstance(first, str) else first
    daily = sums_between(spine.sparkSession, root, first - dt.timedelta(days=days), last)
    return joins.trailing_from_sums(spine, daily, key, columns, days, spine_date, **names)


def _date(value: str | dt.date) -> Column:
    return F.lit(str(value)).cast("date")
