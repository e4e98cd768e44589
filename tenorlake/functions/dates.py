"""Date parsing and month arithmetic."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted source formats, first hit wins.
SILVER_FORMATS = ("d/M/yy", "yyyy-MM-dd")
BRONZE_FORMATS = ("yyyy-MM-dd", "d/M/yy")
EARLIEST_DATE = "2020-01-01"


def parse_date(value: Column, formats: tuple[str, ...] = SILVER_FORMATS, fallback: bool = True) -> Column:
    """First format that parses; optionally Spark's own date syntax last.

    A format is only tried on text that has its separators, since a failed parse
    costs far more than looking for a character.
    """
    as_text = value.cast("string")
    attempts = []
    for pattern in formats:
        separators = {c for c in pattern if not c.isalnum()}
        fits = reduce(lambda a, b: a & b, [as_text.contains(c) for c in sorted(separators)], F.lit(True))
        attempts.append(F.when(fits, F.try_to_date(as_text, pattern)))
    if fallback:
        attempts.append(as_text.try_cast("date"))
    return F.coalesce(*attempts)


def first_missed_date(snapshot: Column, missed: Column) -> Column:
    """The snapshot moved back by the missed months; null if none was missed."""
    return F.when(missed > 0, F.add_months(snapshot, -missed))


def days_past_due(snapshot: Column, first_missed: Column, overdue: Column) -> Column:
    late = (overdue > 0) & first_missed.isNotNull()
    return F.when(late, F.date_diff(snapshot, first_missed)).otherwise(0)


def window_start(day: Column, days: int) -> Column:
    return F.date_sub(day, days)


def month_starts(last: Column, months: int) -> Column:
    """Array of ``months`` month starts ending with the month of ``last``."""
    if months < 1:
        raise ValueError("months must be at least 1")
    end = F.trunc(last, "MM").cast("date")
    return F.sequence(F.add_months(end, -(months - 1)), end, F.expr("interval 1 month"))


def backward_windows(
    snapshot: Column, train: int = 12, validation: int = 3, test: int = 2, oot: int = 1, maturity_months: int = 0
) -> Column:
    """Array of (split, start_date, end_date), stacked backwards from the snapshot.

    Every window is that many months long, both ends inclusive. ``maturity_months``
    moves the whole stack back, for labels that need time to mature.
    """
    end = F.add_months(snapshot, -maturity_months) if maturity_months else snapshot.cast("date")
    windows = []
    for name, length in (("oot", oot), ("test", test), ("validation", validation), ("train", train)):
        start = F.add_months(end, -(length - 1))
        windows.insert(0, F.struct(F.lit(name).alias("split"), start.alias("start_date"), end.alias("end_date")))
        end = F.add_months(start, -1)
    return F.array(*windows)
