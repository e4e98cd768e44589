"""Flags, labels and tags."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Occupations counted as professionals, managers, executives, technicians.
PMET_OCCUPATIONS = (
    "LAWYER", "DOCTOR", "ACCOUNTANT", "MANAGER", "SCIENTIST", "ARCHITECT",
    "TEACHER", "ENGINEER", "DEVELOPER", "MEDIA_MANAGER", "JOURNALIST",
)


def indicator(condition: Column) -> Column:
    """1 where the condition holds, 0 where it does not or is null."""
    return F.when(condition, 1).otherwise(0)


def one_hot(value: Column, levels: dict[str, str]) -> dict[str, Column]:
    """One 0/1 column per level; ``levels`` maps output name to level."""
    return {name: indicator(value == level) for name, level in levels.items()}


def membership(value: Column, members: Iterable[str] = PMET_OCCUPATIONS) -> Column:
    return indicator(value.isin(list(members)))


def threshold_label(value: Column, threshold: int) -> Column:
    return indicator(value >= threshold)


def label_definition(dpd: int, mob: int) -> Column:
    return F.lit(f"{dpd}dpd_{mob}mob")


def direction(change: Column, up: float = 0.0, down: float = 0.0) -> Column:
    """improving / degrading / stable by how far a change leaves the band."""
    return F.when(change > up, "improving").when(change < down, "degrading").when(change.isNotNull(), "stable")


# Limits of the two classes below.
def degradation_class(drop: Column) -> Column:
    """Class of an AUC drop from validation to a later period."""
    return F.when(drop > 0.05, "significant").when(drop > 0.02, "moderate").when(drop.isNotNull(), "stable")


def long_trend(change: Column) -> Column:
    """Class of the AUC change over all out-of-time periods."""
    return F.when(change < -0.05, "degrading").when(change > 0.02, "improving").when(change.isNotNull(), "stable")
