"""Data-quality rules: a flag per rule and a strategy for rows or values that fail.

A rule list is compiled to one projection. Rows are not split while rules run;
each row gets a route instead, so that the kept and the quarantined rows come
from one pass over the source.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, replace
from enum import Enum

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenorlake.functions import dates, text


class Strategy(Enum):
    DROP_ROW = "drop_row"
    FLAG_ONLY = "flag_only"
    DEFAULT_VALUE = "default_value"
    NULL_VALUE = "null_value"
    QUARANTINE = "quarantine"


ROUTE = "_route"
ROUTE_RULE = "_route_rule"


@dataclass(frozen=True)
class Rule:
    """Test one column. ``flag`` None keeps no flag column."""

    column: str
    test: Callable[[Column], Column]
    flag: str | None
    strategy: Strategy = Strategy.FLAG_ONLY
    default: object = None
    normalise: Callable[[Column], Column] | None = None

    def using(self, strategy: Strategy, default: object = None) -> Rule:
        return replace(self, strategy=strategy, default=default)

    @property
    def name(self) -> str:
        return self.flag or f"within_{self.column}"


def categorical(column: str, allowed: Iterable[str], strategy=Strategy.FLAG_ONLY, nulls: Sequence[str] = ()) -> Rule:
    """Upper-trimmed value in a list; ``nulls`` are spellings of a missing value."""
    members = [a.upper() for a in allowed]

    def normalise(value: Column) -> Column:
        return text.standardise(text.sentinel_to_null(value, *nulls) if nulls else value)

    return Rule(
        column, lambda c: c.isNotNull() & c.isin(members), f"valid_{column.lower()}", strategy, normalise=normalise
    )


def pattern(column: str, regex: str, flag: str, strategy=Strategy.FLAG_ONLY) -> Rule:
    """Regex match; a null value gives a null flag."""
    return Rule(column, lambda c: c.rlike(regex), flag, strategy)


def customer_id(column: str = "Customer_ID", strategy=Strategy.FLAG_ONLY) -> Rule:
    return pattern(column, text.CUSTOMER_ID_PATTERN, "valid_customer_id", strategy)


def date_range(column: str, as_of: str, strategy=Strategy.NULL_VALUE, earliest: str = dates.EARLIEST_DATE) -> Rule:
    """Date from ``earliest`` to ``as_of``, both inclusive."""
    low, high = (F.lit(d).cast("date") for d in (earliest, as_of))
    return Rule(column, lambda c: c.isNotNull() & (c >= low) & (c <= high), f"valid_{column}", strategy)


def positive(column: str, strategy=Strategy.DEFAULT_VALUE, default: object = 0.0) -> Rule:
    return Rule(column, lambda c: c.isNotNull() & (c > 0), f"valid_{column}", strategy, default)


def non_negative(column: str, strategy=Strategy.DEFAULT_VALUE, default: object = 0.0) -> Rule:
    return Rule(column, lambda c: c.isNotNull() & (c >= 0), f"valid_{column}", strategy, default)


def between(column: str, low: float, high: float, flag: str, strategy=Strategy.FLAG_ONLY) -> Rule:
    return Rule(column, lambda c: c.isNotNull() & (c >= low) & (c <= high), flag, strategy)


def present(column: str, strategy=Strategy.FLAG_ONLY) -> Rule:
    return Rule(column, lambda c: c.isNotNull(), f"valid_{column}", strategy)


def useful_text(column: str, strategy=Strategy.FLAG_ONLY) -> Rule:
    """Filled and specified text; blank text counts as missing, the rest is trimmed."""
    return Rule(
        column, text.is_useful, f"valid_{column.lower()}", strategy,
        normalise=lambda c: F.trim(text.sentinel_to_null(c, "")),
    )


def extreme_outlier(column: str, low: float, high: float) -> Rule:
    """Quarantine non-null values outside a hard band; nulls stay."""
    return Rule(column, lambda c: c.isNull() | ((c >= low) & (c <= high)), None, Strategy.QUARANTINE)


def route_rows(df: DataFrame, rules: Iterable[Rule], null_flag: str = "lost") -> DataFrame:
    """Apply rules in order and add the route of every row.

    ``_route`` is null for rows to keep, else ``drop``, ``quarantine`` or what
    ``null_flag`` says about a quarantine rule with a null flag: ``lost`` drops
    the row from both outputs, ``quarantine`` keeps it on the quarantine side.
    ``_route_rule`` names the first rule that took the row out. Rules on absent
    columns are skipped. Rows routed by an earlier call keep their route.
    """
    if null_flag not in ("lost", "quarantine"):
        raise ValueError("null_flag must be 'lost' or 'quarantine'")
    names = set(df.columns)
    earlier = ROUTE in names
    value: dict[str, Column] = {}
    flags: dict[str, Column] = {}
    exits: list[tuple[Column, str, str]] = []
    for rule in rules:
        if rule.column not in names:
            continue
        current = value.get(rule.column, F.col(rule.column))
        if rule.normalise:
            current = rule.normalise(current)
        ok = rule.test(current)
        if rule.flag:
            flags[rule.flag] = ok
        if rule.strategy is Strategy.DROP_ROW:
            exits.append((~F.coalesce(ok, F.lit(False)), "drop", rule.name))
        elif rule.strategy is Strategy.QUARANTINE:
            exits.append((~ok, "quarantine", rule.name))
            exits.append((ok.isNull(), null_flag, rule.name))
        elif rule.strategy is Strategy.NULL_VALUE:
            current = F.when(ok, current)
        elif rule.strategy is Strategy.DEFAULT_VALUE and rule.default is not None:
            current = F.when(ok, current).otherwise(F.lit(rule.default))
        value[rule.column] = current
    replaced = {*flags, ROUTE, ROUTE_RULE}
    data = [value[c].alias(c) if c in value else F.col(c) for c in df.columns if c not in replaced]
    routes = []
    for position, name in ((1, ROUTE), (2, ROUTE_RULE)):
        taken = [F.col(name)] if earlier else []
        taken += [F.when(e[0], F.lit(e[position])) for e in exits]
        routes.append((F.coalesce(*taken) if taken else F.lit(None).cast("string")).alias(name))
    return df.select(*data, *[flag.alias(name) for name, flag in flags.items()], *routes)


def kept(routed: DataFrame) -> DataFrame:
    return routed.where(F.col(ROUTE).isNull()).drop(ROUTE, ROUTE_RULE)


def quarantined(routed: DataFrame) -> DataFrame:
    """Rows to set aside, with the rule that rejected them in ``rule``."""
    return routed.where(F.col(ROUTE) == "quarantine").drop(ROUTE).withColumnRenamed(ROUTE_RULE, "rule")


def apply_rules(df: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """The kept rows only."""
    return kept(route_rows(df, rules))


def route_counts(routed: DataFrame, *more: Column) -> DataFrame:
    """Rows per route and rule, and ``more`` aggregates: the counts of a run in one pass."""
    route = F.coalesce(F.col(ROUTE), F.lit("keep")).alias("route")
    return routed.groupBy(route, F.col(ROUTE_RULE).alias("rule")).agg(F.count(F.lit(1)).alias("n"), *more)
