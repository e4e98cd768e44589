"""Text cleaning and text-derived values."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns the data is checked against.
CUSTOMER_ID_PATTERN = "^CUS_0x[0-9A-Fa-f]+$"
SSN_PATTERN = r"^\d{3}-\d{2}-\d{4}$"
NUMBER_NOISE = r"[_,$\s]"
YEARS_PATTERN = r"(\d+)\s+Years?"
MONTHS_PATTERN = r"(\d+)\s+Months?"
ID_DATE_PATTERN = r"_(\d{4}_\d{2}_\d{2})$"
UNSPECIFIED = "Not Specified"


def clean_number(value: Column) -> Column:
    """Strip thousands separators, currency signs, underscores and blanks."""
    raw = value.cast("string")
    return F.when(raw.rlike(NUMBER_NOISE), F.regexp_replace(raw, NUMBER_NOISE, "")).otherwise(raw)


def standardise(value: Column) -> Column:
    return F.upper(F.trim(value))


def sentinel_to_null(value: Column, *sentinels: str) -> Column:
    return F.when(~value.isin(list(sentinels)), value)


def is_useful(value: Column) -> Column:
    """Filled text other than the "unspecified" marker; never null itself."""
    return value.isNotNull() & (value != UNSPECIFIED) & (F.length(value) > 0)


def contains_level(value: Column, levels: dict[str, int], default: int = 0) -> Column:
    """Level of the first needle found in the text, else ``default``."""
    level = F.lit(default)
    for needle, number in reversed(levels.items()):
        level = F.when(value.contains(needle), number).otherwise(level)
    return level


def tokens(value: Column, must_contain: str | None = None) -> Column:
    """Distinct trimmed tokens of a list written with commas and " and "."""
    listed = F.split(F.replace(value, F.lit(" and "), F.lit(",")), ",")
    parts = F.transform(listed, lambda token: F.regexp_replace(token, r"^\s+|\s+$", ""))

    def wanted(token: Column) -> Column:
        keep = (token != "") & (token != UNSPECIFIED)
        return keep & token.contains(must_contain) if must_contain else keep

    return F.array_distinct(F.filter(parts, wanted))


def has_token(value: Column, token: str) -> Column:
    """1 if the token occurs between word boundaries, 0 otherwise and for null."""
    pattern = r"\b" + re.sub(r"([\\.^$|?*+()\[\]{}])", r"\\\1", token) + r"\b"
    return F.when(value.rlike(pattern), 1).otherwise(0)


def token_column(token: str) -> str:
    return "has_" + token.lower().replace(" ", "_").replace("-", "_")


def duration_months(value: Column) -> Column:
    """Months in texts such as "10 Years and 9 Months"; a missing part counts 0."""

    def part(pattern: str) -> Column:
        return F.coalesce(F.regexp_extract(value, pattern, 1).try_cast("int"), F.lit(0))

    return F.when(value.isNotNull(), part(YEARS_PATTERN) * 12 + part(MONTHS_PATTERN))


def id_date_suffix(identifier: Column) -> Column:
    """The ``yyyy_MM_dd`` ending of an id, empty if there is none."""
    return F.regexp_extract(identifier, ID_DATE_PATTERN, 1)
