"""Number parsing and guarded arithmetic."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tenorlake.functions import text as texts

INTEGER_TEXT = r"^([+-]?\d+)(?:\.\d*)?$"
PLAIN_INTEGER = "^[0-9]{1,9}$"


def to_int(text: Column) -> Column:
    """32-bit integer from clean text; a decimal part is cut off, bad text is null."""
    return F.regexp_extract(text.cast("string"), INTEGER_TEXT, 1).try_cast("int")


def clean_int(value: Column) -> Column:
    """:func:`to_int` of a raw value; plain digits, by far the most, are cast without being cleaned."""
    raw = value.cast("string")
    return F.when(raw.rlike(PLAIN_INTEGER), raw.try_cast("int")).otherwise(to_int(texts.clean_number(raw)))


def to_float(text: Column) -> Column:
    return text.try_cast("float")


def to_number(value: Column, data_type: str) -> Column:
    """Double for model input: text that is no number and NaN are null, booleans are 0/1."""
    if data_type == "boolean":
        return value.cast("int").cast("double")
    if data_type in ("string", "date", "timestamp", "timestamp_ntz"):
        text = value.cast("string")
        # a failed cast costs an exception per row, so text without a digit or a special value is not cast at all
        value = F.when(text.rlike("(?i)[0-9]|inf|nan"), text.try_cast("double"))
    else:
        value = value.cast("double")
    return F.when(~F.isnan(value), value)


def null_aware_sum(*values: Column) -> Column:
    """Sum with nulls as 0; null only if every value is null."""
    total = reduce(lambda a, b: a + b, [F.coalesce(v, F.lit(0)) for v in values])
    return F.when(F.coalesce(*values).isNotNull(), total)


def guarded_ratio(numerator: Column, denominator: Column) -> Column:
    """32-bit ratio, null unless both sides are there and the denominator is > 0."""
    return F.when(denominator > 0, numerator / denominator).cast("float")


def cap_age(age: Column) -> Column:
    return F.when(age < 0, 18).when(age > 150, 65).otherwise(age)


def instalments_missed(overdue: Column, due: Column) -> Column:
    """Overdue amount in whole instalments, rounded up; 0 if it cannot be told."""
    known = overdue.isNotNull() & (due > 0)
    return F.when(known, F.ceil(overdue / due)).otherwise(0).cast("int")


def change_share(new: Column, old: Column) -> Column:
    """(new - old) / old, 0 for an old value of 0."""
    return F.when(old == 0, F.lit(0.0)).otherwise((new - old) / old)
