"""Projections: declared casts, alignment, exclusions, data-dependent columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenorlake.functions import dates, numeric, text

CASTS = {
    "int": numeric.clean_int,
    "float": lambda c: numeric.to_float(text.clean_number(c)),
    "date": dates.parse_date,
    "string": lambda c: c.cast("string"),
}


def apply_schema(df: DataFrame, types: Mapping[str, str], audit: bool = True) -> DataFrame:
    """Cast the declared columns that are present, in one projection.

    Numbers are cleaned first and, with ``audit``, keep their raw value in
    ``<column>_original``. Text that cannot be cast becomes null.
    """
    have = dict(df.dtypes)
    unknown = {t for t in types.values() if t not in CASTS}
    if unknown:
        raise ValueError(f"unknown column types: {sorted(unknown)}")
    columns, originals = [], []
    for name in df.columns:
        kind = types.get(name)
        same = kind is None or (kind == "date" and have[name] == "date")  # a date needs no way through text
        columns.append(F.col(name) if same else CASTS[kind](F.col(name)).alias(name))
        if audit and kind in ("int", "float"):
            originals.append(F.col(name).alias(f"{name}_original"))
    return df.select(*columns, *originals)


def keep_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """The named columns that exist, in the order asked for."""
    return df.select([n for n in names if n in df.columns])


def drop_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return df.drop(*names)


def without_overlap(right: DataFrame, left: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Right side of a join without the columns the left side already has."""
    return right.select([c for c in right.columns if c in keys or c not in left.columns])


def with_literals(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Add metadata columns; values may be plain values or columns."""
    return df.withColumns({k: v if isinstance(v, Column) else F.lit(v) for k, v in values.items()})


def align_features(df: DataFrame, features: Sequence[str], ids: Sequence[str] = ()) -> DataFrame:
    """Ids and features in trained order; absent features become null doubles."""
    null = F.lit(None).cast("double")
    present = set(df.columns)
    return df.select(*ids, *[F.col(f) if f in present else null.alias(f) for f in features])


def numeric_features(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Every feature as a double."""
    types = dict(df.dtypes)
    wanted = set(features)
    return df.select(
        [numeric.to_number(F.col(c), types[c]).alias(c) if c in wanted else F.col(c) for c in df.columns]
    )


def token_vocabulary(df: DataFrame, column: str, must_contain: str | None = None) -> DataFrame:
    """Distinct tokens of a multi-value text column, as a one-column table.

    Texts are made distinct first, so that only different texts are split.
    """
    texts = df.select(column).where(F.col(column).isNotNull()).distinct()
    return texts.select(F.explode(text.tokens(F.col(column), must_contain)).alias("token")).distinct()


def with_tokens(df: DataFrame, column: str, must_contain: str | None = None, any_name: str | None = "has_any_loan") -> DataFrame:
    """The distinct tokens of each text as a sorted array, and 0/1 for any useful text."""
    value = F.col(column)
    tokens = F.array_sort(F.array_distinct(text.tokens(value, must_contain)))
    added = {f"{column}_tokens": F.coalesce(tokens, F.array().cast("array<string>"))}
    if any_name:
        added[any_name] = F.when(text.is_useful(value), 1).otherwise(0)
    return df.withColumns(added)


def with_token_flags(
    df: DataFrame, column: str, vocabulary: Iterable[str], any_name: str | None = "has_any_loan"
) -> DataFrame:
    """One 0/1 column per vocabulary token, plus one for any useful text."""
    value = F.col(column)
    flags = {text.token_column(t): text.has_token(value, t) for t in sorted(set(vocabulary))}
    if any_name:
        flags[any_name] = F.when(text.is_useful(value), 1).otherwise(0)
    return df.withColumns(flags)


def token_flag_rows(
    df: DataFrame, key: str, column: str, must_contain: str | None = None
) -> DataFrame:
    """Long form of the token flags, (key, token): needs no vocabulary at all.

    Use it instead of ``with_token_flags`` where the vocabulary may grow with
    the data; one row per token really found.
    """
    found = F.explode(text.tokens(F.col(column), must_contain))
    return df.where(F.col(column).isNotNull()).select(key, found.alias("token"))
