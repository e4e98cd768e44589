"""Silver: declared types, rules and derived columns, rejected rows set aside."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenorlake.operators import rules, schema
from tenorlake.plans.specs import TableSpec
from tenorlake.sources import snapshots


def process(df: DataFrame, spec: TableSpec, as_of: str, vocabulary: Iterable[str] | None = None) -> DataFrame:
    """Typed, checked and extended rows with their route (see ``rules.route_rows``).

    ``as_of`` is the last accepted date. The tokens of a spec's multi-value column are
    kept as one sorted array, ``<column>_tokens``, whatever their number. ``vocabulary`` names
    tokens that get a 0/1 column besides.
    """
    typed = schema.apply_schema(df, spec.types)
    routed = rules.route_rows(typed, spec.rules(as_of))
    routed = derive(routed, spec)
    routed = rules.route_rows(routed, spec.derived_rules)
    if spec.token_column and spec.token_column in routed.columns:
        routed = schema.with_tokens(routed, spec.token_column, spec.token_part)
        if vocabulary is not None:
            routed = schema.with_token_flags(routed, spec.token_column, vocabulary)
    return routed


def derive(df: DataFrame, spec: TableSpec) -> DataFrame:
    """The derived columns of a spec whose inputs are there."""
    for stage in spec.derived:
        have = set(df.columns)
        columns = {name: build() for name, needs, build in stage if have.issuperset(needs)}
        df = df.withColumns(columns) if columns else df
    return df


def vocabulary(df: DataFrame, spec: TableSpec) -> list[str]:
    """Token vocabulary of a source table, for callers who want a column per token.

    All of it comes to the driver; no plan of this package calls it. The array of
    :func:`process` and ``schema.token_flag_rows`` need no vocabulary.
    """
    tokens = schema.token_vocabulary(df, spec.token_column, spec.token_part)
    return [row.token for row in tokens.orderBy("token").collect()]


#: Tokens that get a column of their own; what a table may hold beyond is in the array alone.
WIDTH = 256


def grown_vocabulary(df: DataFrame, spec: TableSpec, root: str, width: int = WIDTH) -> list[str]:
    """The tokens with a column of their own: those stored below ``root``, then those new in ``df``, which are stored.

    A token keeps its position, so columns of earlier months keep their meaning. New tokens that would make more than
    ``width`` get no column, as the array holds them anyway. The driver gets ``width`` tokens and one more at most.
    """
    spark = df.sparkSession
    found = schema.token_vocabulary(df, spec.token_column, spec.token_part)
    stored = snapshots.read_optional(spark, root)
    known: list[str] = []
    if stored is not None:
        known = [r.token for r in stored.orderBy("position").limit(width).collect()]
        found = found.join(stored, "token", "left_anti")
    fresh = sorted(r.token for r in found.limit(width + 1 - len(known)).collect())
    if not fresh or len(known) + len(fresh) > width:
        return known
    rows = [(t, len(known) + i) for i, t in enumerate(fresh)]
    spark.createDataFrame(rows, "token string, position int").coalesce(1).write.mode("append").parquet(root)
    return known + fresh


def written_rows(routed: DataFrame, spec: TableSpec) -> DataFrame:
    """Kept and quarantined rows with the route, rule and source they are written under.

    A condition on the route would move below the casts and rules and work out a second time what the
    route depends on, so a row is put into an array, or into none, and taken out again.
    """
    route = F.coalesce(F.col(rules.ROUTE), F.lit("keep"))
    rows = routed.withColumns({"route": route, "rule": F.col(rules.ROUTE_RULE), "source": F.lit(spec.name)})
    rows = rows.drop(rules.ROUTE, rules.ROUTE_RULE)
    row = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
    return rows.select(F.inline(F.when(F.col("route").isin("keep", "quarantine"), F.array(row))))


def write(routed: DataFrame, root: str, spec: TableSpec, by: str = snapshots.SNAPSHOT, snapshot: str | None = None) -> None:
    """Write kept and quarantined rows in one pass, below ``route=keep`` and ``route=quarantine``.

    The rows stand for ``snapshot``, or for the whole table: former rows of either route
    that have no successor are gone afterwards. Dropped and lost rows are not written.
    """
    snapshots.write_snapshots(written_rows(routed, spec), root, ("route", by), snapshots.only(snapshot, by))


def _read(spark: SparkSession, root: str, route: str) -> DataFrame:
    """One route with the columns of all snapshots; a token column a snapshot did not have yet is 0 there."""
    snapshots.finish(spark, root)
    rows = spark.read.option("mergeSchema", True).parquet(root).where(F.col("route") == route)
    flags = [c for c, kind in rows.dtypes if c.startswith("has_") and kind == "int"]
    return rows.fillna(0, flags) if flags else rows


def read_kept(spark: SparkSession, root: str) -> DataFrame:
    return _read(spark, root, "keep").drop("route", "rule", "source")


def read_quarantine(spark: SparkSession, root: str) -> DataFrame:
    return _read(spark, root, "quarantine").drop("route")
