"""The data build: CSV sources to silver tables, label store and feature store."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenorlake import settings
from tenorlake.plans import bronze, gold, silver, specs
from tenorlake.sources import snapshots


@dataclass(frozen=True)
class Layout:
    """Where the layers of a data build lie below one root."""

    root: str

    def bronze(self, name: str) -> str:
        return f"{self.root}/bronze/{name}"

    def silver(self, name: str) -> str:
        return f"{self.root}/silver/{name}"

    def vocabulary(self, name: str) -> str:
        return f"{self.root}/vocabulary/{name}"

    def gold(self, name: str) -> str:
        return f"{self.root}/gold/{name}"


def ingest(spark: SparkSession, sources: Mapping[str, str], layout: Layout, snapshot: str | None = None) -> None:
    """Sources by table name to bronze, all snapshots or one.

    Loans are dated here; the others keep their date as text beside the partition's.
    """
    for name, path in sources.items():
        bronze.ingest(spark, path, layout.bronze(name), snapshot, keep_text=name != "loan_daily")


def refine(
    spark: SparkSession, layout: Layout, as_of: str, snapshot: str | None = None, vocabulary: Iterable[str] | None = None
) -> None:
    """Bronze to silver for every table that is there, all snapshots or one.

    Tokens of a multi-value column get a 0/1 column of their own: those found in the data so far, or those that
    ``vocabulary`` names. All are in an array anyway.
    """
    for name, spec in specs.SPECS.items():
        raw = snapshots.read_optional(spark, layout.bronze(name))
        if raw is None:
            continue
        raw = bronze.of_snapshot(raw, snapshot)
        words = vocabulary if spec.token_column in raw.columns else None
        if words is None and spec.token_column in raw.columns:
            words = silver.grown_vocabulary(raw, spec, layout.vocabulary(name))
        silver.write(silver.process(raw, spec, as_of, words), layout.silver(name), spec, snapshot=snapshot)


def publish(
    spark: SparkSession, layout: Layout, dpd: int = 30, mob: int = 6, latest_only: bool = True,
    encode_before_drop: bool = True, snapshot: str | None = None, days: int = 180,
) -> None:
    """Silver to label store and feature store, all snapshots or one.

    Loans are required, the side tables are not. One snapshot reads its own loans, clicks of
    its window, and what was known of customers by then. ``latest_only`` False gives a row per
    earlier row of the customer, as many as there are of both.
    """
    day = F.lit(snapshot).cast("date")

    def side(name: str, reads: Column | None = None) -> DataFrame | None:
        if snapshots.read_optional(spark, layout.silver(name)) is None:
            return None
        rows = silver.read_kept(spark, layout.silver(name))
        return rows if snapshot is None or reads is None else rows.where(reads)

    at = F.col(snapshots.SNAPSHOT)
    loans = side("loan_daily", at == day)
    if loans is None:
        raise FileNotFoundError(f"no loan table at {layout.silver('loan_daily')}")
    whole = snapshots.only(snapshot)
    snapshots.write_snapshots(gold.labels(loans, dpd, mob), layout.gold("label_store"), replaces=whole)
    clicks = side("clickstream", at.between(F.date_sub(day, days), day))
    features = gold.features(
        loans, side("attributes", at <= day), side("financials", at <= day), clicks, latest_only, encode_before_drop, days
    )
    snapshots.write_snapshots(features, layout.gold("feature_store"), replaces=whole)


def run(
    spark: SparkSession, sources: Mapping[str, str], root: str, as_of: str, snapshot: str | None = None,
    vocabulary: Iterable[str] | None = None, **options,
) -> Layout:
    """Sources to gold in three steps, all snapshots at once or one; ``options`` go to ``publish``."""
    settings.prepare(spark)
    layout = Layout(root.rstrip("/"))
    ingest(spark, sources, layout, snapshot)
    refine(spark, layout, as_of, snapshot, vocabulary)
    publish(spark, layout, snapshot=snapshot, **options)
    return layout
