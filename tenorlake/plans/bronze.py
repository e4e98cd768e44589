"""Bronze: source rows as text, with the snapshot date parsed and filtered."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenorlake.functions import dates
from tenorlake.sources import snapshots

PART_DATE = "part_date"


def snapshot_rows(df: DataFrame, snapshot: str | None = None, date_column: str | None = "snapshot_date") -> DataFrame:
    """Rows of one snapshot, or of all of them with the date parsed.

    A table without that column, or ``date_column`` None, passes through.
    """
    if date_column is None or date_column not in df.columns:
        return df
    parsed = df.withColumn(date_column, dates.parse_date(F.col(date_column), dates.BRONZE_FORMATS, fallback=False))
    return parsed if snapshot is None else parsed.where(F.col(date_column) == F.lit(snapshot).cast("date"))


def ingest(
    spark: SparkSession, source: str, root: str, snapshot: str | None = None, date_column: str | None = "snapshot_date",
    keep_text: bool = False,
) -> DataFrame:
    """Read a CSV source and write it below ``root``, by snapshot where it is dated.

    All months go through in one job unless ``snapshot`` picks one. With ``keep_text`` the date stays the
    text it is, in any of the formats silver reads, and partitions follow a column ``part_date`` beside it.
    """
    raw = snapshots.read_csv(spark, source)
    if keep_text and date_column in raw.columns:
        rows = raw.withColumn(PART_DATE, dates.parse_date(F.col(date_column)))
        rows = rows if snapshot is None else rows.where(F.col(PART_DATE) == F.lit(snapshot).cast("date"))
        snapshots.write_snapshots(rows, root, (PART_DATE,), snapshots.only(snapshot, PART_DATE))
        return rows
    rows = snapshot_rows(raw, snapshot, date_column)
    if date_column and date_column in rows.columns:
        snapshots.write_snapshots(rows, root, (date_column,), snapshots.only(snapshot, date_column))
    else:
        rows.write.mode("overwrite").parquet(root)
    return rows


def of_snapshot(rows: DataFrame, snapshot: str | None = None, date_column: str = "snapshot_date") -> DataFrame:
    """Bronze rows as they came in, all of them or those of one snapshot's partition."""
    by = PART_DATE if PART_DATE in rows.columns else date_column
    if snapshot is not None and by in rows.columns:
        rows = rows.where(F.col(by) == F.lit(snapshot).cast("date"))
    return rows.drop(PART_DATE)
