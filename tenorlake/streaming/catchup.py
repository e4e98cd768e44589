"""Monthly catch-up: bring in the source files that have arrived since the last run."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tenorlake.plans import bronze
from tenorlake.sources import snapshots


def token(progress: str, batch: int) -> str:
    """The name under which the table takes a batch of the stream."""
    return f"{hashlib.sha256(progress.rstrip('/').encode()).hexdigest()[:16]}-{batch}"


def ingest_new_files(
    spark: SparkSession, source: str, columns: Sequence[str], root: str, progress: str,
    date_column: str = "snapshot_date", max_files: int = 1_000,
) -> StreamingQuery:
    """Append every CSV file below ``source`` not seen before to the bronze table, then stop.

    The table is the one ``bronze.ingest`` writes: both may share ``root``. ``progress`` is the checkpoint directory, on
    storage all executors see. A run that is cut short and repeated brings its last batch again under the same number, and
    the table takes each (progress directory, number) once. So keep ``progress``: a new one reads all files anew.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    files = (
        spark.readStream.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("maxFilesPerTrigger", max_files)
        .csv(source)
    )
    def add(rows: DataFrame, batch: int) -> None:
        snapshots.append_snapshots(rows, root, token(progress, batch), (date_column,))

    rows = bronze.snapshot_rows(files, None, date_column)
    return rows.writeStream.foreachBatch(add).option("checkpointLocation", progress).trigger(availableNow=True).start()
