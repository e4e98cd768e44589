"""Snapshot tables: one directory per table, partitioned by date.

Partition pruning takes the place of dates in file names. A rewrite replaces
the partitions it has rows for and removes those others that it says it stands for, so
running a month again is safe even if rows have changed sides or are gone.

A write has one moment at which it counts. Its rows are written once, to a folder below the table that readers
don't see; then one small file, renamed into place, says which partitions they replace and which go; then folders are
renamed, without a Spark job. A write that stops before that file is as if it had never been. One that stops after it
is finished by whoever reads (through this module) or writes the table next. So the rows may come from the table they
replace. Renaming must be cheap, as it is on HDFS and local disks.

An append is committed in the same way, but its files join those of their partitions. It carries a name the caller
chooses, and a table takes each name once.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import asdict, dataclass, replace
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SNAPSHOT = "snapshot_date"


def read_csv(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Header CSV, every column as text; types are declared later.

    Without ``columns`` only the header is looked at, so there is no pass over
    the data to infer types.
    """
    reader = spark.read.option("header", True).option("enforceSchema", False)
    if columns:
        schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
        return reader.schema(schema).csv(path)
    return reader.csv(path)


def read_snapshots(
    spark: SparkSession, root: str, on: str | None = None, up_to: str | None = None, by: str = SNAPSHOT
) -> DataFrame:
    """A partitioned table, all of it, one snapshot, or those up to a cutoff."""
    finish(spark, root)
    df = spark.read.parquet(root)
    if on:
        df = df.where(F.col(by) == F.lit(on).cast("date"))
    if up_to:
        df = df.where(F.col(by) <= F.lit(up_to).cast("date"))
    return df


def read_glob(spark: SparkSession, pattern: str) -> DataFrame:
    """All files of a path pattern as one table, columns merged by name."""
    return spark.read.option("mergeSchema", True).parquet(pattern)


def read_optional(spark: SparkSession, root: str) -> DataFrame | None:
    """The table, or None where its path does not exist."""
    finish(spark, root)
    try:
        return spark.read.parquet(root)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def write_snapshots(
    df: DataFrame, root: str, by: Sequence[str] = (SNAPSHOT,), replaces: Column | None = None, token: str | None = None
) -> bool:
    """Replace the partitions present in ``df``, and remove the others that ``replaces`` holds for.

    ``replaces`` is a condition on the partition columns: true for the whole table, a date for one
    snapshot, None for no partition beyond those present. The rebalance hint gathers each partition
    value into files of the advisory size and splits a large one over several tasks. With ``token`` the
    write happens once: a repeated one isn't evaluated. Returns whether the rows were written.
    """
    return _write(df, root, token, lambda: stage(df, root, by, replaces))


def only(snapshot: str | None, by: str = SNAPSHOT) -> Column:
    """Which partitions a run stands for: those of its snapshot, or all."""
    return F.lit(True) if snapshot is None else F.col(by) == F.lit(snapshot).cast("date")


STAGED, COMMITS, TOKENS = "_staged", "_commits", "_tokens"
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class Staged:
    """A write that doesn't count yet: its folder, the partitions in it, and those that go without a successor."""

    name: str
    fresh: list[str]
    stale: list[str]
    joins: bool = False  # files join those of their partitions
    token: str | None = None


def append_snapshots(df: DataFrame, root: str, token: str, by: Sequence[str] = (SNAPSHOT,)) -> bool:
    """Add rows to their partitions, once per ``token``: a batch that comes again adds nothing and isn't evaluated.

    Returns whether the rows were added. One writer at a time may use a token.
    """
    return _write(df, root, token, lambda: replace(stage(df, root, by), joins=True))


def taken(spark: SparkSession, root: str, token: str) -> bool:
    """Whether a write with this token counts; one that was committed and not put into place yet does."""
    finish(spark, root)
    fs, path = _file_system(spark, root)
    return fs.exists(path(f"{root.rstrip('/')}/{TOKENS}/{token}"))


def _write(df: DataFrame, root: str, token: str | None, staged: Callable[[], Staged]) -> bool:
    spark = df.sparkSession
    if token is not None and taken(spark, root, token):
        return False
    commit(spark, root, replace(staged(), token=token))
    finish(spark, root)
    return True


def stage(df: DataFrame, root: str, by: Sequence[str] = (SNAPSHOT,), replaces: Column | None = None) -> Staged:
    """Write the rows where readers don't see them; ``df`` is evaluated here and nowhere else."""
    spark, root = df.sparkSession, root.rstrip("/")
    finish(spark, root)
    name = uuid.uuid4().hex
    folder = f"{root}/{STAGED}/{name}"
    df.hint("rebalance", *by).write.partitionBy(*by).parquet(folder)
    fresh = _partitions(spark, folder, len(by))
    there = _partitions(spark, root, len(by))
    stale = [] if replaces is None else _held(spark, sorted(set(there) - set(fresh)), df.select(*by).schema, replaces)
    if stale and not fresh and len(stale) == len(there):  # the last partition stays, without rows: the table keeps its columns
        df.drop(*by).limit(0).write.parquet(f"{folder}/{stale[0]}")
        fresh, stale = stale[:1], stale[1:]
    return Staged(name, fresh, stale)


def commit(spark: SparkSession, root: str, staged: Staged) -> None:
    """From here on the write counts."""
    root = root.rstrip("/")
    fs, path = _file_system(spark, root)
    hidden, final = path(f"{root}/{COMMITS}/.{staged.name}"), path(f"{root}/{COMMITS}/{staged.name}.json")
    out = fs.create(hidden, True)
    try:
        out.write(json.dumps(asdict(staged)).encode())
    finally:
        out.close()
    if not fs.rename(hidden, final):
        raise OSError(f"can't rename to {final}")


def finish(spark: SparkSession, root: str) -> None:
    """Put the folders of committed writes into place, in order of their commits. Running it again changes nothing."""
    root = root.rstrip("/")
    if any(c in root for c in "*?[{"):
        return  # a pattern is no table
    fs, path = _file_system(spark, root)
    if not fs.exists(path(f"{root}/{COMMITS}")):
        return
    pending = sorted((f.getModificationTime(), f.getPath().getName()) for f in fs.listStatus(path(f"{root}/{COMMITS}")) if f.getPath().getName().endswith(".json"))
    for _, file in pending:
        record = path(f"{root}/{COMMITS}/{file}")
        read = fs.open(record)
        try:
            staged = Staged(**json.loads(bytes(read.readAllBytes())))
        finally:
            read.close()
        for partition in staged.stale:
            fs.delete(path(f"{root}/{partition}"), True)
        for partition in staged.fresh:
            new, old = path(f"{root}/{STAGED}/{staged.name}/{partition}"), path(f"{root}/{partition}")
            if not fs.exists(new):  # it has moved already
                continue
            if staged.joins:
                _join_files(fs, path, new, old)
            else:
                fs.delete(old, True)
                fs.mkdirs(old.getParent())
                if not fs.rename(new, old):
                    raise OSError(f"can't rename to {old}")
        if staged.token is not None:
            fs.create(path(f"{root}/{TOKENS}/{staged.token}"), True).close()
        fs.delete(record, False)
        fs.delete(path(f"{root}/{STAGED}/{staged.name}"), True)
    spark.catalog.refreshByPath(root)


def _join_files(fs, path, new, old) -> None:
    """Move the files of one folder to another; those of an earlier, unfinished attempt are there already."""
    fs.mkdirs(old)
    for file in fs.listStatus(new):
        source = file.getPath()
        if source.getName().startswith("part-") and not fs.rename(source, path(old, source.getName())):
            raise OSError(f"can't move {source} to {old}")


def _file_system(spark: SparkSession, root: str):
    path = spark._jvm.org.apache.hadoop.fs.Path
    return path(root).getFileSystem(spark._jsc.hadoopConfiguration()), path


def _partitions(spark: SparkSession, root: str, depth: int) -> list[str]:
    """Partition folders below a table, as they are named there."""
    fs, path = _file_system(spark, root)
    found = [""]
    for _ in range(depth):
        found = [
            f"{above}{f.getPath().getName()}/"
            for above in found
            if fs.exists(path(f"{root}/{above}"))
            for f in fs.listStatus(path(f"{root}/{above}"))
            if f.isDirectory() and "=" in f.getPath().getName()
        ]
    return [f.rstrip("/") for f in found]


def _held(spark: SparkSession, partitions: list[str], schema: T.StructType, condition: Column) -> list[str]:
    """Those partitions whose values the condition holds for."""
    if not partitions:
        return []
    values = [[unquote(level.partition("=")[2]) for level in p.split("/")] for p in partitions]
    rows = [(p, *[None if v == NULL_PARTITION else v for v in own]) for p, own in zip(partitions, values, strict=True)]
    names = T.StructType([T.StructField("_partition", T.StringType()), *[T.StructField(f.name, T.StringType()) for f in schema]])
    typed = spark.createDataFrame(rows, names).select("_partition", *[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
    return [r[0] for r in typed.where(condition).select("_partition").collect()]  # partitions, not rows


def write_csv_snapshots(df: DataFrame, root: str, by: Sequence[str] = (SNAPSHOT,)) -> None:
    _partitioned(df, by).option("header", True).csv(root)


def _partitioned(df: DataFrame, by: Sequence[str]):
    writer = df.hint("rebalance", *by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    return writer.partitionBy(*by)


def write_quarantine(rejected: DataFrame, root: str, source: str, by: str = SNAPSHOT, snapshot: str | None = None) -> None:
    """Rejected rows under (source, rule, snapshot), in place of the source's former ones.

    With ``snapshot`` only those of that date are replaced. Rows without a snapshot date land in the null partition.
    """
    rows = rejected.withColumn("source", F.lit(source))
    write_snapshots(rows, root, ("source", "rule", by), (F.col("source") == source) & only(snapshot, by))


def list_tables(spark: SparkSession, base: str) -> DataFrame:
    """Parquet tables below a directory with their file count and size.

    Only file names and lengths are read. A table is the part of the path before
    the first partition directory, or the ``.parquet`` directory itself.
    """
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(base)
    )
    relative = F.regexp_replace(F.substring_index(F.col("path"), base.rstrip("/") + "/", -1), "/[^/]+=.*$", "")
    table = F.regexp_replace(relative, r"(\.parquet)/.*$", "$1")
    named = files.select(F.regexp_replace(table, r"/part-[^/]*$", "").alias("table_name"), "length")
    return named.groupBy("table_name").agg(F.count(F.lit(1)).alias("n_files"), F.sum("length").alias("n_bytes"))


def inspect_table(df: DataFrame, expected: Iterable[str] = ()) -> DataFrame:
    """One row per column: type, whether it was expected, filled values and rows.

    Expected columns that are missing are listed with a null type.
    """
    expected = list(expected)
    types = dict(df.dtypes)
    names = [*df.columns, *[c for c in expected if c not in types]]
    counts = [F.count(c).alias(f"_{i}") for i, c in enumerate(df.columns)]
    one = df.agg(F.count(F.lit(1)).alias("n_rows"), *counts)
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(types.get(c)).cast("string").alias("data_type"),
            F.lit(c in types).alias("is_present"),
            F.lit(c in expected).alias("is_expected"),
            (F.col(f"_{i}") if c in types else F.lit(None)).cast("bigint").alias("n_filled"),
        )
        for i, c in enumerate(names)
    ]
    return one.select("n_rows", F.inline(F.array(*rows)))
