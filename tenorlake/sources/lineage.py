"""Cutting lineage with a written table, for plans read many times over."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
WAREHOUSE = "spark.sql.warehouse.dir"


def shared_folder(spark: SparkSession, folder: str | None = None) -> str:
    """A folder all executors see: the one given, that of the checkpoint setting, or the warehouse.

    A warehouse on a local disk is shared only where driver and executors are one process;
    elsewhere it is an error.
    """
    folder = folder or spark.conf.get(SETTING, None) or spark.sparkContext.getConf().get(SETTING)
    if folder:
        return folder.rstrip("/")
    warehouse = spark.conf.get(WAREHOUSE, None) or ""
    alone = spark.sparkContext.master.split("[")[0] == "local"
    if warehouse and (alone or not warehouse.startswith(("file:", "/"))):
        return f"{warehouse.rstrip('/')}/_settled"
    raise ValueError(f"set {SETTING} to a folder that driver and executors share")


def fresh_path(spark: SparkSession, name: str = "table", folder: str | None = None) -> str:
    return f"{shared_folder(spark, folder)}/{name}-{uuid.uuid4().hex}"


def settled(df: DataFrame, name: str = "table", folder: str | None = None) -> DataFrame:
    """Write the rows as a table below the shared folder and read them from there.

    Unlike cached blocks the table outlives lost executors, and later reads still
    prune columns and push filters down. It stays until :func:`discard` removes it.
    """
    path = fresh_path(df.sparkSession, name, folder)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Remove the files of a settled table; reading it afterwards fails."""
    spark = table.sparkSession
    for folder in {file.rpartition("/")[0] for file in table.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
