"""Small files that are written once: claims, versions, pointers. Rows never go through here."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, place: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(place)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def put(spark: SparkSession, place: str, content: dict) -> bool:
    """Make the file, whole, unless it exists; returns whether it was made.

    Of several writers one wins where a rename never overwrites, as on HDFS; on a local disk have one writer at a time.
    """
    fs, path = _at(spark, place)
    if fs.exists(path):
        return False
    _, hidden = _at(spark, f"{path.getParent()}/.{uuid.uuid4().hex}")
    out = fs.create(hidden, True)
    try:
        out.write(json.dumps(content, sort_keys=True).encode())
    finally:
        out.close()
    if fs.rename(hidden, path):
        return True
    fs.delete(hidden, False)
    return False


def get(spark: SparkSession, place: str) -> dict | None:
    """What the file holds, or None without one."""
    fs, path = _at(spark, place)
    if not fs.exists(path):
        return None
    read = fs.open(path)
    try:
        return json.loads(bytes(read.readAllBytes()))
    finally:
        read.close()


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files in the folder, without suffix, in order."""
    fs, path = _at(spark, folder)
    if not fs.exists(path):
        return []
    found = (f.getPath().getName() for f in fs.listStatus(path))
    return sorted(n.removesuffix(".json") for n in found if n.endswith(".json") and not n.startswith("."))


def remove(spark: SparkSession, place: str) -> None:
    fs, path = _at(spark, place)
    fs.delete(path, False)
