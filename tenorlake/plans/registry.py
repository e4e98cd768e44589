"""Model registry: versions are only added, with what they were made from; a pointer says which one is in use.

A version is saved first and then counts by one small file, so a save that stops half-way is no version. The pointer is a
list of moves, each a file of its own: promotions, which the promotion check must allow, and roll-backs. Nothing is ever
overwritten, so the list tells at any time which version was in use, since when and why.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenorlake.plans import training
from tenorlake.sources import marks

HISTORY = "model_id string, move int, action string, version int, moved_at string"
VERSIONS = "model_id string, version int, inputs map<string,string>, registered_at string"
PROMOTED, ROLLED_BACK = "promoted", "rolled_back"


@dataclass(frozen=True)
class Move:
    action: str
    version: int
    moved_at: str


def register(spark: SparkSession, trained: training.Trained, root: str, inputs: Mapping[str, str] | None = None) -> int:
    """Save the model as the next version and return its number; ``inputs`` says which snapshots and tables it saw."""
    base = _base(root, trained.model_id)
    number = 1
    while not marks.put(spark, f"{base}/_taken/{number:06d}.json", {}):  # a number is taken once, also by a save that stops
        number += 1
    training.save_at(trained, _folder(base, number))
    marks.put(spark, f"{base}/_versions/{number:06d}.json", {"inputs": dict(inputs or {}), "registered_at": _now()})
    return number


def versions(spark: SparkSession, root: str, model_id: str) -> DataFrame:
    """One row per registered version."""
    base = _base(root, model_id)
    found = [(n, marks.get(spark, f"{base}/_versions/{n}.json")) for n in marks.names(spark, f"{base}/_versions")]
    return spark.createDataFrame([(model_id, int(n), v["inputs"], v["registered_at"]) for n, v in found], VERSIONS)


def records(spark: SparkSession, root: str, model_id: str) -> DataFrame:
    """Registry rows (metrics, windows, parameters) of all versions, to compare candidates."""
    base = _base(root, model_id)
    known = versions(spark, root, model_id)
    paths = [f"{_folder(base, r.version)}/record" for r in known.select("version").collect()]
    if not paths:
        raise LookupError(f"no version of {model_id} at {root}")
    number = F.regexp_extract(F.input_file_name(), r"/version=(\d+)/", 1).cast("int")
    return spark.read.option("mergeSchema", True).parquet(*paths).withColumn("version", number).join(known, ["model_id", "version"])


def load(spark: SparkSession, root: str, model_id: str, version: int | None = None) -> training.Saved:
    """A version, or the one in use."""
    base = _base(root, model_id)
    version = current(spark, root, model_id) if version is None else version
    if version is None:
        raise LookupError(f"no version of {model_id} is in use at {root}")
    if marks.get(spark, f"{base}/_versions/{version:06d}.json") is None:
        raise LookupError(f"{model_id} has no version {version} at {root}")
    return training.load_at(spark, _folder(base, version))


def current(spark: SparkSession, root: str, model_id: str) -> int | None:
    """The version in use."""
    used = _in_use(_moves(spark, root, model_id))
    return used[-1] if used else None


def promote(spark: SparkSession, root: str, model_id: str, version: int) -> bool:
    """Put a version in use if the promotion check allows it against the one in use now; returns whether it did."""
    moves = _moves(spark, root, model_id)
    used = _in_use(moves)
    if used and used[-1] == version:
        return True
    incumbent = load(spark, root, model_id, used[-1]).record if used else None
    allowed = training.promotion_check(load(spark, root, model_id, version).record, incumbent).select("promote").first()[0]
    return allowed and _move(spark, root, model_id, len(moves), PROMOTED, version)


def roll_back(spark: SparkSession, root: str, model_id: str) -> int:
    """Put the version in use before the present one back and return its number; it was allowed once, so it isn't checked."""
    moves = _moves(spark, root, model_id)
    used = _in_use(moves)
    if len(used) < 2:
        raise LookupError(f"{model_id} has no earlier version to go back to at {root}")
    if not _move(spark, root, model_id, len(moves), ROLLED_BACK, used[-2]):
        raise RuntimeError(f"the version in use of {model_id} was moved by another run")
    return used[-2]


def history(spark: SparkSession, root: str, model_id: str) -> DataFrame:
    """Every move of the pointer in order."""
    moves = _moves(spark, root, model_id)
    return spark.createDataFrame([(model_id, i, m.action, m.version, m.moved_at) for i, m in enumerate(moves)], HISTORY)


def _in_use(moves: list[Move]) -> list[int]:
    """Versions in use one after the other, roll-backs taken off."""
    used: list[int] = []
    for move in moves:
        if move.action == PROMOTED:
            used.append(move.version)
        else:
            used.pop()
    return used


def _moves(spark: SparkSession, root: str, model_id: str) -> list[Move]:
    folder = f"{_base(root, model_id)}/_moves"
    return [Move(**marks.get(spark, f"{folder}/{n}.json")) for n in marks.names(spark, folder)]


def _move(spark: SparkSession, root: str, model_id: str, number: int, action: str, version: int) -> bool:
    """False if another run has made this move first."""
    place = f"{_base(root, model_id)}/_moves/{number:06d}.json"
    return marks.put(spark, place, {"action": action, "version": version, "moved_at": _now()})


def _base(root: str, model_id: str) -> str:
    return f"{root.rstrip('/')}/{model_id}"


def _folder(base: str, number: int) -> str:
    return f"{base}/version={number}"


def _now() -> str:
    return dt.datetime.now(dt.UTC).isoformat(timespec="microseconds")
