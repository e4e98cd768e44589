"""Lines that several documents hold, kept in one of them.

1. Tasks hash the keys of their lines, each key once per document, and add hashes up before they send them: eight
   bytes per line, dealt over shards of the hash space. There are as many shards as the lines need.
2. A shard has two Bloom filters. A hash that isn't in the once-seen one is put there, a hash that is, or that a task has seen in
   two documents, goes into the twice-seen one. The once-seen filter never leaves its task; the twice-seen one is
   folded to the size its few hashes need.
3. Twice-seen filters travel to all tasks. Only lines found in them are suspected: a document without any is left
   where it is. Of the others, keys alone are shuffled, counted exactly (per task first) and joined back, and
   those documents are rewritten that lose lines.

Filters never miss a repeated line, so the result is exact; a false suspicion costs a row of a shuffle. What travels is checked:
beyond ``LIMIT`` bytes in all, only filters of the first shards that fit are sent, and every line of the other
shards counts as suspected.

A key is the line without white space at its ends, A-Z in lower case. Keys of ``LEAST`` code points or more that ``DOCUMENTS``
documents hold lose all their lines except in the document with the largest id.

Defined results: a null or empty text is one empty line. Each row is a document of its own; rows that share the largest
id all keep the line. A null id is smaller than all others. Rows stay as many as they are; an empty table gives no rows; extra
columns stay out.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenorlake.llm.common import slices
from tenorlake.sources import lineage

LEAST, DOCUMENTS = 20, 3
#: Lines of a shard; the least number of shards, so that small tables are spread as well.
SHARD_LINES, SHARDS = 1 << 20, 64
#: Bits of a once-seen filter per line, and of a twice-seen one per hash in it.
BITS, FOLDED_BITS, PROBES = 8, 12, 3
#: Hashes a task holds before it sends them.
HELD = 1 << 20
#: Bytes of all filters that may travel to the tasks.
LIMIT = 128 << 20


def keys(text: bytes | None, least: int = LEAST) -> list[bytes | None]:
    """The key of each line, None where it is too short to count."""
    out: list[bytes | None] = []
    for line in (text or b"").split(b"\n"):
        key = line.strip().lower()
        long_enough = len(key) >= least and (len(key) >= 4 * least or len(key.decode()) >= least)
        out.append(key if long_enough else None)
    return out


def hashes(own: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, own), np.uint64, len(own))


def shard_of(found: np.ndarray, shards: int) -> np.ndarray:
    return ((found >> np.uint64(40)) % np.uint64(shards)).astype(np.int64)


def probes(found: np.ndarray) -> np.ndarray:
    """Places of each hash, to be cut to the size of a filter."""
    low, high = found & np.uint64(0xFFFFFFFF), (found >> np.uint64(32)) | np.uint64(1)
    return np.stack([low + np.uint64(i) * high for i in range(PROBES)])


def holds(bits: np.ndarray, places: np.ndarray) -> np.ndarray:
    return bits[places & np.uint64(len(bits) - 1)].all(axis=0)


def holds_packed(packed: np.ndarray, places: np.ndarray) -> np.ndarray:
    """:func:`holds` of a filter with eight bits to the byte."""
    at = places & np.uint64(8 * len(packed) - 1)
    return (packed[at >> np.uint64(3)] >> (7 - (at & np.uint64(7)).astype(np.uint8)) & 1).all(axis=0)


def folded(bits: np.ndarray, hashes_in: int) -> np.ndarray:
    """A filter of half the size, and again, while it has more bits than it needs: the halves laid over each other."""
    while len(bits) > 64 and len(bits) // 2 >= FOLDED_BITS * hashes_in:
        bits = bits[: len(bits) // 2] | bits[len(bits) // 2 :]
    return bits


def _sending(shards: int, least: int) -> Callable:
    """Texts to (shard, hashes seen in one document of the task, hashes seen in more)."""
    names = ["shard", "once", "more"]

    def sent(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        own, n = np.unique(np.concatenate(held), return_counts=True)
        shard = shard_of(own, shards)
        order = np.argsort(shard, kind="stable")
        own, n, shard = own[order], n[order], shard[order]
        cuts = [*np.flatnonzero(np.diff(shard, prepend=-1)).tolist(), len(shard)]
        spans = list(zip(cuts, cuts[1:], strict=False))
        for i in range(0, len(spans), 1024):
            part = spans[i : i + 1024]
            columns = [
                pa.array([int(shard[a]) for a, _ in part], pa.int64()),
                pa.array([own[a:z][n[a:z] == 1].tobytes() for a, z in part], pa.binary()),
                pa.array([own[a:z][n[a:z] > 1].tobytes() for a, z in part], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0
        for batch in slices(batches):
            for text in batch.column(0).cast(pa.binary()):
                own = {k for k in keys(text.as_py(), least) if k is not None}
                if own:
                    held.append(hashes(list(own)))
                    size += len(own)
            if size >= HELD:
                yield from sent(held)
                held, size = [], 0
        if held:
            yield from sent(held)

    return run


def _filtering(bits: int) -> Callable:
    """Hashes in order of shards to (shard, twice-seen filter)."""
    names = ["shard", "bits"]

    def packed(shard: int, twice: np.ndarray, n: int) -> pa.RecordBatch:
        filter_ = zlib.compress(np.packbits(folded(twice, n)).tobytes(), 1)
        return pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), pa.array([filter_], pa.binary())], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = None
        for batch in slices(batches, 64):
            for of, single, several in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if of != shard:
                    if shard is not None:
                        yield packed(shard, twice, n)
                    shard, once, twice, n = of, np.zeros(bits, dtype=bool), np.zeros(bits, dtype=bool), 0
                for found, more in ((np.frombuffer(single, np.uint64), False), (np.frombuffer(several, np.uint64), True)):
                    places = probes(found)
                    again = holds(once, places) | more
                    n += int((again & ~holds(twice, places)).sum())
                    twice[places[:, again] & np.uint64(bits - 1)] = True
                    once[places & np.uint64(bits - 1)] = True
        if shard is not None:
            yield packed(shard, twice, n)

    return run


def _suspecting(sent, shards: int, upto: int, least: int) -> Callable:
    """(doc_id, text) with the keys suspected in it. Shards from ``upto`` on have no filter here."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = {}
        for batch in slices(batches):
            out = []
            for text in batch.column(1).cast(pa.binary()):
                own = list(dict.fromkeys(k for k in keys(text.as_py(), least) if k is not None))
                found = hashes(own)
                shard, places = shard_of(found, shards), probes(found)
                suspected = shard >= upto
                for s in np.unique(shard[~suspected]).tolist():
                    if s not in filters:
                        packed = sent.value.get(s)
                        filters[s] = None if packed is None else np.frombuffer(zlib.decompress(packed), np.uint8)
                    if filters[s] is not None:
                        here = shard == s
                        suspected[here] = holds_packed(filters[s], places[:, here])
                out.append([own[i].decode() for i in np.flatnonzero(suspected)] or None)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.list_(pa.string()))], names=["doc_id", "text", "suspected"])

    return run


def _rewriting(least: int) -> Callable:
    """(doc_id, text, keys that go) to the text without their lines, the lines there were and those that went."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts, lines, dropped = [], [], []
            for text, gone in zip(batch.column(1).cast(pa.binary()), batch.column(2), strict=True):
                text, gone = text.as_py() or b"", {k.encode() for k in gone.as_py() or ()}
                all_ = text.split(b"\n")
                kept = [line for line, key in zip(all_, keys(text, least), strict=True) if key is None or key not in gone] if gone else all_
                texts.append(b"\n".join(kept).decode())
                lines.append(len(all_))
                dropped.append(len(all_) - len(kept))
            columns = [batch.column(0), pa.array(texts, pa.string()), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text", "n_lines", "n_dropped"])

    return run


def twice_seen(texts: DataFrame, shards: int, least: int = LEAST, shard_lines: int = SHARD_LINES) -> DataFrame:
    """(shard, bits): the filters of hashes that two documents hold, or that look so."""
    bits = 1 << (BITS * shard_lines - 1).bit_length()
    sent = texts.mapInArrow(_sending(shards, least), "shard long, once binary, more binary")
    return sent.repartition("shard").sortWithinPartitions("shard").mapInArrow(_filtering(bits), "shard long, bits binary")


def suspects(docs: DataFrame, filters: DataFrame, shards: int, least: int = LEAST, limit: int = LIMIT) -> DataFrame:
    """(doc_id, text, suspected keys) of all documents; null where there are none."""
    size = filters.agg(F.sum(F.length("bits")).alias("size")).first().size or 0
    upto = shards if size <= limit else shards * limit // size
    sent = docs.sparkSession.sparkContext.broadcast({r.shard: bytes(r.bits) for r in filters.where(F.col("shard") < upto).collect()})
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_suspecting(sent, shards, upto, least), f"doc_id {kind}, text string, suspected array<string>")


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, documents: int = DOCUMENTS) -> DataFrame:
    """doc_id, text without the dropped lines, n_lines before and n_dropped; one row per document."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    lines = docs.agg(F.sum(F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1).alias("n")).first().n or 0
    shards = max(SHARDS, -(-lines // SHARD_LINES))
    filters = lineage.settled(twice_seen(docs.select("text"), shards, least, -(-max(lines, 1) // shards)), "twice-seen")
    found = suspects(docs, filters, shards, least).withColumn("row", F.monotonically_increasing_id())
    found = lineage.settled(found, "suspects")
    held = found.where("suspected is not null").select("row", "doc_id", F.explode("suspected").alias("key"))
    # Counted per task first; a key in a third of all documents is a third of one side of the join, which Spark can split.
    counts = held.groupBy("key").agg(F.count("*").alias("n"), F.max("doc_id").alias("keeper")).where(F.col("n") >= documents)
    counts = lineage.settled(counts.withColumnRenamed("key", "repeated"), "repeated")
    gone = held.join(counts, F.col("key") == F.col("repeated")).where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    gone = gone.groupBy("row").agg(F.collect_list("key").alias("gone")).withColumnRenamed("row", "of")
    nothing = F.lit(None).cast("array<string>").alias("gone")
    touched = found.where("suspected is not null").join(gone, F.col("row") == F.col("of"), "left").select("doc_id", "text", "gone")
    rest = found.where("suspected is null").select("doc_id", "text", nothing)
    return rest.unionByName(touched).mapInArrow(_rewriting(least), f"doc_id {kind}, text string, n_lines long, n_dropped long")
