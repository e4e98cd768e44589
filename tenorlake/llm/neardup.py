"""Near duplicates by a multi-index Hamming join of MinHash signatures.

Words are runs of anything but ASCII white space, A-Z lower-cased. A text's set has its
distinct 5-word shingles; texts with equal sets are one node. Its signature has 64
MinHash values of 16 bits, split into 16 chunks of 4. Two signatures that differ in at
most 31 values differ, by the pigeonhole principle, in at most one value of some chunk, so every node is
listed under each chunk with each one of its values left out: 64 keys. All pairs within
distance 31 meet under a key; at a similarity of 0.75 a pair is farther apart in about one case
in 100,000, and meets under no key in less than one in 10^9.

Pairs aren't taken all with all:

1. Under every key each node is paired with the smallest. Pairs within the distance are
   confirmed on their full shingle sets, and the links give components.
2. Keys whose nodes are still in several components compare nodes again, across components
   only. What is known to be connected is never compared again, so a large group of
   copies costs a pair per copy. Nodes outside a key's largest component are held against all
   others in blocks of 2,048; a pair is taken at the first key it shares, if its distance is within 31
   and that of 2,048 further values of one bit within 328 (4.8 standard deviations above
   that of a similarity of 0.75), and confirmed on the full sets.

So every pair within both distances is either confirmed or refused on full sets, or already in one component.

Defined results: texts without words and null texts have no shingles and no links;
with one to four words the whole sequence is the one shingle. Rows without an id have
no component and are kept. Repeated rows share their id, so all of them are kept by :func:`near_duplicates`
and one by :func:`deduplicated`. An empty table gives no rows; other columns stay out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenorlake.llm.common import slices
from tenorlake.llm.components import components
from tenorlake.sources import lineage

WIDTH = 5
CHUNKS, CHUNK = 16, 4
VALUES = CHUNKS * CHUNK
DISTANCE = 2 * CHUNKS - 1
FINE, FINE_DISTANCE = 2048, 328
BLOCK = 2048
#: Members confirmed against a copy of their hub's text in one run.
TOGETHER = 256
REMEMBERED = 150_000

_rng = np.random.default_rng(20240229)
FACTORS = _rng.integers(1, 2**63, VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
P = np.uint64(0x9E3779B97F4A7C15)
FINE_FACTORS = _rng.integers(1, 2**63, FINE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class Words(dict):
    """Hashes of words, forgotten when there are too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingles(text: bytes | None, words: Words) -> np.ndarray:
    """The sorted hashes of a text's shingles."""
    parts = (text or b"").lower().split()
    if not parts:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(words.__getitem__, parts), np.uint64, len(parts))
    if len(h) < WIDTH:
        return np.array([xxhash.xxh3_64_intdigest(h.tobytes(), len(h))], np.uint64)
    out = h[: len(h) - WIDTH + 1].copy()
    for k in range(1, WIDTH):
        out *= P
        out += h[k : len(h) - WIDTH + 1 + k]
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(32)
    return np.unique(out)


def minima(own: np.ndarray, factors: np.ndarray) -> np.ndarray:
    least = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    step = max(1, 262_144 // len(factors))  # a few MB at a time
    for i in range(0, len(own), step):
        np.minimum(least, (own[i : i + step, None] * factors).min(axis=0), out=least)
    return least * P


def signature(own: np.ndarray) -> np.ndarray:
    return (minima(own, FACTORS) >> np.uint64(48)).astype("<u2")


def fine_signature(own: np.ndarray) -> np.ndarray:
    """2,048 values of one bit."""
    return np.packbits(minima(own, FINE_FACTORS) >> np.uint64(63))


def _binary(column: pa.Array) -> list:
    return column.cast(pa.binary()).to_pylist()


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = Words()
    for batch in slices(batches):
        sizes, keys, signatures = [], [], []
        for text in _binary(batch.column(1)):
            own = shingles(text, words)
            sizes.append(len(own))
            keys.append(xxhash.xxh3_128_digest(own.tobytes()) if len(own) else None)
            signatures.append(signature(own).tobytes() if len(own) else None)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(signatures, pa.binary())], ["doc_id", "n_shingles", "set_key", "signature"])


def signed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, set_key (equal for equal sets) and signature."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_signed, f"doc_id {kind}, n_shingles long, set_key binary, signature binary")


def _keys_of(signatures: list[bytes]) -> np.ndarray:
    """Rows of 64 keys: chunk by chunk, each with one value left out."""
    values = np.frombuffer(b"".join(signatures), "<u2").reshape(-1, CHUNKS, CHUNK).astype(np.uint64)
    out = np.empty((len(values), CHUNKS, CHUNK), np.uint64)
    for left_out in range(CHUNK):
        rest = [i for i in range(CHUNK) if i != left_out]
        packed = (values[:, :, rest[0]] << np.uint64(32)) | (values[:, :, rest[1]] << np.uint64(16)) | values[:, :, rest[2]]
        # 48 bits of values, and which chunk and place: no two different keys are the same number.
        out[:, :, left_out] = (packed << np.uint64(6)) | (np.arange(CHUNKS, dtype=np.uint64) * np.uint64(CHUNK) + np.uint64(left_out))
    return out.reshape(len(values), VALUES).view(np.int64)


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 2048):
            part = batch.slice(at, 2048)
            keys = _keys_of(part.column(1).to_pylist())
            ids = part.column(0).take(pa.array(np.repeat(np.arange(len(keys)), VALUES)))
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel(), pa.int64()), ids], ["key", "node"])


def listed(nodes: DataFrame) -> DataFrame:
    """(key, node), 64 rows per node."""
    kind = nodes.schema["node"].dataType.simpleString()
    return nodes.select("node", "signature").mapInArrow(_listed, f"key long, node {kind}")


def _fine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = Words()
    for batch in slices(batches):
        fine = pa.array([fine_signature(shingles(t, words)).tobytes() for t in _binary(batch.column(1))], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), fine], ["node", "fine"])


def across(key: int, rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs of a block that are in different components, near enough, and share no key before this one."""
    role = rows.column("role").to_numpy()
    first, second = np.flatnonzero(role & 1), np.flatnonzero(role & 2)
    out = rows.column("outside").to_numpy(zero_copy_only=False)
    nodes = rows.column("node").combine_chunks()
    _, rank = np.unique(np.array(nodes.to_pylist()), return_inverse=True)
    _, component = np.unique(np.array(rows.column("component").to_pylist()), return_inverse=True)
    values = np.frombuffer(b"".join(rows.column("signature").to_pylist()), "<u2").reshape(-1, VALUES)
    fine = np.frombuffer(b"".join(rows.column("fine").to_pylist()), np.uint64).reshape(-1, FINE // 64)
    a, b = [], []
    for i in first.tolist():
        j = second[(component[second] != component[i]) & ((rank[second] > rank[i]) | ~out[second])]
        differ = values[j] != values[i]
        near = differ.sum(axis=1) <= DISTANCE
        j, differ = j[near], differ[near].reshape(-1, CHUNKS, CHUNK)
        wrong = differ.sum(axis=2)
        chunk = (wrong <= 1).argmax(axis=1)
        at = np.arange(len(j))
        shared = chunk * CHUNK + np.where(wrong[at, chunk] == 1, differ[at, chunk].argmax(axis=1), 0)
        j = j[shared == key & 63]
        j = j[np.bitwise_count(fine[j] ^ fine[i]).sum(axis=1) <= FINE_DISTANCE]
        a.append(np.full(len(j), i))
        b.append(j)
    return (np.concatenate(a), np.concatenate(b)) if a else (np.empty(0, int), np.empty(0, int))


def _crossed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks come in order; each is compared as soon as it is whole."""

    def pairs(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(parts)
        i, j = across(rows.column("key")[0].as_py(), rows)
        nodes = rows.column("node").combine_chunks()
        x, y = nodes.take(pa.array(i)), nodes.take(pa.array(j))
        lower = pc.less(x, y)
        return pa.RecordBatch.from_arrays([pc.if_else(lower, x, y), pc.if_else(lower, y, x)], ["a", "b"])

    held: list[pa.RecordBatch] = []
    now = None
    for batch in batches:
        marks = list(zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True))
        at = 0
        while at < len(marks):
            end = at
            while end < len(marks) and marks[end] == marks[at]:
                end += 1
            if marks[at] != now and held:
                yield pairs(held)
                held = []
            now = marks[at]
            held.append(batch.slice(at, end - at))
            at = end
    if held:
        yield pairs(held)


def _distance(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), "<u2").reshape(-1, VALUES) for i in (2, 3))
        near = pa.array((a != b).sum(axis=1) <= DISTANCE)
        yield pa.RecordBatch.from_arrays([batch.column(i).filter(near) for i in (0, 1)], ["a", "b"])


def within_distance(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    kind = pairs.schema["a"].dataType.simpleString()
    a, b = nodes.select(F.col("node").alias("a"), F.col("signature").alias("sig_a")), nodes.select(F.col("node").alias("b"), F.col("signature").alias("sig_b"))
    return pairs.join(a, "a").join(b, "b").select("a", "b", "sig_a", "sig_b").mapInArrow(_distance, f"a {kind}, b {kind}")


def _compare(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, hub, own = Words(), None, None
        for batch in slices(batches):
            kept = []
            ids, parts, roles = (batch.column(i).to_pylist() for i in (0, 1, 2))
            for i, text in enumerate(_binary(batch.column(4))):
                sets = shingles(text, words)
                if roles[i] == 0:
                    hub, own = (ids[i], parts[i]), sets
                elif hub == (ids[i], parts[i]):
                    fewer, more = min(len(sets), len(own)), max(len(sets), len(own))
                    if 100 * fewer >= percent * more > 0:
                        common = len(np.intersect1d(sets, own, assume_unique=True))
                        if 100 * common >= percent * (len(sets) + len(own) - common):
                            kept.append(i)
            rows = pa.array(kept, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(3).take(rows)], ["a", "b"])

    return run


def confirmed(pairs: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets are similar enough. Few rows are read twice: a hub's text goes with each 256 members."""
    kind = pairs.schema["a"].dataType.simpleString()
    ids = lineage.settled(pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id"))).distinct(), "ids")
    texts = lineage.settled(docs.join(ids, "doc_id", "left_semi").dropDuplicates(["doc_id"]), "texts")
    counts = lineage.settled(pairs.groupBy("a").agg(F.count("*").alias("n")), "hub-sizes")
    dealt = pairs.join(counts, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.ceil(F.col("n") / TOGETHER)).alias("part"))
    dealt = lineage.settled(dealt, "pairs")
    members = dealt.join(texts.withColumnRenamed("doc_id", "b"), "b").select("a", "part", F.lit(1).alias("role"), "b", "text")
    hubs = dealt.select("a", "part").distinct().join(texts.withColumnRenamed("doc_id", "a"), "a").select("a", "part", F.lit(0).alias("role"), F.col("a").alias("b"), "text")
    rows = members.unionByName(hubs).repartition("a", "part").sortWithinPartitions("a", "part", "role")
    return rows.mapInArrow(_compare(percent), f"a {kind}, b {kind}")


def _hub_pairs(nodes: DataFrame) -> DataFrame:
    """Under every key, each node with the smallest."""
    rows = listed(nodes)
    hubs = listed(nodes).groupBy("key").agg(F.min("node").alias("a"), F.count("*").alias("n")).where("n > 1").select("key", "a")
    hubs = lineage.settled(hubs, "hubs")  # a table of its own, so that a hot key can be split in the join
    return rows.join(hubs, "key").where("node > a").select("a", F.col("node").alias("b")).distinct()


def _cross_pairs(nodes: DataFrame, known: DataFrame, texts: DataFrame) -> DataFrame:
    """Under keys with nodes of several components: near pairs across components."""
    labelled = nodes.join(known.withColumnRenamed("component", "own"), "node", "left").select("node", "signature", F.coalesce("own", "node").alias("component"))
    labelled = lineage.settled(labelled, "labelled")
    rows = listed(nodes).join(labelled.select("node", "component"), "node")
    # Of two nodes the pair has been looked at; the pairs of the smallest node as well.
    open_keys = rows.groupBy("key").agg(F.min("node").alias("hub"), F.count("*").alias("n"), F.min("component").alias("p"), F.max("component").alias("q"))
    open_keys = lineage.settled(open_keys.where("n > 2 and p <> q").select("key", "hub"), "open-keys")
    rows = lineage.settled(rows.join(open_keys, "key").where("node <> hub").select("key", "node", "component"), "open-rows")
    counts = rows.groupBy("key", "component").agg(F.count("*").alias("n"))
    groups = counts.groupBy("key").agg(F.sum("n").alias("n"), F.max(F.struct("n", "component")).alias("largest")).where("n > largest.n")
    blocks = lambda n: F.ceil(n / BLOCK)
    groups = groups.select("key", F.col("largest.component").alias("largest"), blocks(F.col("n") - F.col("largest.n")).alias("na"), blocks(F.col("n")).alias("nb"))
    rows = lineage.settled(rows.join(groups, "key").withColumn("outside", F.col("component") != F.col("largest")), "open-groups")
    ids = lineage.settled(rows.select(F.col("node").alias("doc_id")).distinct(), "ids")
    kind = rows.schema["node"].dataType.simpleString()
    fine = texts.join(ids, "doc_id", "left_semi").dropDuplicates(["doc_id"]).select("doc_id", "text").mapInArrow(_fine, f"node {kind}, fine binary")
    fine = lineage.settled(fine, "fine")
    own = lambda n: F.pmod(F.xxhash64("node"), F.col(n))
    upto = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    # Role 1 asks, role 2 answers, 3 does both: a node outside the largest component asks all blocks and answers all that ask.
    both = lambda a, b: F.when(F.col("outside") & (a == own("na")) & (b == own("nb")), 3)
    ask = F.when(F.col("outside"), F.transform(upto("nb"), lambda k: F.struct(own("na").alias("ia"), k.alias("ib"), both(own("na"), k).otherwise(1).alias("role"))))
    answer = F.transform(upto("na"), lambda k: F.struct(k.alias("ia"), own("nb").alias("ib"), both(k, own("nb")).otherwise(2).alias("role")))
    answer = F.filter(answer, lambda x: x["role"] == 2)
    places = F.explode(F.concat(F.coalesce(ask, F.array().cast("array<struct<ia:bigint,ib:bigint,role:int>>")), answer)).alias("place")
    rows = rows.join(labelled.select("node", "signature"), "node").join(fine, "node")
    rows = rows.select("key", places, "node", "component", "outside", "signature", "fine").select("key", "place.*", "node", "component", "outside", "signature", "fine")
    rows = rows.repartition("key", "ia", "ib").sortWithinPartitions("key", "ia", "ib")
    return rows.mapInArrow(_crossed, f"a {kind}, b {kind}")


def links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75) -> tuple[DataFrame, DataFrame]:
    """(every document with n_shingles and node, components of nodes). A node is the smallest id of a set."""
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = lineage.settled(signed(docs, id_col, text_col), "signed")
    with_id = rows.where("set_key is not null and doc_id is not null")
    nodes = with_id.groupBy("set_key").agg(F.min("doc_id").alias("node"), F.first("signature").alias("signature"))
    nodes = lineage.settled(nodes, "nodes")
    pairs = lineage.settled(within_distance(_hub_pairs(nodes), nodes), "hub-pairs")
    found = lineage.settled(confirmed(pairs, texts, percent), "confirmed")
    known = components(found)
    more = lineage.settled(_cross_pairs(nodes, known, texts).join(pairs, ["a", "b"], "left_anti"), "cross-pairs")
    if not more.isEmpty():
        found = found.unionByName(confirmed(more, texts, percent))
        known = components(found)
    rows = rows.select("doc_id", "n_shingles", "set_key").join(nodes.select("set_key", "node"), "set_key", "left")
    return rows.select("doc_id", "n_shingles", F.coalesce("node", "doc_id").alias("node")), known


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id reachable) and kept, per row."""
    rows, known = links(docs, id_col, text_col, percent)
    rows = rows.join(known, "node", "left").withColumn("component_id", F.coalesce("component", "node"))
    return rows.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75) -> DataFrame:
    """The rows of one document of each component, and rows without an id; of rows with the same id and text one."""
    kept = near_duplicates(docs, id_col, text_col, percent).where("kept and doc_id is not null").select(F.col("doc_id").alias("kept_id")).distinct()
    own = docs.join(kept, docs[id_col] == kept["kept_id"], "left_semi")
    own = own.withColumn("_text_key", F.sha2(F.coalesce(text_col, F.lit("")), 256)).dropDuplicates([id_col, "_text_key"]).drop("_text_key")
    return own.unionByName(docs.where(F.col(id_col).isNull()))
