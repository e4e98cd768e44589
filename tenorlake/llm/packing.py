"""Packing by lexical retrieval: a window is filled with what a search for its first document finds.

Documents are turned into token ids, ended by an id of their own, and dealt by content into shards of
about half a million tokens: by their heaviest term in BM25 that enough documents have. Terms that are often the
two heaviest of a document share a shard; those of one term that exceed a shard are dealt by the next heaviest, and
what is still too large by a hash of id, place and row. Each shard has an inverted index with BM25 weights; the document
frequencies are those of all documents. Whole windows of a long document are sequences by themselves;
what is left of it is packed. The first unused document of a shard is the seed
of a window; its distinct tokens are the query; unused documents follow by falling score
until the window is full; copies of what it holds, by content or id, come last. The one that crosses the end is cut, and its rest is the next seed,
so only the last window of a shard is padded.

Tokens of most words are remembered, so only new words reach the tokenizer. That holds
for texts whose characters are at most U+017F; other texts are encoded whole by the tokenizer.

The driver gets tables with some entries per token of the vocabulary and per shard. Documents of over 131,072 tokens travel in parts of so many.

Defined results: a null text is empty and has the end id alone; repeated rows are packed
each; a null id is packed like any other; an empty table gives no rows; other columns stay out.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tenorlake.llm.common import slices
from tenorlake.sources import lineage

WINDOW = 2048
END = 1
SHARD_TOKENS = 1 << 19
LONGEST = 64 * WINDOW
VOCABULARY = 1 << 16
K1, B = 1.2, 0.75
REMEMBERED = 300_000
TOGETHER = 1 << 22
LINKS = 8

#: What the tokenizer splits texts into, written out for lower-case characters up to U+017F.
_SPLIT = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\xaa\xb5\xba\xdf-\xf6\xf8-ſ]+|[0-9\xb2\xb3\xb9\xbc-\xbe]|[^\t-\r \x85\xa0a-z\xaa\xb5\xba\xdf-\xf6\xf8-ſ0-9\xb2\xb3\xb9\xbc-\xbe]+")
_WIDER = re.compile("[^\x00-ſ]")
_ID = attrgetter("id")


class Words(dict):
    """Token ids of words as bytes, found by the tokenizer's model; forgotten when there are too many.

    Other lower-case pieces of texts, without blanks, are looked up as well, by the words in them.
    """

    def __init__(self, model):
        self.model = model
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in printable]
        #: The characters by which the model knows bytes.
        self.letter = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}

    def __missing__(self, piece: str) -> bytes:
        if not piece.isalpha():
            words = _SPLIT.findall(piece)
            if words != [piece]:
                return b"".join(map(self.__getitem__, words))
        if len(self) >= REMEMBERED:
            self.clear()
        mapped = piece if piece.isascii() and piece.isprintable() else piece.encode().decode("latin-1").translate(self.letter)
        value = self[piece] = array("H", map(_ID, self.model.tokenize(mapped))).tobytes()
        return value


class Encoder:
    """Texts to token ids as 16-bit numbers, each text ended by ``END``."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.words = Words(self.tokenizer.model)
        self.end = array("H", [END]).tobytes()

    def encode(self, text: str) -> bytes:
        if not text.isascii() and _WIDER.search(text):
            return array("H", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes() + self.end
        return b"".join(map(self.words.__getitem__, _SPLIT.findall(text.lower()))) + self.end

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """``encode`` of each text; a piece between blanks that several of the texts have is looked up once."""
        plain = [len(t) <= TOGETHER and (t.isascii() or not _WIDER.search(t)) for t in texts]
        split = pc.ascii_split_whitespace(pa.array([t.lower() if p else "" for t, p in zip(texts, plain, strict=True)], pa.string()))
        pieces = split.flatten().dictionary_encode()
        known = map(self.words.__getitem__, pieces.dictionary.to_numpy(zero_copy_only=False).tolist())
        ids = pa.array(list(known), pa.binary()).take(pieces.indices)
        offsets, data = np.frombuffer(ids.buffers()[1], np.int32), memoryview(ids.buffers()[2] or b"")
        ends = offsets[split.offsets.to_numpy()].tolist()
        return [bytes(data[ends[i] : ends[i + 1]]) + self.end if p else self.encode(texts[i]) for i, p in enumerate(plain)]


def together_slices(batch: pa.RecordBatch, text: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with ``TOGETHER`` bytes of text each, or a row more."""
    size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy().astype(np.int64)
    group = (np.cumsum(size) - size) // TOGETHER
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
    for begin, end in zip(cuts, cuts[1:], strict=False):
        if begin < end:
            yield batch.slice(begin, end - begin)


def _encoded(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        uses, last = np.zeros(VOCABULARY, np.int64), np.empty(VOCABULARY, np.int64)
        kind = None

        def rows(ids: pa.Array, encoded: list[bytes]) -> pa.RecordBatch:
            owner, start, size, raw = [], [], [], []
            for i, own in enumerate(encoded):
                uses[distinct(np.frombuffer(own, "<u2"), last)] += 1
                for at in range(0, len(own), 2 * LONGEST):
                    owner.append(i)
                    start.append(at // 2)
                    size.append(len(own) // 2)
                    raw.append(own[at : at + 2 * LONGEST])
            columns = [ids.take(pa.array(owner, pa.int64())), pa.array(start, pa.int64()), pa.array(size, pa.int64()), pa.array(raw, pa.binary())]
            return pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "doc_tokens", "ids"])

        for batch in batches:
            kind = batch.column(0).type
            for part in together_slices(batch, 1):
                yield rows(part.column(0), encoder.encode_all([t or "" for t in part.column(1).to_pylist()]))
        if kind is not None:  # a last row holds how many documents have each token
            columns = [pa.nulls(1, kind), pa.array([-1], pa.int64()), pa.array([0], pa.int64()), pa.array([uses.astype("<i8").tobytes()], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "doc_tokens", "ids"])

    return run


def encoded(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, start, doc_tokens, ids): parts of documents; rows with start -1 hold token frequencies of a task."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_encoded(path), f"doc_id {kind}, start long, doc_tokens long, ids binary")


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(VOCABULARY, np.int64)
    for batch in batches:
        for raw in batch.column(0).to_pylist():
            total += np.frombuffer(raw, "<i8")
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], ["token", "uses"])


def counted(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct token ids, ascending, and how often each occurs; there is at least one."""
    own = np.sort(ids, kind="stable")  # by digits, as ids have 16 bits
    begin = np.concatenate(([0], np.flatnonzero(own[1:] != own[:-1]) + 1))
    return own[begin], np.diff(begin, append=len(own))


def distinct(ids: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Distinct token ids without a sort, each where it occurs last; ``last`` has a place for every token and is overwritten."""
    at = np.arange(len(ids))
    last[ids] = at
    return ids[last[ids] == at]


def heaviest(ids: np.ndarray, weight: np.ndarray, mean: float) -> tuple[int, int]:
    """The two terms of most BM25 weight, -1 where there are none."""
    term, n = counted(ids)
    score = weight[term] * n * (K1 + 1) / (n + K1 * (1 - B + B * len(ids) / mean))
    best = []
    for _ in range(2):
        i = int(score.argmax())
        best.append(int(term[i]) if score[i] > 0 else -1)
        score[i] = 0
    return best[0], best[1]


def _termed(weight: np.ndarray, mean: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            terms = [heaviest(np.frombuffer(raw, "<u2"), weight, mean) for raw in batch.column("ids").to_pylist()]
            columns = [pa.array([t[0] for t in terms], pa.int64()), pa.array([t[1] for t in terms], pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, "t1", "t2"])

    return run


def together(sizes: dict[int, int], links: dict[tuple[int, int], int]) -> dict[int, int]:
    """Terms to groups that fit a shard, joined by the strongest links first."""
    root, size = {t: t for t in sizes}, dict(sizes)

    def find(t: int) -> int:
        while root[t] != t:
            root[t] = root[root[t]]
            t = root[t]
        return t

    for (a, b), _ in sorted(links.items(), key=lambda x: (-x[1], x[0])):
        if a in root and b in root:
            a, b = sorted((find(a), find(b)))
            if a != b and size[a] + size[b] <= SHARD_TOKENS:
                root[b] = a
                size[a] += size[b]
    return {t: find(t) for t in sizes}


def filled(sizes: dict[tuple[int, int, int], int]) -> dict[tuple[int, int, int], tuple[int, int]]:
    """First shard and number of shards of (group, term, bucket): small ones share a shard, large ones get several."""
    whole: dict[int, int] = {}
    for key, size in sizes.items():
        whole[key[0]] = whole.get(key[0], 0) + size
    plan, shard, held, last = {}, 0, 0, None
    for key, size in sorted(sizes.items()):
        group = whole[key[0]]
        begins = key[0] != last and group <= SHARD_TOKENS < held + group and held > SHARD_TOKENS // 2
        if held and (held + size > SHARD_TOKENS or begins):
            shard, held = shard + 1, 0
        split = -(-size // SHARD_TOKENS) if size > SHARD_TOKENS * 5 // 4 else 1
        plan[key] = (shard, split)
        if split > 1:
            shard += split
        else:
            held += size
        last = key[0]
    return plan


def _dealt(parts: DataFrame) -> DataFrame:
    """Parts with their shard, from the sizes of their two heaviest terms together.

    A term's buckets of second terms lie in one row of a table that parts meet by their first term.
    """
    spark = parts.sparkSession
    size = F.sum(F.octet_length("ids") / 2).cast("long").alias("size")
    sizes = lineage.settled(parts.groupBy("t1", "t2").agg(size), "terms")
    firsts = {r.t1: r.size for r in sizes.groupBy("t1").agg(F.sum("size").alias("size")).collect()}  # at most one row per token
    nearest = Window.partitionBy("t1").orderBy(F.desc("size"), "t2")
    links: dict[tuple[int, int], int] = {}
    for r in sizes.where("t1 >= 0 and t2 >= 0").withColumn("place", F.row_number().over(nearest)).where(F.col("place") <= LINKS).collect():
        pair = (min(r.t1, r.t2), max(r.t1, r.t2))
        links[pair] = links.get(pair, 0) + r.size
    groups = together(firsts, links)
    # The buckets of large terms are in proportion to the shards they fill.
    buckets = {t: 4 * -(-n // SHARD_TOKENS) for t, n in firsts.items() if n > SHARD_TOKENS}
    keys = {(groups[t], t, 0): n for t, n in firsts.items() if t not in buckets}
    if buckets:
        large = spark.createDataFrame(sorted(buckets.items()), "t1 long, buckets long")
        bucket = F.pmod("t2", "buckets").alias("bucket")
        for r in sizes.join(large, "t1").groupBy("t1", bucket).agg(F.sum("size").alias("size")).collect():
            keys[groups[r.t1], r.t1, r.bucket] = r.size
    places = {t: [None] * buckets.get(t, 1) for t in firsts}
    for (_, t, bucket), place in filled(keys).items():
        places[t][bucket] = place
    plan = spark.createDataFrame(sorted(places.items()), "t1 long, places array<struct<shard: long, split: long>>")
    place = F.get("places", F.pmod("t2", F.size("places")).cast("int"))
    shard = place["shard"] + F.pmod("salt", place["split"])
    return parts.join(lineage.settled(plan.coalesce(1), "places"), "t1").select("doc_id", "start", "doc_tokens", "ids", shard.alias("shard"))


class Index:
    """BM25 of one shard's parts; tokens that half of all documents have weigh nothing."""

    def __init__(self, parts: list[np.ndarray], weight: np.ndarray, mean: float):
        terms, owners, scores = [], [], []
        for i, ids in enumerate(parts):
            term, n = counted(ids)
            some = weight[term] > 0
            term, n = term[some], n[some]
            terms.append(term)
            owners.append(np.full(len(term), i, np.int32))
            scores.append(weight[term] * n * (K1 + 1) / (n + K1 * (1 - B + B * len(ids) / mean)))
        self.terms, self.size = terms, len(parts)
        term, owner = np.concatenate(terms), np.concatenate(owners)
        order = np.argsort(term, kind="stable")
        self.owner, self.score = owner[order], np.concatenate(scores)[order].astype(np.float32)
        self.begin = np.searchsorted(term[order], np.arange(VOCABULARY + 1))

    def search(self, i: int) -> np.ndarray:
        """Scores of all parts for the tokens of part i."""
        begin = self.begin[self.terms[i]]
        n = self.begin[self.terms[i].astype(np.int64) + 1] - begin
        at = np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return np.bincount(self.owner[at], self.score[at], self.size)


def windows(parts: list[np.ndarray], index: Index, marks: list[tuple] | None = None) -> Iterator[list[tuple[int, int, int]]]:
    """Windows as lists of (part, start, length); parts with a common mark are copies."""
    marks = marks or [()] * len(parts)
    rest: list[int] = []
    for i, ids in enumerate(parts):
        whole = len(ids) // WINDOW * WINDOW
        for at in range(0, whole, WINDOW):
            yield [(i, at, WINDOW)]
        rest.append(whole)
    unused = np.array([r < len(p) for r, p in zip(rest, parts, strict=True)])
    seed, low = -1, 0
    while True:
        if seed < 0:
            while low < len(parts) and not unused[low]:
                low += 1
            if low == len(parts):
                return
            seed = low
        unused[seed] = False
        window, free = [(seed, rest[seed], len(parts[seed]) - rest[seed])], WINDOW - (len(parts[seed]) - rest[seed])
        seed_next = -1
        if free and unused.any():
            scores = np.where(unused, index.search(seed), -1.0)
            # More than enough to fill the window: the best by count of what would fit, then all.
            order = np.argsort(-scores, kind="stable")
            held, copies = set(marks[seed]), []

            def candidates(order=order[: np.count_nonzero(unused)], held=held, copies=copies):
                for j in order.tolist():
                    if held.isdisjoint(marks[j]):
                        yield j
                    else:
                        copies.append(j)
                yield from copies

            for j in candidates():
                if not free:
                    break
                n = min(free, len(parts[j]) - rest[j])
                window.append((j, rest[j], n))
                held.update(marks[j])
                rest[j] += n
                free -= n
                unused[j] = False
                if rest[j] < len(parts[j]):
                    seed_next = j
        yield window
        seed = seed_next


def _packed(weight: np.ndarray, mean: float):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending"), ("start", "ascending"), ("doc_tokens", "ascending")])
        parts = [np.frombuffer(raw, "<u2") for raw in table.column("ids").to_pylist()]
        start = table.column("start").to_pylist()
        shard = table.column("shard")[0].as_py()
        owner, at, size, crc, sequence, offset = [], [], [], [], [], []
        ids = table.column("doc_id").to_pylist()
        marks = [((zlib.crc32(p), len(p)), *([("id", i, at_)] if i is not None else [])) for p, i, at_ in zip(parts, ids, start, strict=True)]
        for k, window in enumerate(windows(parts, Index(parts, weight, mean), marks)):
            place = 0
            for i, begin, n in window:
                owner.append(i)
                at.append(start[i] + begin)
                size.append(n)
                crc.append(zlib.crc32(parts[i][begin : begin + n].astype("<u4").tobytes()))
                sequence.append((shard << 32) + k)
                offset.append(place)
                place += n
        rows = pa.array(owner, pa.int64())
        longs = lambda x: pa.array(x, pa.int64())
        columns = [table.column("doc_id").combine_chunks().take(rows), longs(at), longs(size), longs(crc), table.column("doc_tokens").combine_chunks().take(rows), longs(sequence), longs(offset)]
        return pa.table(columns, names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    return run


def pack(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    rows = lineage.settled(encoded(docs, path, id_col, text_col), "encoded")
    parts = rows.where("start >= 0")
    total = parts.agg(F.sum(F.when(F.col("start") == 0, F.col("doc_tokens"))).alias("tokens"), F.count_if(F.col("start") == 0).alias("n")).first()
    uses = rows.where("start = -1").select("ids").mapInArrow(_summed, "token long, uses long").groupBy("token").agg(F.sum("uses").alias("uses")).collect()
    weight = np.zeros(VOCABULARY)
    for r in uses:  # at most one row per token of the vocabulary
        weight[r.token] = max(0.0, np.log((total.n - r.uses + 0.5) / (r.uses + 0.5)))
    shards = max(1, -(-(total.tokens or 0) // SHARD_TOKENS))
    mean = (total.tokens or 1) / max(1, total.n)
    kind = rows.schema["doc_id"].dataType.simpleString()
    if shards == 1:
        dealt = parts.withColumn("shard", F.lit(0).cast("long"))
    else:
        # Terms that few documents have would only make groups too small to fill a shard.
        known = np.zeros(VOCABULARY)
        for r in uses:
            known[r.token] = weight[r.token] if r.uses >= max(2, total.n // shards // 4) else 0.0
        salt = F.pmod(F.xxhash64("doc_id", "start", F.monotonically_increasing_id()), F.lit(1 << 31))
        salted = parts.select("doc_id", "start", "doc_tokens", "ids", salt.alias("salt"))
        termed = salted.mapInArrow(_termed(known, mean), f"doc_id {kind}, start long, doc_tokens long, ids binary, salt long, t1 long, t2 long")
        dealt = _dealt(lineage.settled(termed, "termed"))
        lineage.discard(rows)
    out = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return dealt.groupBy("shard").applyInArrow(_packed(weight, mean), out)
