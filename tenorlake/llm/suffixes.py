"""Repeated passages by a sparse suffix array.

A passage repeats if its 50 words (A-Z in either case) stand at another place of the corpus, in the same or
another document. Of all suffixes only those are retained that begin at minimisers: among
the 31 starts of 20-word heads in a window of 50 words, the one with the smallest hash. The choice depends
on the window's words alone, so equal windows retain the suffix at the same place of theirs, and one
suffix in sixteen or so stands for all windows around it.

1. Retained suffixes are put in order of their heads, and neighbours compared: a suffix whose head is
   unique repeats nothing. Suffixes with the same head and the same surroundings (all words of all
   windows they stand for) are one class; a class of two or more repeats as a whole.
2. Where classes share a head, one suffix of each is extended left and right, window by window, and the windows
   are put in order and compared in turn.
3. Repeating windows that overlap or touch are joined to the longest passages.

Comparing neighbours for equality is done by aggregation on hashes of the words, so a passage that a third of all
documents hold meets partial sums before any shuffle, and no pair of places is ever made.
Extending against the neighbour alone would lose windows where one partner agrees
further to the left and another further to the right; step 2 looks at each window for itself and loses none.

Defined results: null texts and texts of fewer than 50 words have no row; rows without an
id aren't looked at; rows that share id and text repeat each other; an empty table gives no
rows; other columns stay out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tenorlake.llm.common import slices
from tenorlake.llm.neardup import Words
from tenorlake.sources import lineage

LENGTH = 50
HEAD = 20
SPREAD = LENGTH - HEAD + 1
BASE = 0x9E3779B97F4A7C15


class Ranges:
    """Hashes of any ranges of words of a text, from one running sum."""

    def __init__(self):
        self.words = Words()
        self.up = self.down = np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.up) < n:
            n = max(n, 2 * len(self.up))
            factors = np.full((2, n), [[BASE], [pow(BASE, -1, 1 << 64)]], np.uint64)
            factors[:, 0] = 1
            self.up, self.down = np.cumprod(factors, axis=1, dtype=np.uint64)

    def read(self, text: bytes | None) -> int:
        """Take a text; its number of words."""
        parts = (text or b"").lower().split()
        n = len(parts)
        self._powers(n + 1)
        h = np.fromiter(map(self.words.__getitem__, parts), np.uint64, n)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(h * self.up[:n], out=self.sums[1:])
        return n

    def of(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        x = (self.sums[end] - self.sums[begin]) * self.down[begin]
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(29)
        x *= np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(32))


def retained(ranges: Ranges, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the retained suffixes, and the first and last window each stands for."""
    at = np.arange(n - HEAD + 1)
    heads = ranges.of(at, at + HEAD)
    place = np.lib.stride_tricks.sliding_window_view(heads, SPREAD).argmin(axis=1) + np.arange(n - LENGTH + 1)
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    last = np.concatenate([first[1:], [len(place)]]) - 1
    return place[first], first, last


def _suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ranges = Ranges()
    for batch in slices(batches, 2048):
        owner, heads, classes, first, last = [], [], [], [], []
        for i, text in enumerate(batch.column(1).cast(pa.binary()).to_pylist()):
            n = ranges.read(text)
            if n >= LENGTH:
                place, a, z = retained(ranges, n)
                owner.append(np.full(len(place), i))
                heads.append(ranges.of(place, place + HEAD))
                # How far the head is from the first window is part of the class.
                classes.append(ranges.of(a, z + LENGTH) + (place - a).astype(np.uint64))
                first.append(a)
                last.append(z)
        if owner:
            join = lambda x: pa.array(np.concatenate(x))
            signed = lambda x: pa.array(np.concatenate(x).view(np.int64))
            columns = [batch.column(0).take(join(owner)), signed(heads), signed(classes), join(first).cast(pa.int64()), join(last).cast(pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "head", "class", "first", "last"])


def _extended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ranges = Ranges()
    for batch in batches:
        rows, words, starts = [], [], []
        texts = batch.column(1).cast(pa.binary()).to_pylist()
        for text, places in zip(texts, batch.column(2).to_pylist(), strict=True):
            ranges.read(text)
            for p in places:
                at = np.arange(p["first"], p["last"] + 1)
                rows += [(p["head"], p["class"])] * len(at)
                words.append(ranges.of(at, at + LENGTH))
                starts.append(at)
        if rows:
            own = np.concatenate(starts)
            counts = [sum(p["last"] - p["first"] + 1 for p in places) for places in batch.column(2).to_pylist()]
            ids = batch.column(0).take(pa.array(np.repeat(np.arange(batch.num_rows), counts)))
            columns = [ids, pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array(np.concatenate(words).view(np.int64)), pa.array(own, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "head", "class", "words", "start"])


def suffixes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, head, class, first, last) of retained suffixes."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).where("doc_id is not null")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_suffixes, f"doc_id {kind}, head long, class long, first long, last long")


def repeating_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, begin, end, later): runs of windows that repeat; later ones have the same words at an earlier place."""
    # Sides of joins that come from an aggregate are written first: joined with a table of its own, a
    # head or class that a third of all rows have can be split over tasks.
    heads = suffixes(docs, id_col, text_col).groupBy("head").agg(F.count("*").alias("places")).where("places > 1").select("head")
    heads = lineage.settled(heads, "heads")
    rows = lineage.settled(suffixes(docs, id_col, text_col).join(heads, "head"), "suffixes")
    classes = rows.groupBy("head", "class").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "first")).alias("rep"), F.max(F.col("last") - F.col("first")).alias("width"))
    classes = lineage.settled(classes, "classes")
    shared = classes.groupBy("head").agg(F.count("*").alias("classes")).where("classes > 1").select("head")
    place = F.struct("head", "class", F.col("rep.first").alias("first"), (F.col("rep.first") + F.col("width")).alias("last"))
    wanted = classes.join(shared, "head").groupBy(F.col("rep.doc_id").alias("doc_id")).agg(F.collect_list(place).alias("places"))
    wanted = lineage.settled(wanted, "wanted")
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    windows = texts.join(wanted, "doc_id").select("doc_id", "text", "places").mapInArrow(_extended, f"doc_id {kind}, head long, class long, words long, start long")
    windows = lineage.settled(windows, "windows")
    same = windows.groupBy("words").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "start")).alias("earliest")).where("n > 1").select("words", "earliest")
    same = lineage.settled(same, "same-words")
    bit = lambda place: F.call_function("shiftleft", F.lit(1).cast("long"), place.cast("int"))
    hits = windows.join(same, "words").withColumn("own", F.struct("doc_id", "start"))
    hits = hits.join(classes.select("head", "class", F.col("rep.first").alias("first")), ["head", "class"])
    own_bit = bit(F.col("start") - F.col("first"))
    masks = hits.groupBy("head", "class").agg(F.bit_or(own_bit).alias("some"), F.bit_or(F.when(F.col("own") != F.col("earliest"), own_bit).otherwise(F.lit(0).cast("long"))).alias("behind"))
    every = bit(F.col("width") + 1) - 1
    none = F.lit(0).cast("long")
    masked = classes.join(masks, ["head", "class"], "left").select(
        "head", "class", "rep", every.alias("every"), F.when(F.col("n") > 1, every).otherwise(F.coalesce("some", none)).alias("some"), F.coalesce("behind", none).alias("behind")
    )
    found = rows.join(lineage.settled(masked.where("some <> 0"), "masks"), ["head", "class"])
    first_of_class = F.struct("doc_id", "first") == F.col("rep")
    found = found.select("doc_id", "first", "last", "some", "every", F.when(first_of_class, F.col("behind").bitwiseAND(F.col("some"))).otherwise(F.col("some")).alias("behind"))
    whole = (F.col("some") == F.col("every")) & (F.col("behind") == 0) | (F.col("some") == F.col("every")) & (F.col("behind") == F.col("every"))
    run = lambda a, z, later: F.struct(a.alias("begin"), (z + LENGTH).alias("end"), later.alias("later"))
    has = lambda mask, at: F.col(mask).bitwiseAND(bit(at - F.col("first"))) != 0
    singles = F.transform(F.filter(F.sequence("first", "last"), lambda at: has("some", at)), lambda at: run(at, at, has("behind", at)))
    runs = F.when(whole, F.array(run(F.col("first"), F.col("last"), F.col("behind") != 0))).otherwise(singles)
    return found.select("doc_id", F.explode(runs).alias("run")).select("doc_id", "run.*")


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The longest repeating passages: doc_id, start and n_words (in words), and later_words, how many of
    them are in windows that stand at an earlier place too."""
    rows = repeating_windows(docs, id_col, text_col)
    before = Window.partitionBy("doc_id").orderBy("begin", "end", "later").rowsBetween(Window.unboundedPreceding, -1)
    begin = F.when(F.coalesce(F.col("begin") > F.max("end").over(before), F.lit(True)), F.col("begin"))
    covered = F.coalesce(F.max(F.when(F.col("later"), F.col("end"))).over(before), F.lit(0).cast("long"))
    fresh = F.when(F.col("later"), F.greatest(F.lit(0).cast("long"), F.col("end") - F.greatest("begin", covered))).otherwise(F.lit(0).cast("long"))
    rows = rows.select("doc_id", "begin", "end", begin.alias("opens"), fresh.alias("fresh"))
    upto = Window.partitionBy("doc_id").orderBy("begin", "end").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("start", F.max("opens").over(upto))
    return rows.groupBy("doc_id", "start").agg((F.max("end") - F.col("start")).alias("n_words"), F.sum("fresh").alias("later_words"))
