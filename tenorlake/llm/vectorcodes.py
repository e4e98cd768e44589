"""Product codes of vectors, learned and assigned in whole numbers.

A component x becomes floor(scale * x). A vector is cut into equal consecutive parts; each part has a
codebook, and its code is the index of the nearest entry. Codebooks begin as the parts of the vectors with
the smallest ids and move to the floor of the mean of their parts, round by round.

The nearest entry is searched after a Walsh-Hadamard transform. Parts and entries are padded with zeros to a power
of two P; the transform keeps whole numbers whole and multiplies squared distances by P. Its coefficients are
summed from the slowest sign changes to the fastest (sequency order), and an entry is out as soon as its sum so
far exceeds the full distance of the entry that led after the first coefficients. Sums only grow, so no
nearest entry is ever lost, and ties stay for the lowest index to win. Sums are 64-bit where they provably fit and Python's
whole numbers elsewhere; nothing is rounded.

A round is one pass: tasks add up the parts of each entry, Spark adds up the tasks' sums, the driver
gets entries * dimensions sums and no vectors. The table is read once per round, so settle an expensive plan first.

Defined results: vectors that are null or hold nulls, infinities or NaN are dropped; others are
padded with zeros to the longest one, and that to a multiple of the parts. Fewer vectors than entries make a smaller
codebook. Repeated ids are ordered by their vectors, null ids come last. An error beyond a long is null, and so is the sum over
its label. An empty table gives no rows; extra columns stay out.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenorlake.llm.common import slices
from tenorlake.sources import lineage

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Coefficients summed for all entries, and then at a time for those still in.
FIRST, STEP = 4, 4
#: Vectors that are compared at a time.
ROWS = 1024
#: Sums travel in digits of 40 bits: those of eight million tasks add up within a long.
DIGIT = 40
LONGEST = 2**63 - 1


@dataclass(frozen=True)
class Codebooks:
    """``entries[part]`` is a matrix of whole numbers, a row per entry."""

    entries: list[np.ndarray]
    scale: int

    @property
    def width(self) -> int:
        return self.entries[0].shape[1]

    def digest(self) -> str:
        """SHA-256 of all components by part, entry and position, joined by commas."""
        return hashlib.sha256(",".join(str(int(x)) for part in self.entries for x in part.ravel()).encode()).hexdigest()


def finite(vector: Column) -> Column:
    """Vectors without a null, infinite or undefined component."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(math.inf))
    return vector.isNotNull() & ~F.exists(vector.cast("array<double>"), bad)


def fits(*values: np.ndarray) -> bool:
    """Whether squared distances of these parts, times the padded width, stay within a long."""
    width = _padded(values[0].shape[1])
    largest = max((int(abs(v).max()) for v in values if v.size), default=0)
    return 4 * width * width * (largest + 1) ** 2 < LONGEST


def whole(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x), exactly; Python's whole numbers where 64 bits may not do."""
    if scale & (scale - 1) == 0 and (not values.size or float(abs(values).max()) < 2**52 / scale):
        return np.floor(values * scale).astype(np.int64)
    exact = np.empty(values.size, dtype=object)
    exact[:] = [math.floor(Fraction(x) * scale) for x in values.ravel().tolist()]
    return exact.reshape(values.shape)


def _padded(width: int) -> int:
    return 1 << max(0, width - 1).bit_length()


def sequency(size: int) -> np.ndarray:
    """Places of the transform's coefficients in order of their sign changes."""
    bits = size.bit_length() - 1
    gray = np.arange(size) ^ (np.arange(size) >> 1)
    return sum((((gray >> b) & 1) << (bits - 1 - b) for b in range(bits)), np.zeros(size, dtype=np.int64))


def transformed(parts: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard coefficients of the zero-padded rows, in sequency order."""
    rows, width = parts.shape
    size = _padded(width)
    out = np.zeros((rows, size), dtype=parts.dtype)
    out[:, :width] = parts
    half = 1
    while half < size:
        pairs = out.reshape(rows, size // (2 * half), 2, half)
        out = np.stack((pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]), axis=2).reshape(rows, size)
        half *= 2
    return out[:, sequency(size)]


def nearest(points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest row of ``entries`` for each of ``points``, and the distance; both are transformed."""
    size = points.shape[1]
    total = np.zeros((len(points), len(entries)), dtype=points.dtype)
    for i in range(min(FIRST, size)):
        gap = points[:, i, None] - entries[None, :, i]
        total += gap * gap
    lead = entries[total.argmin(axis=1)]
    limit = ((points - lead) ** 2).sum(axis=1)
    rows, columns = np.nonzero(total <= limit[:, None])
    sums = total[rows, columns]
    for i in range(FIRST, size, STEP):
        gap = points[rows, i : i + STEP] - entries[columns, i : i + STEP]
        sums = sums + (gap * gap).sum(axis=1)
        left = np.asarray(sums <= limit[rows], dtype=bool)
        rows, columns, sums = rows[left], columns[left], sums[left]
    starts = np.flatnonzero(np.diff(rows, prepend=-1))
    least = np.minimum.reduceat(sums, starts) if len(starts) else sums
    ties = np.asarray(sums == least[rows], dtype=bool) if len(starts) else np.zeros(0, dtype=bool)
    first = np.unique(rows[ties], return_index=True)[1]
    return columns[ties][first], least // size


def _vectors(batch: pa.RecordBatch, dimensions: int, scale: int) -> np.ndarray:
    """The batch's vectors as whole numbers, padded with zeros."""
    lists = batch.column(batch.schema.get_field_index("v"))
    values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
    rows = np.repeat(np.arange(len(lengths)), lengths)
    places = np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    known = whole(values, scale)
    out = np.zeros((len(lengths), dimensions), dtype=known.dtype)
    out[rows, places] = known
    return out


def _assigned(vectors: np.ndarray, books: Codebooks) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each part: its vectors, codes and distances."""
    for p, entries in enumerate(books.entries):
        part = vectors[:, p * books.width : (p + 1) * books.width]
        kind = np.int64 if fits(part, entries) else object
        codes, distances = nearest(transformed(part.astype(kind)), transformed(entries.astype(kind)))
        yield part, codes, distances


def _summing(books: Codebooks) -> Callable:
    """Sums of the parts of each entry: (slot, place, digit, value), the place after the last being the count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width, count = books.width, [len(e) for e in books.entries]
        sums = [np.zeros((n, width + 1), dtype=object) for n in count]
        for batch in slices(batches, ROWS):
            for p, (part, codes, _) in enumerate(_assigned(_vectors(batch, width * len(count), books.scale), books)):
                own = np.zeros((count[p], width + 1), dtype=part.dtype)
                np.add.at(own, codes, np.hstack((part, np.ones((len(part), 1), dtype=part.dtype))))
                used = np.unique(codes)
                sums[p][used] += own[used].astype(object)
        out: list[tuple[int, int, int, int]] = []
        for p, own in enumerate(sums):
            for entry in np.flatnonzero(own[:, width]):
                for place, value in enumerate(own[entry]):
                    sign, value, digit = (-1 if value < 0 else 1), abs(int(value)), 0
                    while value:
                        out.append((p * ENTRIES + int(entry), place, digit, sign * (value % (1 << DIGIT))))
                        value, digit = value >> DIGIT, digit + 1
        columns = list(zip(*out, strict=True)) or [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.int32(), pa.int64()), strict=True)], names=["slot", "place", "digit", "value"])

    return run


def _coding(books: Codebooks) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, ROWS):
            found = list(_assigned(_vectors(batch, books.width * len(books.entries), books.scale), books))
            codes = ["".join(f"{c:02x}" for c in row) for row in zip(*(c.tolist() for _, c, _ in found), strict=True)]
            errors = [sum(int(d) for d in row) for row in zip(*(d.tolist() for _, _, d in found), strict=True)]
            rest = [batch.column(batch.schema.get_field_index(c)) for c in ("vec_id", "label")]
            fitting = pa.array([e if e <= LONGEST else None for e in errors], pa.int64())
            yield pa.RecordBatch.from_arrays([*rest, pa.array(codes, pa.string()), fitting], names=["vec_id", "label", "code", "error"])

    return run


def learned(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> Codebooks | None:
    """Codebooks of a table's vectors, or None without any."""
    if entries > ENTRIES:
        raise ValueError(f"a code has two hex digits: {ENTRIES} entries at most")
    kept = vectors.where(finite(F.col(vec_col))).select(F.col(id_col).alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"))
    longest = kept.agg(F.max(F.size("v"))).first()[0]
    if longest is None:
        return None
    width = -(-longest // parts)
    begin = [row.v for row in kept.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).collect()]
    padded = whole(np.array([v + [0.0] * (width * parts - len(v)) for v in begin], dtype=np.float64), scale)
    books = Codebooks([padded[:, p * width : (p + 1) * width] for p in range(parts)], scale)
    for _ in range(rounds):
        tasks = kept.select("v").mapInArrow(_summing(books), "slot int, place int, digit int, value long")
        sums: dict[int, list[int]] = {}
        for row in tasks.groupBy("slot", "place", "digit").agg(F.sum("value").alias("value")).collect():
            sums.setdefault(row.slot, [0] * (width + 1))[row.place] += row.value << (DIGIT * row.digit)
        moved = [e.astype(object) for e in books.entries]
        for slot, own in sums.items():
            moved[slot // ENTRIES][slot % ENTRIES] = [x // own[width] for x in own[:width]]
        books = Codebooks([m.astype(np.int64) if fits(m) else m for m in moved], scale)
    return books


def coded(vectors: DataFrame, books: Codebooks, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """vec_id, label, code and error of every finite vector."""
    kept = vectors.where(finite(F.col(vec_col)))
    kept = kept.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.col(vec_col).cast("array<double>").alias("v"))
    kinds = {f.name: f.dataType.simpleString() for f in kept.schema.fields}
    return kept.mapInArrow(_coding(books), f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long")


def compressed(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", **options) -> DataFrame:
    """vec_id, label, code, error, the error summed over equal labels, and the digest of the codebooks."""
    books = learned(vectors, id_col, vec_col, **options)
    if books is None:
        nothing = vectors.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label")).limit(0)
        return nothing.select("*", *[F.lit(None).cast(t).alias(c) for c, t in (("code", "string"), ("error", "long"), ("label_error", "long"), ("codebooks_sha256", "string"))])
    codes = lineage.settled(coded(vectors, books, id_col, vec_col, label_col), "codes")
    # Sums are made per task first, and Spark can split a label that holds many rows in the join.
    total = F.when(F.count("error") == F.count("*"), F.sum(F.col("error").cast("decimal(38,0)")).try_cast("long"))
    sums = codes.groupBy("label").agg(total.alias("label_error")).withColumnRenamed("label", "of")
    rows = codes.join(sums, F.col("label").eqNullSafe(F.col("of")), "left")
    return rows.select("vec_id", "label", "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))
