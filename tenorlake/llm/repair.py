"""Repair of conversations whose turns are lost, repeated, cut or in the wrong role.

The cheapest edits that make the initials of a conversation's roles read ``(s?(ua)+)?`` are found on the edit lattice: a
node is a number of rows read and what was written last, an edge keeps (K), reroles (R), deletes (D) or inserts (I) a
turn. Dijkstra's search runs from both ends. Each side has a heap; the two meet, and go on while their tops
together cost no more than the best meeting, so every cheapest path has a crossing. At a node a side holds its
cheapest label and, among equals, the least letters. Two labels of a node with the same cost never begin one
another, so putting parts together keeps their order, and the least concatenation over all crossings is
the least audit. Edges without cost only go one row on; a heap takes nodes of the same cost row by row.

Rows are streamed: a task holds one block of ``BLOCK`` rows and the labels of four nodes, never a
conversation. A longer conversation is searched block by block, from each node at which a block can begin to each
at which it can end, and labels of blocks add up in the same order. The audit of a conversation and the hash of its
texts are one value each, so its rows meet in one task, in order; texts are shuffled once.

Which rows repeat earlier ones is settled before, from hashes: the first turn of each (conversation, role, text) that
occurs in more than one row, found by partial sums, is joined to the rows.

Defined results: rows without a conversation are one conversation; a null role or text is a space; null turns
come first; rows of the same turn are ordered by role and hash of text. A role that doesn't begin with s, u or a
can't be kept. An empty table gives no rows; extra columns stay out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenorlake.llm.common import slices

#: What edits cost, and what a kept or reroled turn without an end costs more.
REROLE, DELETE, INSERT, CUT = 2, 3, 2, 1
ROLES = {"u": "user", "a": "assistant"}
#: What may follow what was written last: nothing, s, u, a. A conversation may end at ENDS.
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
ENDS = (0, 3)
LEGAL = ("su", "ua", "au")
INITIALS = "sua-"
#: A row as a number: the place of its initial, and these.
DROP, OPEN = 4, 8
BLOCK = 256


def _steps(row: int, last: int) -> list[tuple[int, int, str]]:
    """Edges over a row: (what is written last then, cost, letter)."""
    out = [(last, DELETE, "D")]
    if not row & DROP:
        more = CUT if row & OPEN else 0
        kept = NEXT.get((last, INITIALS[row & 3]))
        if kept is not None:
            out.append((kept, more, "K"))
        out += [(NEXT[last, role], REROLE + more, "R") for role in ROLES if (last, role) in NEXT]
    return out


_INSERTS = [(last, NEXT[last, role]) for last in range(4) for role in ROLES if (last, role) in NEXT]
_STEPS = {row: [(last, *step) for last in range(4) for step in _steps(row, last)] for row in range(16)}


@lru_cache(maxsize=1 << 16)
def cheapest(rows: bytes, start: int, goals: tuple[int, ...]) -> tuple[int, str] | None:
    """Cost and least letters of the cheapest edits over all rows, from one node to the nearest of some."""
    n = len(rows)
    # A side's edges: of a node (rows read, last written), the nodes next to it on the way.
    ahead = lambda i, q: [(i, b, INSERT, "I") for a, b in _INSERTS if a == q] + ([(i + 1, b, c, x) for a, b, c, x in _STEPS[rows[i]] if a == q] if i < n else [])
    behind = lambda i, q: [(i, a, INSERT, "I") for a, b in _INSERTS if b == q] + ([(i - 1, a, c, x) for a, b, c, x in _STEPS[rows[i - 1]] if b == q] if i else [])
    labels = {(0, start): (0, "")}, {(n, q): (0, "") for q in goals}
    heaps = [(0, 0, start)], [(0, 0, q) for q in goals]
    done: tuple[set, set] = (set(), set())
    best = 0 if n == 0 and start in goals else float("inf")
    while heaps[0] and heaps[1] and heaps[0][0][0] + heaps[1][0][0] <= best:
        side = int(heaps[1][0] < heaps[0][0])
        cost, far, q = heappop(heaps[side])
        node = (n - far if side else far, q)
        if node in done[side]:
            continue
        done[side].add(node)
        letters = labels[side][node][1]
        for i, b, more, letter in (behind if side else ahead)(*node):
            label = (cost + more, letter + letters if side else letters + letter)
            if label < labels[side].get((i, b), (float("inf"), "")):
                labels[side][i, b] = label
                heappush(heaps[side], (label[0], n - i if side else i, b))
                other = labels[1 - side].get((i, b))
                if other:
                    best = min(best, label[0] + other[0])
    both = [(a[0] + z[0], a[1] + z[1]) for node, a in labels[0].items() if (z := labels[1].get(node))]
    return min(both, default=None)


class Search:
    """The cheapest edits of rows that come one after another."""

    def __init__(self):
        self.rows, self.labels = bytearray(), {0: (0, "")}

    def _block(self, goals: tuple[tuple[int, ...], ...]) -> None:
        rows, labels = bytes(self.rows), {}
        for goal in goals:
            parts = [(c + part[0], letters + part[1]) for q, (c, letters) in self.labels.items() if (part := cheapest(rows, q, goal))]
            if parts:
                labels[goal[0]] = min(parts)
        self.rows, self.labels = bytearray(), labels

    def add(self, row: int) -> None:
        if len(self.rows) == BLOCK:
            self._block(((0,), (1,), (2,), (3,)))
        self.rows.append(row)

    def end(self) -> tuple[int, str]:
        self._block((ENDS,))
        return self.labels[ENDS[0]]


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows as tuples of Python values, a slice at a time."""
    for batch in slices(batches, 1024):
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def _table(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _planning(id_type: pa.DataType) -> Callable:
    """Sorted facts to one row per conversation."""
    names, types = ["conv_id", *COUNTS, "audit"], [id_type, *[pa.int64()] * len(COUNTS), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        seen = object()  # no conversation yet
        search = counts = None

        def closed() -> tuple:
            cost, audit = search.end()
            gaps = last - first + 1 - turns if turns else 0
            return (seen, gaps, *counts, cost, audit)

        for conv, turn, initial, blank, again, cut, digest, gone in _groups(batches):
            if conv != seen:
                if counts is not None:
                    out.append(closed())
                seen, search, counts, before, turns, first, last, earlier = conv, Search(), [0, 0, 0, 0], None, 0, None, None, None
            if gone:
                continue
            if turn is not None and turn != last:
                first, last, turns = turn if first is None else first, turn, turns + 1
            again = again or (turn, digest) == earlier
            fault = 0 if blank else 1 if again else 2 if cut else 3
            if fault < 3:
                counts[fault] += 1
            counts[3] += before is not None and before + initial not in LEGAL
            search.add(INITIALS.index(initial) | (DROP if fault < 2 else OPEN if fault == 2 else 0))
            before, earlier = initial, (turn, digest)
            if len(out) >= 4096:
                yield _table(out, names, types)
                out = []
        if counts is not None:
            out.append(closed())
        yield _table(out, names, types)

    return run


def edited(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Plans, each before the rows it is about, to (conversation, its plan or None, repaired role, text).

    A plan comes alone first, with no role.
    """
    audit, at, written, odd = "", 0, 0, 0
    conv = None

    def upto_row() -> Iterator[tuple]:
        nonlocal at, written
        while at < len(audit) and audit[at] == "I":
            at, written = at + 1, written + 1
            yield conv, None, ROLES["ua"[(written + odd + 1) % 2]], ""

    for own, plan, role, text in rows:
        if plan is not None:
            yield from upto_row()
            conv, audit, at, written = own, plan[-1], 0, 0
            odd = (len(audit) - audit.count("D")) % 2
            yield conv, plan, None, None
            continue
        yield from upto_row()
        letter, at = audit[at], at + 1
        if letter != "D":
            written += 1
            yield conv, None, role if letter == "K" else ROLES["ua"[(written + odd + 1) % 2]], text
    yield from upto_row()


def _hashing(id_type: pa.DataType) -> Callable:
    names, types = ["conv_id", *COUNTS, "audit", "repaired_sha256"], [id_type, *[pa.int64()] * len(COUNTS), pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        open_: tuple | None = None
        for conv, plan, role, text in edited(_planned(batches)):
            if plan is not None:
                if open_:
                    out.append((*open_, state.hexdigest()))
                open_, state, first = (conv, *plan), hashlib.sha256(), True
            else:
                state.update((f"{role}:{text}" if first else f"\n{role}:{text}").encode())
                first = False
            if len(out) >= 4096:
                yield _table(out, names, types)
                out = []
        if open_:
            out.append((*open_, state.hexdigest()))
        yield _table(out, names, types)

    return run


def _writing(id_type: pa.DataType) -> Callable:
    names, types = ["conv_id", "turn", "role", "text"], [id_type, pa.int64(), pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        turn = 0
        for conv, plan, role, text in edited(_planned(batches)):
            if plan is not None:
                turn = 0
                continue
            out.append((conv, turn, role, text))
            turn += 1
            if len(out) >= 4096:
                yield _table(out, names, types)
                out = []
        yield _table(out, names, types)

    return run


def _planned(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for conv, role, text, *plan in _groups(batches):
        yield conv, (tuple(plan) if plan[-1] is not None else None), role, text


def _known(turns: DataFrame, gone: Column | None) -> DataFrame:
    """conv_id, turn, role, text, digest of (role, text), gone."""
    role, text = F.coalesce(F.col("role"), F.lit(" ")), F.coalesce(F.col("text"), F.lit(" "))
    digest = F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256))
    lost = F.lit(False) if gone is None else gone
    return turns.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"), digest.alias("digest"), lost.alias("gone"))


def plans(turns: DataFrame, gone: Column | None = None) -> DataFrame:
    """Per conversation its counts of faults, the cost and the letters of its cheapest edits.

    Rows for which ``gone`` holds only name their conversation.
    """
    known = _known(turns, gone)
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    end = F.right(F.rtrim("text", F.lit(" \t\n\x0b\f\r")), F.lit(1))
    initial = F.substring("role", 1, 1)
    facts = known.select(
        "conv_id", "turn", "role", "digest", "gone", blank.alias("blank"), (~end.isin(".", "!", "?")).alias("cut"),
        F.when(initial.isin("s", "u", "a"), initial).otherwise("-").alias("initial"),
    )
    # min skips nulls: a row without a turn is the first of all.
    unnumbered, least = F.count_if(F.col("turn").isNull()) > 0, F.min("turn")
    firsts = facts.where(~F.col("gone")).groupBy("conv_id", "digest").agg(F.count("*").alias("n"), unnumbered.alias("unnumbered"), least.alias("least"))
    firsts = firsts.where("n > 1").select(F.col("conv_id").alias("of"), F.col("digest").alias("what"), "unnumbered", "least")
    rows = facts.join(firsts, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("digest") == F.col("what")), "left")
    again = F.coalesce(F.col("turn").isNotNull() & (F.col("unnumbered") | (F.col("least") < F.col("turn"))), F.lit(False))
    rows = rows.select("conv_id", "turn", "initial", "blank", again.alias("again"), "cut", "digest", "gone", "role")
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "digest").drop("role")
    kind = rows.schema["conv_id"].dataType
    counts = ", ".join(f"{c} long" for c in COUNTS)
    return rows.mapInArrow(_planning(_arrow(kind)), f"conv_id {kind.simpleString()}, {counts}, audit string")


def _arrow(kind) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def _in_order(turns: DataFrame, planned: DataFrame, gone: Column | None) -> DataFrame:
    """Each plan, then the rows it is about."""
    rows = _known(turns, gone).where(~F.col("gone")).select("conv_id", F.lit(1).alias("place"), "turn", "role", "digest", "text", *[F.lit(None).cast("long").alias(c) for c in COUNTS], F.lit(None).cast("string").alias("audit"))
    heads = planned.select("conv_id", F.lit(0).alias("place"), *[F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in ("turn", "role", "digest", "text")], *COUNTS, "audit")
    both = heads.unionByName(rows).repartition("conv_id")
    both = both.sortWithinPartitions("conv_id", "place", F.col("turn").asc_nulls_first(), "role", "digest")
    return both.select("conv_id", "role", "text", *COUNTS, "audit")


def audited(turns: DataFrame, gone: Column | None = None) -> DataFrame:
    """:func:`plans` with the SHA-256 of the repaired conversation's lines ``role:text``."""
    rows = _in_order(turns, plans(turns, gone), gone)
    kind = rows.schema["conv_id"].dataType
    counts = ", ".join(f"{c} long" for c in COUNTS)
    return rows.mapInArrow(_hashing(_arrow(kind)), f"conv_id {kind.simpleString()}, {counts}, audit string, repaired_sha256 string")


def repaired(turns: DataFrame, gone: Column | None = None) -> DataFrame:
    """The repaired conversations: conv_id, turn from 0, role, text."""
    rows = _in_order(turns, plans(turns, gone), gone)
    kind = rows.schema["conv_id"].dataType
    return rows.mapInArrow(_writing(_arrow(kind)), f"conv_id {kind.simpleString()}, turn long, role string, text string")


def damaged(turns: DataFrame) -> DataFrame:
    """The rows with faults put in by a hash of conversation and turn; ``gone`` marks the dropped ones."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), (F.crc32(key) % 20).alias("fault"))
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")
    role = F.when(F.col("fault") == 4, "user").otherwise(F.col("role"))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("fault") == 0).alias("gone"), copies).drop("copy")
