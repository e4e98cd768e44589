"""Vector codes, conversation repair and line dedup against brute force, with the cases that are odd."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tenorlake.llm import linededup, queries, repair, vectorcodes

# 11


def brute_codes(rows, parts=4, entries=256, rounds=4):
    """rows: (vec_id, vector, label)."""
    kept = [(i, [math.floor(1024 * Fraction(x)) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = -(-max(len(v) for _, v, _ in kept) // parts)
    kept = [(i, v + [0] * (width * parts - len(v)), label) for i, v, label in kept]
    cut = lambda v: [tuple(v[p * width : (p + 1) * width]) for p in range(parts)]
    books = [[cut(v)[p] for _, v, _ in kept[:entries]] for p in range(parts)]
    gap = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))

    def assign(v):
        return [min((gap(part, e), k) for k, e in enumerate(book)) for part, book in zip(cut(v), books, strict=True)]

    for _ in range(rounds):
        held = collections.defaultdict(list)
        for _, v, _ in kept:
            for p, (_, k) in enumerate(assign(v)):
                held[p, k].append(cut(v)[p])
        for (p, k), own in held.items():
            books[p][k] = tuple(sum(c) // len(own) for c in zip(*own, strict=True))
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out = [(i, label, assign(v)) for i, v, label in kept]
    errors = collections.defaultdict(int)
    for _, label, found in out:
        errors[label] += sum(d for d, _ in found)
    short = lambda e: e if e < 2**63 else None
    return sorted(((i, "".join(f"{k:02x}" for _, k in f), short(sum(d for d, _ in f)), short(errors[label]), digest) for i, label, f in out), key=repr)


def codes_of(spark, rows, **options):
    df = spark.createDataFrame([(i, v, label, "x") for i, v, label in rows], "vec_id long, embedding array<double>, label int, code string")
    found = vectorcodes.compressed(df.repartition(3), **options)
    return sorted((tuple(r) for r in found.select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()), key=repr)


@pytest.mark.parametrize("dimensions", [8, 20, 12])
def test_codes_match_brute_force(spark, dimensions):
    rng = random.Random(dimensions)
    rows = [(i, [rng.gauss(rng.choice((-1, 0, 2)), 0.2) for _ in range(dimensions)], rng.choice((None, 1, 2))) for i in range(90)]
    rows += [(100 + i, rows[i][1], 1) for i in range(40)]  # ties
    rows += [(3, rows[7][1], 2), (3, rows[8][1], None), (None, rows[1][1], None)]  # repeated and missing ids
    rows += [(200, None, 1), (201, [1.0, None] * (dimensions // 2), 1), (202, [math.nan] * dimensions, 1), (203, [math.inf] * dimensions, 2)]
    assert codes_of(spark, rows, entries=16) == brute_codes(rows, entries=16)


def test_codes_of_large_and_uneven_numbers(spark):
    rows = [(1, [1e30, -3.25e18, 0.1, 5e-300], 1), (2, [1e30, 1.0, -0.1, 7.0], 1), (3, [0.5, 2.0], 2), (4, [1.0, -2.0, 3.0, 0.0], 2), (5, [], 3), (6, [1e6, -1e6, 1e6, 1e6], 3)]
    assert codes_of(spark, rows, entries=2) == brute_codes(rows, entries=2)
    assert {r[2] for r in codes_of(spark, rows, entries=1) if r[0] == 2} == {r[2] for r in brute_codes(rows, entries=1) if r[0] == 2}


def test_codes_of_an_empty_table(spark):
    assert codes_of(spark, []) == [] and codes_of(spark, [(1, None, 1)]) == []


def test_transform_is_in_order_of_sign_changes_and_keeps_distances():
    for size in (1, 2, 8, 32):
        rows = vectorcodes.transformed(np.eye(size, dtype=np.int64)).T
        assert [int((np.diff(r) != 0).sum()) for r in rows] == list(range(size))
    rng = np.random.default_rng(1)
    points, entries = rng.integers(-900, 900, (50, 11)), rng.integers(-900, 900, (30, 11))
    codes, distances = vectorcodes.nearest(vectorcodes.transformed(points), vectorcodes.transformed(entries))
    full = ((points[:, None] - entries[None]) ** 2).sum(axis=2)
    assert (codes == full.argmin(axis=1)).all() and (distances == full.min(axis=1)).all()


# 12

KINDS = [(initial, drop, cut) for initial in "sua-" for drop, cut in ((False, False), (False, True), (True, False))]


def brute_edits(rows):
    """Cheapest cost and least letters, by trying every number of rows and output so far."""
    best = None
    frontier = {("", 0): (0, "")}  # (what the conversation reads as, rows read)
    fits = re.compile(r"(s?(ua)+)?")
    for n in range(len(rows) + 1):
        for _ in range(3):  # insertions
            for (text, at), (cost, audit) in list(frontier.items()):
                for x in "ua":
                    new, key = (cost + 2, audit + "I"), (text + x, at)
                    if at == n and cost < 30 and len(text) < len(rows) + 3 and (key not in frontier or new < frontier[key]):
                        frontier[key] = new
        if n == len(rows):
            break
        initial, drop, cut = rows[n]
        for (text, at), (cost, audit) in list(frontier.items()):
            if at != n:
                continue
            steps = [(text, 3, "D")]
            if not drop:
                steps += [(text + x, 2 + cut, "R") for x in "ua"]
                steps += [(text + initial, int(cut), "K")] if initial in "sua" else []
            for new_text, more, letter in steps:
                new = (cost + more, audit + letter)
                if (new_text, n + 1) not in frontier or new < frontier[new_text, n + 1]:
                    frontier[new_text, n + 1] = new
    for (text, at), label in frontier.items():
        if at == len(rows) and fits.fullmatch(text) and (best is None or label < best):
            best = label
    return best


def number(row):
    initial, drop, cut = row
    return repair.INITIALS.index(initial) | (repair.DROP if drop else repair.OPEN if cut else 0)


def test_search_matches_brute_force(monkeypatch):
    rng = random.Random(3)
    cases = [list(c) for n in range(3) for c in itertools.product(KINDS, repeat=n)] + [[rng.choice(KINDS) for _ in range(rng.randint(3, 5))] for _ in range(60)]
    for rows in cases:
        want = brute_edits(rows)
        assert repair.cheapest(bytes(map(number, rows)), 0, repair.ENDS) == want
        for block in (1, 2, 3):
            monkeypatch.setattr(repair, "BLOCK", block)
            search = repair.Search()
            for row in rows:
                search.add(number(row))
            assert search.end() == want


def test_blocks_of_a_long_conversation_make_the_whole(monkeypatch):
    rng = random.Random(5)
    rows = bytes(number(rng.choice(KINDS)) for _ in range(400))
    monkeypatch.setattr(repair, "BLOCK", 37)
    search = repair.Search()
    for row in rows:
        search.add(row)
    assert search.end() == repair.cheapest(rows, 0, repair.ENDS)


SPACE = " \t\n\x0b\x0c\r"


def brute_conversation(rows):
    """rows after damage: (turn, role, text); the contract read word by word."""
    digest = lambda r: hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).hexdigest()
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], digest(r)))
    turns = {t for t, _, _ in rows if t is not None}
    seen, facts, counts = set(), [], collections.Counter()
    for _, role, text in rows:
        fault = "blank" if not text.strip(SPACE) else "duplicate" if (role, text) in seen else "truncated" if text.rstrip(SPACE)[-1] not in ".!?" else ""
        seen.add((role, text))
        counts[fault] += 1
        initial = role[:1] if role[:1] in ("s", "u", "a") else "-"
        facts.append((initial, fault in ("blank", "duplicate"), fault == "truncated"))
    illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in itertools.pairwise(facts))
    cost, audit = repair.cheapest(bytes(map(number, facts)), 0, repair.ENDS)
    total, at, place, lines = sum(x != "D" for x in audit), 0, 0, []
    for x in audit:
        role, text = ("", "") if x == "I" else rows[at][1:]
        at += x != "I"
        place += x != "D"
        if x != "D":
            lines.append(f"{role if x == 'K' else 'user' if (place + total) % 2 else 'assistant'}:{text}")
    assert re.fullmatch("(s?(ua)+)?", "".join(x[:1] for x in lines))
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    return gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


def brute_damage(rows):
    out = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        out[conv]  # noqa: B018
        role, text = (" " if x is None else x for x in (role, text))
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fault:
            text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
            out[conv] += [(turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    return out


def turns_of(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, audit string, gaps int")


def repaired_of(spark, rows):
    found = repair.audited(repair.damaged(turns_of(spark, rows).repartition(3)), F.col("gone"))
    return {r[0]: tuple(r)[1:] for r in found.collect()}


def test_conversations_match_brute_force(spark):
    rng = random.Random(7)
    texts = ["Yes.", "No!", "cut", " \n", "", None, "Long one? \t", "é.", "x: y.", "y."]
    rows = []
    for conv in [*range(60), None]:
        for turn in range(rng.randint(1, 9)):
            role = rng.choice(["system", "user", "user", "assistant", "assistant", "tool", "User", "", None, "x"])
            rows.append((conv, rng.choice([turn, turn, turn, None, turn // 2, 2 * turn]), role, rng.choice(texts)))
    rows += [(99, t, "user" if t % 2 else "assistant", f"{t % 40}.") for t in range(700)]
    rows += rows[:30]  # the same rows twice
    damaged = brute_damage(rows)
    assert repaired_of(spark, rows) == {conv: brute_conversation(own) for conv, own in damaged.items()}


def test_conversations_with_nothing_left(spark):
    gone = next(t for t in itertools.count() if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    empty = hashlib.sha256(b"").hexdigest()
    assert repaired_of(spark, [(5, gone, "user", "Yes.")]) == {5: (0, 0, 0, 0, 0, 0, "", empty)}
    assert repaired_of(spark, []) == {}


def test_repaired_conversations_alternate(spark):
    rows = [(1, 0, "system", "Be short."), (1, 1, "assistant", "Hello."), (1, 3, "user", "Why?"), (2, 0, "user", "Hi."), (2, 1, "user", "Hi."), (3, 0, "tool", "")]
    found = repair.repaired(turns_of(spark, rows)).orderBy("conv_id", "turn").collect()
    assert [tuple(r) for r in found] == [
        (1, 0, "system", "Be short."), (1, 1, "user", ""), (1, 2, "assistant", "Hello."), (1, 3, "user", "Why?"), (1, 4, "assistant", ""),
        (2, 0, "user", "Hi."), (2, 1, "assistant", ""),
    ]


# 13


def brute_lines(docs, least=20, documents=3):
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(SPACE))
    held = collections.defaultdict(list)
    for i, (doc_id, text) in enumerate(docs):
        for k in {key(line) for line in (text or "").split("\n")}:
            held[k].append((doc_id is not None, doc_id or 0, i))
    out = []
    for doc_id, text in docs:
        lines = (text or "").split("\n")
        kept = []
        for line in lines:
            own = held[key(line)]
            if len(key(line)) >= least and len(own) >= documents and max(own)[:2] != (doc_id is not None, doc_id or 0):
                continue
            kept.append(line)
        out.append((doc_id, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


def some_documents():
    rng = random.Random(11)
    shared = [f"Shared line number {i} with some more words" for i in range(30)] + ["short", "", "é" * 20, "É" * 20, "x" * 19, "y" * 20, "  ZYX " * 8]
    docs = []
    for i in range(120):
        lines = [rng.choice(shared) if rng.random() < 0.3 else f"own line {i} {j} " + "z" * rng.randint(0, 30) for j in range(rng.randint(1, 12))]
        lines = [rng.choice(["", " ", "\t", "\r"]) + (x.upper() if rng.random() < 0.2 else x) + rng.choice(["", " ", "\x0b"]) for x in lines]
        docs.append((i, "\n".join(lines)))
    docs += [(5, docs[5][1]), (5, docs[5][1]), (119, docs[119][1]), (None, docs[7][1]), (None, "A line that only rows without id hold")]
    docs += [(None, "A line that only rows without id hold")] * 2 + [(200, None), (201, ""), (202, "\n\n"), (203, "one two " * 3000)]
    return docs + [(300 + i, "The very common line of all documents\n" * 3) for i in range(200)]


def lines_of(spark, docs):
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, key string, row int")
    return sorted((tuple(r) for r in linededup.deduplicated(df.repartition(3)).collect()), key=repr)


def test_lines_match_brute_force(spark):
    docs = some_documents()
    assert lines_of(spark, docs) == brute_lines(docs)
    assert lines_of(spark, []) == []


def test_lines_without_room_for_all_filters(spark, monkeypatch):
    docs = some_documents()
    for limit in (0, 700):
        monkeypatch.setattr(linededup.suspects, "__defaults__", (linededup.LEAST, limit))
        assert lines_of(spark, docs) == brute_lines(docs)


def test_filters_never_miss_and_suspect_few():
    rng = np.random.default_rng(2)
    once, twice = np.unique(rng.integers(0, 1 << 63, 4000, dtype=np.uint64)), np.unique(rng.integers(0, 1 << 63, 100, dtype=np.uint64))
    parts = [np.unique(np.concatenate((once[i::4], twice[: 50 + 10 * i]))) for i in range(4)] + [twice] * 2
    rows = pa.RecordBatch.from_arrays([pa.array([0] * 6, pa.int64()), pa.array([p.tobytes() for p in parts], pa.binary()), pa.array([b""] * 6, pa.binary())], names=["shard", "once", "more"])
    (out,) = linededup._filtering(1 << 15)(iter([rows]))
    packed = np.frombuffer(zlib.decompress(out.column(1)[0].as_py()), np.uint8)
    assert len(packed) * 8 < 1 << 13  # folded
    assert linededup.holds_packed(packed, linededup.probes(twice)).all()
    assert linededup.holds_packed(packed, linededup.probes(once)).mean() < 0.1


@pytest.mark.parametrize("name", ["op11_vector_codes", "op12_conversation_repair", "op13_line_dedup"])
def test_reruns_agree(spark, name):
    run = lambda: sorted(map(repr, queries.QUERIES[name](spark, "/root/testdata/sf0.001").collect()))
    assert run() == run()
