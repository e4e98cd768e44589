"""SpotSigs fingerprints: chains of content words that follow common words.

Every common word of a text (the anchor) and the two content words after it make one
signature, hashed to 32 bits; a fingerprint is the sorted set of them. Texts that share
passages share signatures whatever surrounds the passages.

:func:`likeness` is the Jaccard index, pruned: where the sizes alone keep it below
a threshold the sets aren't compared. :func:`near` finds the pairs of a table above a
threshold: sets are put into classes of length so wide that a pair lies in one class or
in neighbours, and each set is listed only under its rarest signatures, as many as
guarantee that a pair above the threshold shares one.

Defined results: a text without signatures, the empty and the null text included, has the hash of the
whole text as its only one, so equal texts have equal fingerprints and likeness 1. Repeated rows are
fingerprinted each; an empty table gives no rows; other columns stay out.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenorlake.llm.common import TOKEN, found
from tenorlake.sources import lineage

#: Common words of English, French, German and Spanish. They are anchors, all other words content.
ANCHORS = (
    "the of and to in a is that it for was on with as be by this at are from "
    "de la le et les des en un du une que est pour dans au qui par pas sur avec "
    "der die und zu den von das mit sich für auf ist im nicht dem ein eine als "
    "el los se y del por las con una no para su lo al"
).split()


def signatures(rows: DataFrame, text_col: str, out: str) -> DataFrame:
    """The rows with the sorted signature set of a text column that holds no nulls."""
    words, places = f"{out}_words", f"{out}_places"
    rows = rows.withColumn(words, found(F.lower(text_col), TOKEN))
    content = F.transform(words, lambda x, i: F.when(~x.isin(*ANCHORS), i))
    rows = rows.withColumn(places, F.array_compact(content))
    w = lambda i: F.get(F.col(words), i)
    p = lambda k: F.get(F.col(places), k)

    def chains(at: Column, k: Column) -> Column:
        before = F.coalesce(p(k - 1), F.lit(-1))
        return F.transform(F.slice(words, before + 2, at - before - 1), lambda anchor: F.hash(anchor, w(at), w(p(k + 1))))

    sets = F.array_distinct(F.flatten(F.transform(places, chains)))
    rows = rows.withColumn(out, sets).drop(words, places)
    return rows.withColumn(out, F.sort_array(F.when(F.size(out) > 0, F.col(out)).otherwise(F.array(F.hash(text_col)))))


def likeness(a: Column, b: Column, threshold: float = 0.0) -> Column:
    """Jaccard index of two sets; 0 where their sizes keep it below the threshold."""
    fewer, more = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    common = F.size(F.array_intersect(a, b))
    return F.when(fewer >= threshold * more, common / (F.size(a) + F.size(b) - common)).otherwise(F.lit(0.0))


def text_of(signature_set: Column) -> Column:
    return F.array_join(signature_set.cast("array<string>"), " ")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, signatures (the sorted set) and fingerprint (the same as text)."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = signatures(rows, "text", "signatures")
    return rows.select("doc_id", "signatures", text_of(F.col("signatures")).alias("fingerprint"))


def near(prints: DataFrame, threshold: float = 0.75) -> DataFrame:
    """(set_a, set_b, likeness): pairs of different signature sets above a threshold, each once.

    Sets are numbered by a hash, so equal ones are one set whatever the number of documents; :func:`members`
    has the documents of each.
    """
    sets = prints.select(F.xxhash64("signatures").alias("set_id"), "signatures").dropDuplicates(["set_id"])
    n = F.size("signatures")
    length_class = F.floor(F.log(n.cast("double")) / -math.log(threshold) + 1e-9)
    rows = sets.select("set_id", n.alias("n"), length_class.alias("own_class"), F.explode("signatures").alias("signature"))
    rows = rows.join(rows.groupBy("signature").agg(F.count("*").alias("uses")), "signature")
    place = F.row_number().over(Window.partitionBy("set_id").orderBy("uses", "signature"))
    own = rows.withColumn("place", place).where(F.col("place") <= F.col("n") - F.ceil(threshold * F.col("n") - 1e-9) + 1).drop("place", "uses")
    left = own.withColumnsRenamed({"set_id": "set_a", "n": "n_a", "own_class": "class_a"})
    left = left.withColumn("own_class", F.explode(F.array(*[F.col("class_a") + s for s in (-1, 0, 1)])))
    right = own.withColumnsRenamed({"set_id": "set_b", "n": "n_b"})
    sized = (F.least("n_a", "n_b") >= threshold * F.greatest("n_a", "n_b")) & (F.col("set_a") < F.col("set_b"))
    pairs = left.join(right, ["own_class", "signature"]).where(sized).select("set_a", "set_b").distinct()
    a, b = sets.toDF("set_a", "signatures_a"), sets.toDF("set_b", "signatures_b")
    value = likeness(F.col("signatures_a"), F.col("signatures_b"), threshold).alias("likeness")
    return pairs.join(a, "set_a").join(b, "set_b").select("set_a", "set_b", value).where(F.col("likeness") >= threshold)


def members(prints: DataFrame) -> DataFrame:
    return prints.select(F.xxhash64("signatures").alias("set_id"), "doc_id")


def with_next(rows: DataFrame, key: str, tie: str, columns: list[str], per_block: int = 512, segments: int = 1024) -> DataFrame:
    """The rows with ``next_<column>`` of the row that follows by key (a whole number); the first follows the last.

    Rows are cut into blocks of neighbours, and the first row of each block is sent to the block before it as well, so
    each block has all it needs and no task sees the whole order. Blocks are cut by rank first: ``segments`` quantiles
    of the keys bound segments, and each is cut evenly into as many blocks as its rows ask for. So a key far from all others
    widens the blocks of its own segment alone. Rows without a key come first, in an order by a hash of the column ``tie``; so
    are equal keys. Either are cut by that hash, where they are many. Rows equal in key and tie are in one block.
    """
    rows = in_blocks(rows, key, tie, per_block, segments)
    guests = _guests(rows.groupBy("block").agg(F.min(F.struct("place", "tie")).alias("first")))
    # Written, so that its small size is known before the rows are read, and they stay where they are.
    guests = lineage.settled(guests, "guests")
    rows = rows.join(guests, F.col("place").eqNullSafe(F.col("g_place")) & (F.col("tie") == F.col("g_tie")), "left")
    rows = _dealt(rows)
    following = Window.partitionBy("block").orderBy("guest", "place", "tie")
    return rows.withColumns({f"next_{c}": F.lead(c).over(following) for c in columns}).where(~F.col("guest")).drop("block", "guest", "place", "tie")


def in_blocks(rows: DataFrame, key: str, tie: str, per_block: int = 512, segments: int = 1024) -> DataFrame:
    """The rows with ``place`` (the key), ``tie`` and ``block``; blocks are in the order of (place, tie)."""
    bounds = _segments(rows.select(F.col(key).cast("long").alias("k")), segments)
    rows = rows.withColumns({"tie": F.xxhash64(tie), "place": F.col(key).cast("long")}).withColumn("seg", _segment_of("place", bounds))
    sizes = rows.groupBy("seg").agg(F.count("*").alias("n"), F.min("place").alias("a"), F.max("place").alias("z")).collect()  # one for each segment
    cuts = {r.seg: _cut(r.n, 1 if r.a is None else r.z - r.a + 1, per_block) for r in sizes}
    by_key, by_tie = (
        F.element_at(_longs([cuts.get(g, (0, UNCUT))[i] for g in range(len(bounds) + 2)]), F.col("seg") + 1).cast("int") for i in (0, 1)
    )
    cut = F.call_function("shiftright", F.coalesce("place", F.lit(0)), by_key)
    cut_tie = F.when(by_tie == UNCUT, 0).otherwise(F.call_function("shiftright", "tie", by_tie))
    return rows.withColumn("block", F.struct("seg", cut.alias("cut"), cut_tie.alias("cut_tie"))).drop("seg")


UNCUT = 64


def _segments(keys: DataFrame, segments: int) -> list[int]:
    """Least keys of the segments, in order. A key that holds several quantiles has a segment of its own."""
    shares = [i / segments for i in range(segments)]
    found = keys.agg(F.percentile_approx("k", shares, 10 * segments)).first()[0] or []
    starts = set(found)
    starts |= {k + 1 for k, after in zip(found, found[1:], strict=False) if k == after and k < 2**63 - 1}
    return sorted(starts)[1:]


def _segment_of(column: str, bounds: list[int]) -> Column:
    """0 for a null, else 1 and the number of bounds not above; looked up in two steps of some 32 comparisons."""
    if not bounds:
        return F.when(F.col(column).isNull(), 0).otherwise(1)
    parts = [bounds[i : i + 32] for i in range(0, len(bounds), 32)]
    not_above = lambda x: x <= F.col(column)
    part = F.size(F.filter(_longs([p[0] for p in parts]), not_above))
    inside = F.size(F.filter(F.element_at(F.array(*map(_longs, parts)), F.greatest(part, F.lit(1))), not_above))
    below = F.when(part == 0, 0).otherwise((part - 1) * 32 + inside)
    return F.when(F.col(column).isNull(), 0).otherwise(1 + below)


def _cut(n: int, wide: int, per_block: int) -> tuple[int, int]:
    """Bits of the key and of the hash that a block leaves out; the hash counts where the segment is one key."""
    blocks = max(1, n // per_block)
    if wide == 1:
        return 0, UNCUT - math.ceil(math.log2(blocks))
    return max(0, math.ceil(math.log2(wide / blocks))), UNCUT


def _longs(values: list[int]) -> Column:
    return F.array(*[F.lit(v).cast("long") for v in values])


def _guests(firsts: DataFrame) -> DataFrame:
    """The first row of each block and the block before, which it visits.

    Blocks are put in order inside their segment; only one row per segment is put in order with the others.
    """
    within = Window.partitionBy("block.seg").orderBy("block")
    across = Window.orderBy("seg")
    lasts = firsts.groupBy(F.col("block.seg").alias("seg")).agg(F.max("block").alias("last"))
    before = lasts.select(F.col("seg").alias("s"), F.coalesce(F.lag("last").over(across), F.max("last").over(Window.partitionBy())).alias("before"))
    placed = firsts.withColumn("to_block", F.lag("block").over(within)).join(before, F.col("block.seg") == F.col("s"))
    return placed.select(F.coalesce("to_block", "before").alias("to_block"), F.col("first.place").alias("g_place"), F.col("first.tie").alias("g_tie"))


def _dealt(rows: DataFrame) -> DataFrame:
    """Each row in its own block, and guests once more in the block before."""
    stay = F.struct(F.col("block"), F.lit(False).alias("guest"))
    visit = F.when(F.col("to_block").isNotNull(), F.struct(F.col("to_block").alias("block"), F.lit(True).alias("guest")))
    to = F.explode(F.array_compact(F.array(stay, visit))).alias("to")
    kept = [c for c in rows.columns if c not in ("block", "to_block", "g_place", "g_tie")]
    return rows.select(*kept, to).select(*kept, "to.block", "to.guest")


def edited_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document's fingerprint, that of its text with the last half replaced by the start of the next
    document, and how alike it is to either neighbour."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = with_next(signatures(rows, "text", "own"), "doc_id", "text", ["text", "own"])
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half))
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), "own", "next_own")
    rows = signatures(rows, "edited", "other")
    return rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        text_of(F.col("own")).alias("fingerprint"), text_of(F.col("other")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("other")).alias("near_edited"), likeness(F.col("own"), F.col("next_own")).alias("near_next"),
    )
