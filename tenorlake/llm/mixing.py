"""Mixing sources to target weights by capped water-filling.

Every source has a weight and may be repeated ``max_epochs`` times at most. Shares grow
with the weights until a source reaches its cap; what it can't take goes to the others
by weight, until none is above its cap. That is one water level: a source gets the
smaller of its cap and weight x level.

A source is then taken in whole repetitions, and the rest of its target as a seeded
sample: documents in the order of a hash until the rest is used up; the last one is
taken in part. The order is cut into 4,096 cells by the first hash digits, so the running
sum needs one row per (source, cell), and only the cell that holds the limit is
ordered document by document, whatever the size of the source.

One window runs over the table of sources (one row each), which gives the weights
their order. Rows are never collected.

Defined results: a null text has size 0; a null source is a source, the last one; a null
id is a row like any other; repeated rows are separate documents; an empty table gives
no rows; other columns are kept by :func:`mix` unless an added column has their name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenorlake.llm.common import WORD, found
from tenorlake.sources import lineage

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = "mix-1"


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def order_key(row_id: Column, seed: str) -> Column:
    return F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(row_id.cast("string"), F.lit(""))), 256), 1, 16)


def targets(sources: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size) to the same with its target; sources weigh in code-point order, null last."""
    names = Window.orderBy(F.col("source").isNull(), "source")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.row_number().over(names) - 1) % len(weights) + 1).cast("int"))
    ranked = sources.withColumn("weight", weight).withColumn("cap", F.col("source_size") * max_epochs)
    ratio = F.col("cap") / F.col("weight")
    by_ratio = Window.orderBy(ratio, F.col("source").isNull(), "source")
    everything = Window.partitionBy()
    before = F.coalesce(F.sum("cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
    # The level rises while sources are capped and falls afterwards: the greatest is the level.
    return (
        ranked.withColumn("level", (F.sum("source_size").over(everything) - before) / left)
        .withColumn("level", F.max("level").over(everything))
        .select("source", "source_size", F.least(F.col("cap").cast("double"), F.col("weight") * F.col("level")).alias("target"))
    )


def plan(docs: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED, id_col="doc_id", text_col="text", source_col="source") -> DataFrame:
    """One row per source: target, whole repetitions, and the cell and sum at which its sample ends."""
    cells = lineage.settled(
        docs.select(F.col(source_col).alias("source"), F.substring(order_key(F.col(id_col), seed), 1, 3).alias("cell"), size_of(F.col(text_col)).alias("size"))
        .groupBy("source", "cell")
        .agg(F.sum("size").alias("size")),
        "mix-cells",
    )
    sources = targets(cells.groupBy("source").agg(F.sum("size").alias("source_size")), weights, max_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    sources = sources.withColumn("whole", whole).withColumn("quota", F.round(F.col("target") - F.col("whole") * F.col("source_size")).cast("long"))
    upto = Window.partitionBy("source").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    edges = (
        cells.withColumn("edge_sum", F.coalesce(F.sum("size").over(upto), F.lit(0)))
        .withColumnRenamed("source", "of")
        .join(sources, F.col("of").eqNullSafe(F.col("source")))
        .where((F.col("edge_sum") < F.col("quota")) & (F.col("edge_sum") + F.col("size") >= F.col("quota")))
        .select("of", F.col("cell").alias("edge"), "edge_sum")
    )
    return lineage.settled(
        sources.join(edges, F.col("of").eqNullSafe(F.col("source")), "left").select("source", "source_size", "target", "whole", "quota", F.coalesce("edge", F.lit("")).alias("edge"), "edge_sum"),
        "mix-plan",
    )


def _taken(docs: DataFrame, weights, max_epochs: int, seed: str, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """The row as a struct, its size, its source's size and target, and the words taken of it."""
    sources = plan(docs, weights, max_epochs, seed, id_col, text_col, source_col).withColumnRenamed("source", "of")
    rows = docs.select(
        F.struct("*").alias("row"), F.col(source_col).alias("source"), order_key(F.col(id_col), seed).alias("key"),
        size_of(F.col(text_col)).alias("size"), F.substring(order_key(F.col(id_col), seed), 1, 3).alias("cell"),
    )
    rows = rows.join(sources, F.col("source").eqNullSafe(F.col("of")))
    whole = F.col("whole") * F.col("size")
    clear = rows.where(F.col("cell") != F.col("edge")).withColumn("taken", whole + F.when(F.col("cell") < F.col("edge"), F.col("size")).otherwise(0))
    order = Window.partitionBy("source").orderBy("key", F.col("row").getField(id_col), "size", F.col("row").getField(text_col))
    before = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1))
    rest = F.col("quota") - F.col("edge_sum") - F.coalesce(before, F.lit(0))
    partly = rows.where(F.col("cell") == F.col("edge")).withColumn("taken", whole + F.greatest(F.lit(0), F.least(F.col("size"), rest)))
    return clear.unionByName(partly).select("row", "size", "source_size", "target", F.col("taken").cast("long").alias("taken"))


def mix(docs: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED, id_col="doc_id", text_col="text", source_col="source") -> DataFrame:
    """Every document with size, source_size, target (of its source) and taken (words the mix takes)."""
    added = ["size", "source_size", "target", "taken"]
    kept = [F.col("row").getField(c).alias(c) for c in docs.columns if c not in added]
    return _taken(docs, weights, max_epochs, seed, id_col, text_col, source_col).select(*kept, *added)


def repeated(docs: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED, id_col="doc_id", text_col="text", source_col="source") -> DataFrame:
    """The mixed documents: a row per repetition. A repetition in part has the first words of the
    text with the white space between them; documents without words are in no repetition."""
    taken = _taken(docs, weights, max_epochs, seed, id_col, text_col, source_col).where(F.col("taken") > 0)
    copies = taken.select("row", "size", F.explode(F.sequence(F.col("taken"), F.lit(1).cast("long"), -F.col("size"))).alias("left"))
    whole = F.col("row").getField(text_col)
    cut = F.array_join(F.slice(found(whole, r"[\x20\x09-\x0D]*" + WORD), F.lit(1), F.col("left").cast("int")), "")
    text = F.when(F.col("left") >= F.col("size"), whole).otherwise(cut)
    return copies.select(*[text.alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns])
