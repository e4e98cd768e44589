"""Exact order statistics without putting a whole group into one task.

A rank inside a group normally needs the group sorted in one place. Here the
value range is first cut by splitters, so that a cell (group, bucket) holds a
bounded share of the distinct values however large the group is. Ranks inside
a cell and the totals of the cells below it then give the exact global rank.

Splitters are the distinct values whose hash falls on a step, so they are the
same whenever Spark evaluates them again (after a lost executor, or in a second
branch of the plan), and only balance depends on them, never the result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenorlake.sources import lineage

ROWS_PER_CELL = 1_000_000


def splitters(df: DataFrame, value: str, rows_per_cell: int = ROWS_PER_CELL) -> Column:
    """Sorted array of about ``distinct / rows_per_cell`` values: a millionth of them by default."""
    picked = df.where(F.pmod(F.xxhash64(value), F.lit(rows_per_cell)) == 0)
    return picked.select(F.sort_array(F.collect_set(value))).scalar()


def with_bucket(df: DataFrame, value: str, cuts: Column, name: str = "_bucket") -> DataFrame:
    """Number of splitters <= value, found by halving strides, as many as their number asks for."""
    strides = "transform(sequence(length(bin(size(_cuts))) - 1, 0), k -> shiftleft(1, k))"
    bucket = F.expr(f"aggregate({strides}, 0, (at, step) -> if(`{value}` >= get(_cuts, at + step - 1), at + step, at))")
    return df.withColumn("_cuts", cuts).withColumn(name, bucket).drop("_cuts")


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi join in which null keys match each other; key columns of the left side stay."""
    right = right.select([F.col(c).alias(f"_right_{c}") if c in keys else F.col(c) for c in right.columns])
    condition = [left[k].eqNullSafe(right[f"_right_{k}"]) for k in keys]
    return left.join(right, condition, how).drop(*[f"_right_{k}" for k in keys])


def _class_totals(label: str) -> list[Column]:
    return [
        F.expr(f"cast(count_if(`{label}` = 1) as double) as _pos"),
        F.expr(f"cast(count_if(`{label}` != 1) as double) as _neg"),
    ]


def roc_auc(
    df: DataFrame, by: Sequence[str], label: str = "label", score: str = "prediction_proba",
    rows_per_cell: int = ROWS_PER_CELL,
) -> DataFrame:
    """ROC-AUC per group with ties counted half; null if only one class occurs.

    Pairs are never formed: positives of a cell meet all negatives of lower cells
    in one product, and negatives of their own cell through a running count.
    """
    rows = df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
    per_score = rows.groupBy(*by, score).agg(
        *_class_totals(label)
    )
    per_score = lineage.settled(per_score, "per-score")
    cells = with_bucket(per_score, score, splitters(per_score, score, rows_per_cell))
    inside = Window.partitionBy(*by, "_bucket").orderBy(score).rowsBetween(Window.unboundedPreceding, -1)
    below = F.coalesce(F.sum("_neg").over(inside), F.lit(0.0))
    per_cell = (
        cells.withColumn("_won", F.col("_pos") * (below + F.col("_neg") / 2))
        .groupBy(*by, "_bucket")
        .agg(F.sum("_pos").alias("_pos"), F.sum("_neg").alias("_neg"), F.sum("_won").alias("_won"))
    )
    across = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    lower = F.coalesce(F.sum("_neg").over(across), F.lit(0.0))
    totals = per_cell.withColumn("_won", F.col("_won") + F.col("_pos") * lower).groupBy(*by)
    both = (F.sum("_pos") > 0) & (F.sum("_neg") > 0)
    return totals.agg(F.when(both, F.sum("_won") / (F.sum("_pos") * F.sum("_neg"))).alias("roc_auc"))


def auc_and_median(
    df: DataFrame, by: Sequence[str], label: str = "label", score: str = "prediction_proba",
    median: str = "median", rows_per_cell: int = ROWS_PER_CELL,
) -> DataFrame:
    """ROC-AUC and exact median of the score per group.

    The cells of the median are known from the totals the AUC needs anyway, so only
    those few are looked at a second time.
    """
    rows = df.where(F.col(score).isNotNull())
    counts = rows.groupBy(*by, score).agg(*_class_totals(label), F.count(F.lit(1)).alias("_n"))
    return auc_and_median_of(counts, by, score, median, rows_per_cell)


def auc_and_median_of(
    counts: DataFrame, by: Sequence[str], score: str, median: str = "median", rows_per_cell: int = ROWS_PER_CELL
) -> DataFrame:
    """The same from one row per group and score with ``_pos``, ``_neg`` and ``_n``."""
    inside = Window.partitionBy(*by, "_bucket").orderBy(score).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cells = with_bucket(counts, score, splitters(counts, score, rows_per_cell))
    won = F.col("_pos") * (F.col("_neg_to") - F.col("_neg") / 2)
    per_cell = cells.withColumn("_neg_to", F.sum("_neg").over(inside)).groupBy(*by, "_bucket").agg(
        *[F.sum(c).alias(c) for c in ("_pos", "_neg", "_n")], F.sum(won).alias("_won")
    )
    group = Window.partitionBy(*by)
    running = group.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    start = F.sum("_n").over(running) - F.col("_n")
    below = F.sum("_neg").over(running) - F.col("_neg")
    placed = per_cell.select(
        *by, "_bucket", start.alias("_start"), F.col("_n").alias("_cell"),
        F.sum("_n").over(group).alias("_total"),
        (F.sum("_pos").over(group) * F.sum("_neg").over(group)).alias("_pairs"),
        (F.col("_won") + F.col("_pos") * below).alias("_won"),
    ).withColumn("_won", F.sum("_won").over(group))
    low, high = F.floor((F.col("_total") - 1) / 2), F.floor(F.col("_total") / 2)
    targets = placed.where((low < F.col("_start") + F.col("_cell")) & (high >= F.col("_start"))).select(
        *by, "_bucket", "_start", low.alias("_low"), high.alias("_high"),
        F.when(F.col("_pairs") > 0, F.col("_won") / F.col("_pairs")).alias("roc_auc"),
    )
    last = F.col("_start") + F.col("_n_to") - 1
    first = F.col("_start") + F.col("_n_to") - F.col("_n")

    def at(rank: str) -> Column:
        return F.max(F.when((F.col(rank) >= first) & (F.col(rank) <= last), F.col(score)))

    hits = null_safe_join(cells.select(*by, "_bucket", score, "_n"), targets, [*by, "_bucket"])
    hits = hits.withColumn("_n_to", F.sum("_n").over(inside))
    return hits.groupBy(*by).agg(
        F.max("roc_auc").alias("roc_auc"), ((at("_low") + at("_high")) / 2).cast("double").alias(median)
    )


def percentiles(
    df: DataFrame, by: Sequence[str], value: str, probabilities: Sequence[float],
    rows_per_cell: int = ROWS_PER_CELL,
) -> DataFrame:
    """Exact interpolated percentiles, one row per group and probability (``p``, ``percentile``)."""
    rows = df.where(F.col(value).isNotNull())
    per_value = rows.groupBy(*by, value).agg(F.count(F.lit(1)).alias("_n"))
    per_value = lineage.settled(per_value, "per-value")
    cells = with_bucket(per_value, value, splitters(per_value, value, rows_per_cell))

    across = Window.partitionBy(*by)
    running = across.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    position = (F.col("_total") - 1) * F.col("_p")
    targets = (
        cells.groupBy(*by, "_bucket")
        .agg(F.sum("_n").alias("_cell"))
        .withColumns({"_end": F.sum("_cell").over(running), "_total": F.sum("_cell").over(across)})
        .withColumn("_p", F.explode(F.array(*[F.lit(float(p)) for p in probabilities])))
        .withColumns({"_low": F.floor(position), "_high": F.ceil(position), "_start": F.col("_end") - F.col("_cell")})
        .where((F.col("_low") < F.col("_end")) & (F.col("_high") >= F.col("_start")))
        .groupBy(*by, "_bucket")
        .agg(
            F.max("_start").alias("_start"),
            F.max("_total").alias("_total"),
            F.sort_array(F.collect_list(F.struct("_low", "_high", "_p"))).alias("_targets"),
        )
    )
    inside = Window.partitionBy(*by, "_bucket").orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # the targets meet the values after these are sorted, so that no sort carries them
    ranked = null_safe_join(cells, targets.select(*by, "_bucket", "_start"), [*by, "_bucket"]).withColumn(
        "_end", F.col("_start") + F.sum("_n").over(inside)
    )
    ranked = null_safe_join(ranked, targets.select(*by, "_bucket", "_total", "_targets"), [*by, "_bucket"])
    first, last = F.col("_end") - F.col("_n"), F.col("_end") - 1

    def covers(rank: Column) -> Column:
        return (rank >= first) & (rank <= last)

    def targets_with(test: str) -> Column:
        """How many targets, in order of their ranks, pass the test; found by halving strides."""
        strides = ", ".join(str(1 << k) for k in reversed(range(max(1, len(probabilities)).bit_length())))
        return F.expr(f"aggregate(array({strides}), 0, (at, step) -> if(get(_targets, at + step - 1).{test}, at + step, at))")

    ranked = ranked.withColumn("_until", targets_with("_low < _end")).where("get(_targets, _until - 1)._high >= _end - _n")
    ranked = ranked.withColumn("_before", targets_with("_high < _end - _n"))
    hits = ranked.withColumn("_t", F.explode(F.slice("_targets", F.col("_before") + 1, F.col("_until") - F.col("_before"))))
    low = F.max(F.when(covers(F.col("_t._low")), F.col(value)))
    high = F.max(F.when(covers(F.col("_t._high")), F.col(value)))
    share = (F.max("_total") - 1) * F.col("p") - F.max("_t._low")
    return hits.groupBy(*by, F.col("_t._p").alias("p")).agg(
        (low + share * (high - low)).cast("double").alias("percentile")
    )


def column_medians(
    df: DataFrame, features: Sequence[str], accuracy: int = 10_000, rows_per_cell: int = ROWS_PER_CELL,
    slack: float | None = None,
) -> DataFrame:
    """Exact median of each column, one row per feature, without shuffling the values.

    A sketch per column brackets the median; an aggregate then counts what lies below
    and inside. A bracket that misses is widened, one that holds more than ``rows_per_cell`` values
    is cut by a sketch of its own inside, so what is shuffled and ranked in the end is bounded and
    always holds the median. The driver gets one row per pass.
    """
    columns = [F.col(f).cast("double") for f in features]
    first = 5.0 / accuracy if slack is None else slack

    def sketched(states: list[dict]) -> None:
        """New bounds for the columns that ask for them."""
        asked = [(c, s) for c, s in zip(columns, states, strict=True) if s["ask"]]
        if not asked:
            return
        parts = []
        for c, s in asked:
            inside = c if s["low"] is None else F.when(c.between(s["low"], s["high"]), c)
            low, high = (min(1.0, max(0.0, p)) for p in s["ask"])
            parts.append(F.struct(F.percentile_approx(inside, F.array(F.lit(low), F.lit(high)), F.lit(accuracy)).alias("q"), F.count(c).alias("n")))
        for (_, s), r in zip(asked, df.agg(F.array(*parts).alias("r")).first().r, strict=True):
            s["n"], s["ask"] = r.n, None
            s["now"] = tuple(r.q) if r.q else None

    def counted(states: list[dict]) -> None:
        """Values below and inside the new bounds, and with that the next step of each column."""
        open_ = [(c, s) for c, s in zip(columns, states, strict=True) if s["now"]]
        if not open_:
            return
        parts = [F.struct(F.count_if(c < s["now"][0]).alias("below"), F.count_if(c.between(*s["now"])).alias("inside")) for c, s in open_]
        for (_, s), r in zip(open_, df.agg(F.array(*parts).alias("r")).first().r, strict=True):
            low, high = (s["n"] - 1) // 2, s["n"] // 2
            holds = r.below <= low and high < r.below + r.inside
            if holds:
                s["low"], s["high"], s["below"] = *s["now"], r.below
                s["now"], s["spread"] = None, first
                if r.inside > rows_per_cell and s["low"] < s["high"] and r.inside < s.get("inside", r.inside + 1):
                    middle = (low - r.below + 0.5) / r.inside
                    s["ask"] = (middle - first, middle + first)
                s["inside"] = r.inside
            else:
                s["now"], s["spread"] = None, s["spread"] * 10
                base, width = (s["below"], s["inside"]) if s["low"] is not None else (0, s["n"])
                middle = (low - base + 0.5) / width
                s["ask"] = (middle - s["spread"], middle + s["spread"])

    states = [{"ask": (0.5 - first, 0.5 + first), "low": None, "high": None, "below": 0, "n": 0, "now": None, "spread": max(first, 1e-6)} for _ in features]
    while any(s["ask"] for s in states):
        sketched(states)
        counted(states)
    # A column without values has no row.
    entries = [
        F.when(c.between(s["low"], s["high"]), F.struct(F.lit(i).alias("f"), c.alias("v")))
        for i, (c, s) in enumerate(zip(columns, states, strict=True)) if s["low"] is not None
    ]
    if not entries:
        return df.sparkSession.createDataFrame([], "feature string, median double")
    names = F.array(*map(F.lit, features))
    first_rank = F.array(*[F.lit((s["n"] - 1) // 2 - s["below"]).cast("bigint") for s in states])
    last_rank = F.array(*[F.lit(s["n"] // 2 - s["below"]).cast("bigint") for s in states])
    ranked = df.select(F.inline(F.array_compact(F.array(*entries)))).groupBy("f", "v").agg(F.count(F.lit(1)).alias("k"))
    order = Window.partitionBy("f").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = ranked.withColumn("end", F.sum("k").over(order))

    def at(rank: Column) -> Column:
        return F.max(F.when((rank < F.col("end")) & (rank >= F.col("end") - F.col("k")), F.col("v")))

    middle = (at(F.get(first_rank, "f")) + at(F.get(last_rank, "f"))) / 2
    return ranked.groupBy("f").agg(middle.alias("median")).select(F.get(names, "f").alias("feature"), "median")


def medians(
    df: DataFrame, by: Sequence[str], value: str, name: str = "median", rows_per_cell: int = ROWS_PER_CELL
) -> DataFrame:
    """Exact median per group."""
    return percentiles(df, by, value, [0.5], rows_per_cell).drop("p").withColumnRenamed("percentile", name)
