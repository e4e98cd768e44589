"""Gradient-boosted trees for two classes: squared-error splits, Newton leaves, least sizes of nodes and leaves.

Each tree is fitted to the residuals of the log loss. A split is the one that lowers their squared error most, among
cuts between quantile bins; a node with fewer than ``min_split`` rows stays a leaf, and no side of a split
has fewer than ``min_leaf``. A leaf's value is one Newton step, the sum of its residuals over the sum of p (1 - p).

The rows are written once with a bin number per feature. A level of a tree is one aggregate over
(node, feature, bin), summed per task first; the driver gets at most nodes * features * bins sums, and never a row.
Sums are of whole multiples of a small power of two, so they don't depend on the order of the rows, and a fit can be repeated.
Margins are written back every ``SETTLE`` trees, which keeps the expression that follows from the trees short.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml.feature import Bucketizer, SQLTransformer, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenorlake.operators import ranking
from tenorlake.sources import lineage

MAX_BINS = 256
SETTLE = 10
#: Gains count to so many digits after the point; among equals the first feature and the lowest cut win.
GAIN_DIGITS = 6


@dataclass(frozen=True)
class Node:
    """A split, or a leaf if it has no feature. Node 1 is the root, 2k and 2k + 1 are the sides of k."""

    n: int
    value: float
    feature: int | None = None
    cut: int = 0
    threshold: float = 0.0
    gain: float = 0.0


@dataclass(frozen=True)
class Ensemble:
    features: tuple[str, ...]
    start: float
    step: float
    trees: list[dict[int, Node]] = field(default_factory=list)

    def importances(self) -> list[float]:
        """Share of each feature in the error the splits took away, per row of the tree they belong to."""
        sums = [0.0] * len(self.features)
        for tree in self.trees:
            for node in tree.values():
                if node.feature is not None:
                    sums[node.feature] += node.gain / tree[1].n
        total = sum(sums)
        return [s / total if total else 0.0 for s in sums]

    def nodes(self, spark: SparkSession) -> DataFrame:
        """A row per node: what it splits on, or the value of a leaf."""
        rows = [
            (t, k, None if n.feature is None else self.features[n.feature], None if n.feature is None else n.threshold, n.n, None if n.feature is None else n.gain, n.value if n.feature is None else None)
            for t, tree in enumerate(self.trees)
            for k, n in tree.items()
        ]
        return spark.createDataFrame(rows, "tree int, node int, feature string, threshold double, n long, gain double, value double")

    def stages(self, medians: Sequence[float]) -> list:
        """Spark ML stages from raw features to ``probability`` and ``prediction``."""
        names = [f"_z{i}" for i in range(len(self.features))]
        filled = ", ".join(f"coalesce(`{f}`, {m!r}D) AS `{z}`" for f, m, z in zip(self.features, medians, names, strict=True))

        def value(tree: dict[int, Node], k: int) -> str:
            node = tree[k]
            if node.feature is None:
                return f"{node.value!r}D"
            return f"CASE WHEN `{names[node.feature]}` < {node.threshold!r}D THEN {value(tree, 2 * k)} ELSE {value(tree, 2 * k + 1)} END"

        margin = " + ".join([f"{self.start!r}D", *(f"{self.step!r}D * ({value(t, 1)})" for t in self.trees)])
        return [
            SQLTransformer(statement=f"SELECT *, {filled} FROM __THIS__"),
            SQLTransformer(statement=f"SELECT * EXCEPT ({', '.join(names)}), 1 / (1 + exp(-({margin}))) AS _p1 FROM __THIS__"),
            SQLTransformer(statement="SELECT *, 1 - _p1 AS _p0, IF(_p1 > 0.5, 1D, 0D) AS prediction FROM __THIS__"),
            VectorAssembler(inputCols=["_p0", "_p1"], outputCol="probability"),
            SQLTransformer(statement="SELECT * EXCEPT (_p0, _p1) FROM __THIS__"),
        ]


def quantile_cuts(train: DataFrame, features: Sequence[str], max_bins: int = MAX_BINS) -> list[list[float]]:
    """For each feature the distinct values at ``max_bins`` even steps of its distribution, without the ends."""
    values = train.select(F.inline(F.array(*[F.struct(F.lit(i).alias("f"), F.col(c).cast("double").alias("v")) for i, c in enumerate(features)])))
    found = ranking.percentiles(values, ["f"], "v", [i / max_bins for i in range(1, max_bins)])
    by_feature = {r.f: r.cuts for r in found.groupBy("f").agg(F.sort_array(F.collect_set("percentile")).alias("cuts")).collect()}
    return [by_feature.get(i, []) for i in range(len(features))]


def _binned(train: DataFrame, features: Sequence[str], cuts: list[list[float]]) -> DataFrame:
    """label and the number of cuts at or below each feature's value."""
    names = [f"_b{i}" for i in range(len(features))]
    edges = [[-math.inf, *(c or [0.0]), math.inf] for c in cuts]
    cutter = Bucketizer(splitsArray=edges, inputCols=list(features), outputCols=names)
    rows = cutter.transform(train.select("label", *[F.col(c).cast("double").alias(c) for c in features]))
    return rows.select(F.monotonically_increasing_id().alias("row"), F.col("label").cast("double").alias("label"), F.array(*[F.col(n).cast("short") for n in names]).alias("bins"))


def _placed(tree: dict[int, Node], leaf: Callable[[int], str], k: int = 1) -> str:
    """What ``leaf`` gives for the node a row falls into, as SQL."""
    node = tree.get(k)
    if node is None or node.feature is None:
        return leaf(k)
    return f"IF(get(bins, {node.feature}) < {node.cut}, {_placed(tree, leaf, 2 * k)}, {_placed(tree, leaf, 2 * k + 1)})"


def _best(sums: np.ndarray, cuts: list[list[float]], min_split: int, min_leaf: int) -> tuple[int, int, float] | None:
    """Feature, cut and gain of the best split; sums[feature, bin] are residuals, curvatures and rows."""
    total, rows = sums[0].sum(axis=0), sums[0, :, 2].sum()
    best = None
    if rows < min_split:
        return None
    for f, own in enumerate(sums):
        left = np.cumsum(own, axis=0)[: len(cuts[f])]
        n, other = left[:, 2], rows - left[:, 2]
        fair = (n >= min_leaf) & (other >= min_leaf)
        with np.errstate(divide="ignore", invalid="ignore"):
            gains = n * other / rows * (left[:, 0] / n - (total[0] - left[:, 0]) / other) ** 2
        gains = np.where(fair, np.round(np.nan_to_num(gains), GAIN_DIGITS), 0.0)
        if len(gains) and gains.max() > (best[2] if best else 0.0):
            best = f, int(gains.argmax()) + 1, float(gains.max())
    return best


def _grown(rows: DataFrame, cuts: list[list[float]], bits: int, max_depth: int, min_split: int, min_leaf: int) -> dict[int, Node]:
    """One tree; rows hold bins, r and h."""
    tree: dict[int, Node] = {}
    open_, bins = {1}, max(len(c) for c in cuts) + 1

    def leaf(sums: np.ndarray) -> Node:
        return Node(int(sums[2]), float(sums[0] / sums[1]) if abs(sums[1]) > 1e-150 else 0.0)

    for level in range(max_depth):
        node = _placed(tree, lambda k: str(k if k in open_ else 0))  # noqa: B023
        own = rows.select(F.expr(node).alias("node"), "r", "h", F.posexplode("bins").alias("f", "bin")).where("node > 0")
        found = own.groupBy("node", "f", "bin").agg(F.sum("r").alias("r"), F.sum("h").alias("h"), F.count(F.lit(1)).alias("n")).collect()
        sums = {k: np.zeros((len(cuts), bins, 3)) for k in open_}
        for x in found:
            sums[x.node][x.f, x.bin] = (math.ldexp(x.r, -bits), math.ldexp(x.h, -bits), x.n)
        open_ = set()
        for k, own_sums in sums.items():
            split = _best(own_sums, cuts, min_split, min_leaf)
            total = own_sums[0].sum(axis=0)
            if split is None:
                tree[k] = leaf(total)
                continue
            f, cut, gain = split
            tree[k] = Node(int(total[2]), 0.0, f, cut, cuts[f][cut - 1], gain)
            if level + 1 < max_depth:
                open_ |= {2 * k, 2 * k + 1}
            else:
                left = own_sums[f, :cut].sum(axis=0)
                tree[2 * k], tree[2 * k + 1] = leaf(left), leaf(total - left)
        if not open_:
            break
    return dict(sorted(tree.items()))


def fit(
    train: DataFrame, features: Sequence[str], max_iter: int, step_size: float, max_depth: int, min_split: int, min_leaf: int,
    subsample: float = 1.0, seed: int = 42, max_bins: int = MAX_BINS,
) -> Ensemble:
    """Trees for ``label`` (0 or 1) on filled features.

    Each tree sees a share of the rows, chosen by a hash of the row's number, the tree and the seed.
    """
    cuts = quantile_cuts(train, features, max_bins)
    table = lineage.settled(_binned(train, features, cuts).withColumn("margin", F.lit(0.0)), "boosting")
    n, ones = table.agg(F.count(F.lit(1)), F.sum("label")).first()
    if not n or not 0 < ones < n:
        raise ValueError("boosting needs rows of both classes")
    start = math.log(ones / (n - ones))
    bits = min(40, 62 - n.bit_length())
    trees: list[dict[int, Node]] = []
    pending = [f"{start!r}D"]
    for t in range(max_iter):
        if len(pending) > SETTLE:
            former, table = table, lineage.settled(table.withColumn("margin", F.expr(" + ".join(pending))), "boosting")
            lineage.discard(former)
            pending = ["margin"]
        rows = table
        if subsample < 1.0:
            rows = rows.where(F.pmod(F.xxhash64("row", F.lit(seed), F.lit(t)), F.lit(1 << 20)) < int(subsample * (1 << 20)))
        rows = rows.select("bins", "label", F.expr(f"1 / (1 + exp(-({' + '.join(pending)})))").alias("p"))
        whole = lambda x: f"cast(round(({x}) * {1 << bits}D) as bigint)"
        rows = rows.selectExpr("bins", f"{whole('label - p')} AS r", f"{whole('p * (1 - p)')} AS h")
        tree = _grown(rows, cuts, bits, max_depth, min_split, min_leaf)
        trees.append(tree)
        pending.append(f"{step_size!r}D * {_placed(tree, lambda k, tree=tree: f'{tree[k].value!r}D')}")
    lineage.discard(table)
    return Ensemble(tuple(features), start, step_size, trees)
