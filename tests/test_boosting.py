"""Boosted trees against a plain fit in numpy."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tenorlake.plans import boosting

OPTIONS = {"max_iter": 12, "step_size": 0.3, "max_depth": 3, "min_split": 50, "min_leaf": 20, "max_bins": 16}


def brute(x, y, max_iter, step_size, max_depth, min_split, min_leaf, max_bins):
    """Every cut of every node tried on the rows themselves."""
    cuts = [sorted(set(np.quantile(x[:, f], [i / max_bins for i in range(1, max_bins)]))) for f in range(x.shape[1])]
    margin, trees = np.full(len(y), math.log(y.sum() / (len(y) - y.sum()))), []
    for _ in range(max_iter):
        p = 1 / (1 + np.exp(-margin))
        r, tree, value = y - p, {}, np.zeros(len(y))

        def grow(k, rows, depth):
            best = (0.0, None, None)
            if depth < max_depth and len(rows) >= min_split:
                for f, own in enumerate(cuts):
                    for c in own:
                        left = x[rows, f] < c
                        n, m = left.sum(), (~left).sum()
                        if min(n, m) >= min_leaf:
                            gain = round(n * m / len(rows) * (r[rows][left].mean() - r[rows][~left].mean()) ** 2, 6)  # noqa: B023
                            best = max(best, (gain, f, c), key=lambda b: b[0])
            if best[1] is None:
                value[rows] = r[rows].sum() / (p[rows] * (1 - p[rows])).sum()  # noqa: B023
                tree[k] = (None, None, len(rows), value[rows[0]])  # noqa: B023
                return
            left = x[rows, best[1]] < best[2]
            tree[k] = (best[1], best[2], len(rows), best[0])  # noqa: B023
            grow(2 * k, rows[left], depth + 1)
            grow(2 * k + 1, rows[~left], depth + 1)

        grow(1, np.arange(len(y)), 0)
        trees.append(tree)
        margin = margin + step_size * value
    return trees, 1 / (1 + np.exp(-margin))


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(4)
    x = np.c_[rng.normal(size=900), rng.integers(0, 5, 900), np.round(rng.exponential(size=900), 2), np.full(900, 7.0)]
    y = (rng.random(900) < 1 / (1 + np.exp(-(x[:, 0] * (x[:, 1] > 2) - x[:, 2] + 0.5)))).astype(int)
    rows = [(*map(float, a), int(b)) for a, b in zip(x, y, strict=True)]
    return spark.createDataFrame(rows, "a double, b double, c double, d double, label int").repartition(5), x, y


def test_trees_match_brute_force(spark, data, monkeypatch):
    monkeypatch.setattr(boosting, "SETTLE", 5)
    df, x, y = data
    fitted = boosting.fit(df, ["a", "b", "c", "d"], **OPTIONS)
    trees, proba = brute(x, y, **OPTIONS)
    for tree, want in zip(fitted.trees, trees, strict=True):
        assert {k: (n.feature, n.n) for k, n in tree.items()} == {k: (f, n) for k, (f, _, n, _) in want.items()}
        for k, n in tree.items():
            assert (n.threshold, n.gain) == pytest.approx((want[k][1], want[k][3])) if n.feature is not None else n.value == pytest.approx(want[k][3], rel=1e-6)
    sizes = [n.n for tree in fitted.trees for n in tree.values()]
    assert min(sizes) >= 20 and all(n.n >= 50 for tree in fitted.trees for n in tree.values() if n.feature is not None)
    assert fitted.importances()[3] == 0 and sum(fitted.importances()) == pytest.approx(1)
    scored = df
    for stage in fitted.stages([0.0] * 4):
        scored = stage.transform(scored)
    got = sorted((r.a, r.probability[1], r.prediction) for r in scored.collect())
    assert got == [(pytest.approx(a), pytest.approx(p, rel=1e-6), float(p > 0.5)) for a, p in sorted(zip(x[:, 0], proba, strict=True))]
    assert fitted.nodes(spark).where("feature is null").count() == sum(n.feature is None for t in fitted.trees for n in t.values())


def test_fits_repeat_whatever_the_order_of_rows(data):
    df = data[0]
    fits = [boosting.fit(d, ["a", "b", "c"], **OPTIONS).trees for d in (df, df.repartition(3, "a"))]
    assert fits[0] == fits[1]
    sampled = [boosting.fit(df.coalesce(1).sortWithinPartitions("a", "c"), ["a", "b"], **OPTIONS | {"max_iter": 2}, subsample=0.8).trees for _ in range(2)]
    assert sampled[0] == sampled[1] and 600 < sampled[0][0][1].n < 800 and sampled[0][0][1].n != sampled[0][1][1].n


def test_one_class_is_an_error_and_few_rows_make_a_leaf(data):
    df = data[0]
    with pytest.raises(ValueError, match="both classes"):
        boosting.fit(df.withColumn("label", F.lit(1)), ["a"], **OPTIONS)
    (tree,) = boosting.fit(df.limit(30), ["a"], **OPTIONS | {"max_iter": 1}).trees
    assert list(tree) == [1] and tree[1].n == 30
