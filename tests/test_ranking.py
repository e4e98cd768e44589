import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tenorlake.operators import metrics, ranking, tables
from tenorlake.plans import monitoring


def brute_auc(rows):
    pos = [s for s, y in rows if y == 1]
    neg = [s for s, y in rows if y == 0]
    if not pos or not neg:
        return None
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


@pytest.fixture(scope="module")
def scored(spark):
    """One group holds most rows; ties, a one-class group and a null group."""
    rng = random.Random(3)
    data = []
    for _ in range(600):
        g = rng.choice(["hot", "hot", "hot", "b", None])
        s = round(rng.random(), rng.choice([1, 6]))
        data.append((g, s, int(rng.random() < s), int(s >= 0.5)))
    data += [("one", rng.random(), 1, 1) for _ in range(5)]
    df = spark.createDataFrame(data, "g string, prediction_proba double, label int, prediction_label int")
    return df.repartition(5).cache(), data


@pytest.mark.parametrize("rows_per_cell", [5, 1_000_000])
def test_auc_matches_pairs(scored, rows_per_cell):
    df, data = scored
    got = {r.g: r.roc_auc for r in ranking.roc_auc(df, ["g"], rows_per_cell=rows_per_cell).collect()}
    for g in ("hot", "b", None, "one"):
        want = brute_auc([(s, y) for k, s, y, _ in data if k == g])
        assert got[g] == (pytest.approx(want) if want is not None else None)


def test_auc_and_median_in_one_plan(scored):
    df, data = scored
    rows = ranking.auc_and_median(df, ["g"], rows_per_cell=7).collect()
    assert len(rows) == 4
    for r in rows:
        mine = [(s, y) for k, s, y, _ in data if k == r.g]
        assert r.median == pytest.approx(float(np.median([s for s, _ in mine])))
        want = brute_auc(mine)
        assert r.roc_auc == (pytest.approx(want) if want is not None else None)


def test_inverted_scores_mirror_the_auc(scored):
    df, _ = scored
    turned = df.withColumn("prediction_proba", -F.col("prediction_proba"))
    a = ranking.roc_auc(df, []).first().roc_auc
    b = ranking.roc_auc(turned, [], rows_per_cell=9).first().roc_auc
    assert a + b == pytest.approx(1.0)


def test_known_auc(spark):
    data = [(0.1, 0), (0.4, 0), (0.35, 1), (0.8, 1), (0.35, 0)]
    df = spark.createDataFrame(data, "prediction_proba double, label int")
    assert ranking.roc_auc(df, []).first().roc_auc == pytest.approx(0.75)


@pytest.mark.parametrize("rows_per_cell", [4, 1_000_000])
def test_percentiles_match_numpy(scored, rows_per_cell):
    df, data = scored
    probabilities = [0.0, 0.1, 0.5, 0.77, 1.0]
    rows = ranking.percentiles(df, ["g"], "prediction_proba", probabilities, rows_per_cell).collect()
    assert len(rows) == 4 * len(probabilities)
    for r in rows:
        values = [s for k, s, _, _ in data if k == r.g]
        assert r.percentile == pytest.approx(float(np.quantile(values, r.p)))


def test_buckets_bound_the_cells(spark):
    df = spark.range(20_000).select((F.rand(1) * F.rand(2)).alias("x"))
    cells = ranking.with_bucket(df, "x", ranking.splitters(df, "x", 100)).groupBy("_bucket").count()
    sizes = [r["count"] for r in cells.collect()]
    assert sum(sizes) == 20_000 and len(sizes) > 100 and max(sizes) < 1_500


def test_distribution(spark):
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 4, 9)], "prediction_proba double")
    row = metrics.score_distribution(df).first()
    assert row.median_prediction_proba == 3.0
    assert row.std_prediction_proba == pytest.approx(3.082207, abs=1e-6)


def test_rates_without_predictions(spark):
    df = spark.createDataFrame([(1, 0), (0, 0)], "label int, prediction_label int")
    row = metrics.rates(metrics.confusion_matrix(df)).first()
    assert (row.accuracy, row.precision, row.recall, row.f1_score) == (0.5, 0.0, 0.0, 0.0)
    single = spark.createDataFrame([(1, 1), (1, 1)], "label int, prediction_label int")
    assert metrics.confusion_matrix(single).first().true_positives == 2
    assert metrics.confusion_matrix(single, zero_single_class=True).first().true_positives == 0


def test_model_metrics_without_groups(scored):
    df, data = scored
    row = metrics.model_metrics(df, [], rows_per_cell=11).first()
    assert row.total_samples == len(data)
    assert row.roc_auc == pytest.approx(brute_auc([(s, y) for _, s, y, _ in data]))
    assert row.median_prediction_proba == pytest.approx(float(np.median([s for _, s, _, _ in data])))


def test_population_stability(scored):
    df, data = scored
    base = [s for k, s, _, _ in data if k == "b"]
    edges = np.quantile(base, [i / 10 for i in range(1, 10)])
    def shares(values):
        bins = np.array([sum(v > e for e in edges) for v in values])
        return [max((bins == i).mean(), 1e-4) for i in range(10)]
    e = shares(base)
    got = {r.g: r.psi for r in monitoring.population_stability(df.where("g = 'b'"), df, ["g"], rows_per_cell=6).collect()}
    for g in ("hot", None, "b"):
        a = shares([s for k, s, _, _ in data if k == g])
        assert got[g] == pytest.approx(sum((x - y) * np.log(x / y) for x, y in zip(a, e)), abs=1e-9)


def test_column_medians_with_a_coarse_sketch(spark):
    """The bracket is wide here, and the values far more than the sketch keeps."""
    rng = np.random.default_rng(2)
    values = np.c_[rng.normal(size=40_001), rng.integers(0, 5, size=40_001), np.r_[np.full(20_001, 7.0), rng.random(20_000)]]
    df = spark.createDataFrame(values.tolist(), "a double, b double, c double").repartition(6)
    got = {r.feature: r["median"] for r in ranking.column_medians(df, ["a", "b", "c"], accuracy=100).collect()}
    assert got == {n: pytest.approx(float(np.median(values[:, i]))) for i, n in enumerate("abc")}


def test_column_stats(spark):
    rng = random.Random(5)
    data = [(rng.random(), rng.choice([None, 1.0, 7.0])) for _ in range(200)]
    df = spark.createDataFrame(data, "a double, b double")
    rows = {r.feature: r for r in tables.column_stats(df, ["a", "b"]).collect()}
    for i, name in enumerate("ab"):
        values = [d[i] for d in data if d[i] is not None]
        assert rows[name].n == len(values)
        assert rows[name].median == pytest.approx(float(np.median(values)))
        assert rows[name]["std"] == pytest.approx(float(np.std(values)))
