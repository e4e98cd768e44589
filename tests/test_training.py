import numpy as np
import pytest
from pyspark.sql import functions as F

from tenorlake.plans import scoring, training

WINDOWS = [
    {"split": "train", "start_date": "2023-01-01", "end_date": "2023-06-01"},
    {"split": "validation", "start_date": "2023-07-01", "end_date": "2023-08-01"},
    {"split": "test", "start_date": "2023-09-01", "end_date": "2023-09-01"},
    {"split": "oot", "start_date": "2023-10-01", "end_date": "2023-12-01"},
    {"split": "oot2", "start_date": "2030-10-01", "end_date": "2030-12-01"},
]


@pytest.fixture(scope="module")
def data(spark):
    """A separable problem with gaps, a constant, a text and an empty feature."""
    rng = np.random.default_rng(11)
    n = 1500
    x, y = rng.normal(size=n), rng.normal(size=n)
    label = (rng.random(n) < 1 / (1 + np.exp(-(1.5 * x - y - 1)))).astype(int)
    rows = [
        (f"L{i}", f"C{i % 50}", f"2023-{i % 12 + 1:02d}-01", float(x[i]) if i % 9 else None, float(y[i]), 3.0, "text", None, int(label[i]))
        for i in range(n)
    ]
    df = spark.createDataFrame(
        rows, "loan_id string, Customer_ID string, d string, x double, y double, k double, words string, nothing double, label int"
    ).withColumn("snapshot_date", F.col("d").cast("date"))
    features = df.drop("label", "d").withColumn("mob", F.lit(0))
    labels = df.select("loan_id", "Customer_ID", "label", F.lit("30dpd_6mob").alias("label_def"))
    return features, labels, rows


@pytest.fixture(scope="module")
def logistic(data):
    features, labels, _ = data
    return training.train(features, labels, WINDOWS, "model_1", "2023-12-31", rows_per_cell=50)


def train_matrix(rows):
    mine = [r for r in rows if r[2] <= "2023-06-01"]
    values = np.array([[np.nan if r[3] is None else r[3], r[4], r[5]] for r in mine])
    median = np.nanmedian(values, axis=0)
    filled = np.where(np.isnan(values), median, values)
    spread = filled.std(axis=0)
    return median, filled, (filled - filled.mean(axis=0)) / np.where(spread == 0, 1, spread), np.array([r[8] for r in mine])


def test_preprocessing_matches_numpy(logistic, data):
    median, filled, _, _ = train_matrix(data[2])
    prep = logistic.preprocessing
    assert prep.features == ("x", "y", "k")
    assert prep.median == pytest.approx(median)
    assert prep.centre == pytest.approx(filled.mean(axis=0))
    assert prep.scale == pytest.approx([*filled.std(axis=0)[:2], 1.0])


def test_coefficients_match_a_newton_solve(logistic, data):
    """Balanced classes, penalty one half of the squared weights, no penalty on the intercept."""
    _, _, z, y = train_matrix(data[2])
    a = np.c_[z[:, :2], np.ones(len(z))]
    weight = len(y) / (2 * np.where(y == 1, y.sum(), (1 - y).sum()))
    w, penalty = np.zeros(3), np.diag([1.0, 1.0, 0.0])
    for _ in range(30):
        p = 1 / (1 + np.exp(-a @ w))
        gradient = a.T @ (weight * (p - y)) + penalty @ w
        w -= np.linalg.solve(a.T @ (a * (weight * p * (1 - p))[:, None]) + penalty, gradient)
    model = logistic.model.stages[-1]
    assert list(model.coefficients.toArray()[:2]) == pytest.approx(w[:2], abs=1e-4)
    assert model.intercept == pytest.approx(w[2], abs=1e-4)


def test_evaluation(logistic):
    rows = {r.split: r for r in logistic.evaluation.collect()}
    assert rows["train"].n == 750 and rows["oot2"].n == 0 and rows["oot2"].roc_auc is None
    assert rows["validation"].roc_auc > 0.8 and rows["oot"].roc_auc > 0.8
    record = logistic.record.first()
    assert record.val_roc_auc == rows["validation"].roc_auc and record.feature_count == 3
    weights = {r.feature: r.weight for r in logistic.weights.collect()}
    assert set(weights) == {"x", "y", "k"} and weights["x"] > 0 > weights["y"]


def test_empty_validation_is_an_error(data):
    features, labels, _ = data
    windows = [WINDOWS[0], {"split": "validation", "start_date": "2040-01-01", "end_date": "2040-02-01"}]
    with pytest.raises(ValueError, match="validation"):
        training.train(features, labels, windows, "model_1", "2023-12-31")


def test_boosting_learns_and_repeats(data):
    features, labels, _ = data
    fits = [training.train(features, labels, WINDOWS, "model_2", "2023-12-31", max_iter=8) for _ in range(2)]
    rows = [{r.split: r.roc_auc for r in f.evaluation.collect()} for f in fits]
    assert rows[0]["validation"] > 0.75
    assert rows[0] == rows[1]


def test_saved_model_scores_the_same(spark, logistic, data, tmp_path):
    features = data[0].drop("k")
    training.save(logistic, str(tmp_path))
    loaded = training.load(spark, str(tmp_path), "model_1")
    assert loaded.features == logistic.preprocessing.features
    one, two = (scoring.score(m, features, loaded.features, "model_1") for m in (logistic.model, loaded.model))
    columns = ["loan_id", "prediction_proba", "prediction_label"]
    assert sorted(map(tuple, one.select(columns).collect())) == sorted(map(tuple, two.select(columns).collect()))
    assert one.select("model_type").distinct().first()[0] == "logistic_regression"
    weights = spark.read.option("header", True).csv(f"{tmp_path}/model_1/feature_weights")
    assert weights.count() == 3 and spark.read.parquet(f"{tmp_path}/model_1/record").count() == 1


def test_backfill_fills_gaps_once(spark, logistic, data, tmp_path):
    features, _, _ = data
    names = list(logistic.preprocessing.features)
    models = {"model_1": (logistic.model, names)}
    root = f"{tmp_path}/scores"
    first = scoring.score(logistic.model, features.where("snapshot_date = date'2023-11-01'"), names, "model_1")
    scoring.write_predictions(first, root)

    def existing():
        done = spark.read.parquet(root).select("model_id", F.col("inference_date").alias("month")).distinct()
        return spark.createDataFrame(done.collect(), "model_id string, month date")

    day = F.lit("2023-12-15").cast("date")
    scoring.write_predictions(scoring.backfill(models, features, existing(), day, 3), root)
    counts = {str(r.inference_date): r["count"] for r in spark.read.parquet(root).groupBy("inference_date").count().collect()}
    assert counts == {"2023-10-01": 125, "2023-11-01": 125, "2023-12-01": 125}
    assert scoring.backfill(models, features, existing(), day, 3).count() == 0
