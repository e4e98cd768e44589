"""Training: time-ordered splits, preprocessing, two classifiers, evaluation."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenorlake.operators import joins, metrics, ranking, schema, tables
from tenorlake.plans import boosting
from tenorlake.sources import lineage

# Columns that are never features.
BOOKKEEPING = ("loan_id", "Customer_ID", "label", "label_def", "snapshot_date", "feature_snapshot_date", "mob")

# Model ids and the training parameters that go with them.
MODEL_TYPES = {"model_1": "logistic_regression", "model_2": "gradient_boosting"}
LOGISTIC_PARAMS = {"max_iter": 1000, "C": 1.0, "seed": 42}
BOOSTING_PARAMS = {"max_iter": 100, "step_size": 0.05, "max_depth": 3, "min_split": 50, "min_leaf": 20, "subsample": 0.8, "seed": 42}

SELECTION_MIN_SAMPLES = 100


def feature_names(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in BOOKKEEPING and c != "split"]


def training_rows(
    features: DataFrame, labels: DataFrame, windows: Sequence[Mapping[str, str]], up_to: str | None = None,
    date_column: str = "snapshot_date",
) -> DataFrame:
    """Labelled feature rows with their split, every feature a double.

    ``up_to`` cuts both tables at a snapshot before they are joined.
    """
    if up_to:
        cutoff = F.lit(up_to).cast("date")
        features = features.where(F.col(date_column) <= cutoff)
        if date_column in labels.columns:
            labels = labels.where(F.col(date_column) <= cutoff)
    rows = joins.labelled(features, labels)
    rows = schema.numeric_features(rows, feature_names(rows))
    return joins.assign_splits(rows, date_column, windows)


def require_samples(rows: DataFrame, windows: Sequence[Mapping[str, str]]) -> dict[str, int]:
    """Rows per split; an empty train or validation split is an error."""
    sizes = {r.split: r.n for r in tables.split_sizes(rows, windows).collect()}
    for split in ("train", "validation"):
        if not sizes.get(split):
            raise ValueError(f"the {split} split has no labelled rows")
    return sizes


@dataclass(frozen=True)
class Preprocessing:
    """Per feature: the median to fill in, and centre and scale after filling."""

    features: tuple[str, ...]
    median: tuple[float, ...]
    centre: tuple[float, ...]
    scale: tuple[float, ...]

    def stages(self, standardise: bool) -> list:
        """Spark ML stages that turn raw features into one vector."""
        made = []
        for name, median, centre, scale in zip(self.features, self.median, self.centre, self.scale):
            filled = f"coalesce(`{name}`, {median!r}D)"
            made.append(f"({filled} - {centre!r}D) / {scale!r}D" if standardise else filled)
        columns = [f"{e} AS `_z{i}`" for i, e in enumerate(made)]
        names = [f"_z{i}" for i in range(len(made))]
        statement = f"SELECT *, {', '.join(columns)} FROM __THIS__"
        return [
            SQLTransformer(statement=statement),
            VectorAssembler(inputCols=names, outputCol="features"),
            SQLTransformer(statement=f"SELECT * EXCEPT ({', '.join(names)}) FROM __THIS__"),
        ]


def fit_preprocessing(train: DataFrame, features: Sequence[str], stored: bool = False) -> Preprocessing:
    """Medians of the train split, and mean and population std of the filled columns.

    The moments after filling follow from those before it. Features without any value are left out,
    names stay aligned. One row per feature reaches the driver. ``stored`` says that ``train`` is read from a table.
    """
    n_rows, found = tables.feature_stats(train, features, stored)
    names = [f for f in features if f in found]
    median, centre, scale = [], [], []
    for name in names:
        n, own_mean, std, middle = found[name]
        gaps = n_rows - n
        mean = (n * own_mean + gaps * middle) / n_rows
        spread = (n * (std**2 + (own_mean - mean) ** 2) + gaps * (middle - mean) ** 2) / n_rows
        median.append(float(middle))
        centre.append(float(mean))
        scale.append(float(spread**0.5) or 1.0)
    return Preprocessing(tuple(names), tuple(median), tuple(centre), tuple(scale))


def preprocessed(df: DataFrame, prep: Preprocessing, standardise: bool = True) -> DataFrame:
    """Features filled and, if asked, scaled, as plain columns."""
    out = {}
    for name, median, centre, scale in zip(prep.features, prep.median, prep.centre, prep.scale):
        filled = F.coalesce(F.col(name), F.lit(median))
        out[name] = (filled - F.lit(centre)) / F.lit(scale) if standardise else filled
    return df.withColumns(out)


def fit_logistic(train: DataFrame, prep: Preprocessing, **params) -> tuple[PipelineModel, list[float]]:
    """L2 logistic regression on scaled features with balanced class weights; the model and its coefficients."""
    p = LOGISTIC_PARAMS | params
    stages = prep.stages(True)
    ready = PipelineModel(stages).transform(train).select("features", F.col("label").cast("double").alias("label"))
    sizes = {r.label: r.n for r in ready.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(sizes.values())
    weight = F.lit(0.0)
    for label, n in sizes.items():
        weight = F.when(F.col("label") == label, total / (len(sizes) * n)).otherwise(weight)
    learner = LogisticRegression(
        maxIter=p["max_iter"], regParam=1.0 / (p["C"] * total), elasticNetParam=0.0, standardization=False,
        weightCol="weight", tol=1e-8,
    )
    fitted = learner.fit(ready.withColumn("weight", weight))
    return PipelineModel([*stages, fitted]), [float(w) for w in fitted.coefficients.toArray()]


def fit_boosting(train: DataFrame, prep: Preprocessing, **params) -> tuple[PipelineModel, list[float]]:
    """Gradient-boosted trees on filled features; the model and the importance of each feature."""
    fitted = boosting.fit(preprocessed(train, prep, standardise=False), prep.features, **(BOOSTING_PARAMS | params))
    return PipelineModel(fitted.stages(prep.median)), fitted.importances()


FITTERS = {"model_1": fit_logistic, "model_2": fit_boosting}


def scored(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Rows with the probability of class 1 and the predicted class."""
    out = model.transform(df)
    return out.withColumns(
        {
            "prediction_proba": vector_to_array("probability")[1],
            "prediction_label": F.col("prediction").cast("bigint"),
        }
    ).drop("features", "rawPrediction", "probability", "prediction")


def evaluate(
    model: PipelineModel, rows: DataFrame, windows: Sequence[Mapping[str, str]], model_id: str,
    rows_per_cell: int = ranking.ROWS_PER_CELL,
) -> DataFrame:
    """Accuracy, AUC and size of every split, scored once; empty splits have nulls."""
    kept = scored(model, rows).select("split", "label", "prediction_proba", "prediction_label")
    kept = lineage.settled(kept, "evaluation")
    accuracy = metrics.rates(metrics.confusion_matrix(kept, ["split"]))
    auc = ranking.roc_auc(kept, ["split"], rows_per_cell=rows_per_cell)
    sizes = tables.split_sizes(rows, windows)
    joined = sizes.join(accuracy.select("split", "accuracy"), "split", "left").join(auc, "split", "left")
    return joined.select(F.lit(model_id).alias("model_id"), "split", "accuracy", "roc_auc", "n")


def feature_weights(spark: SparkSession, prep: Preprocessing, weights: Sequence[float]) -> DataFrame:
    """Coefficients or importances by feature name."""
    return spark.createDataFrame(list(zip(prep.features, weights, strict=True)), "feature string, weight double")


def training_record(
    evaluation: DataFrame, model_id: str, label_def: str, snapshot: str, features: Sequence[str],
    params: Mapping[str, object], windows: Sequence[Mapping[str, str]],
) -> DataFrame:
    """One registry row per model: split metrics, windows, label definition, parameters."""
    found = []
    for split in [w["split"] for w in windows]:
        prefix = "val" if split == "validation" else split
        here = F.col("split") == split
        found += [F.max(F.when(here, F.col(m))).alias(f"{prefix}_{m}") for m in ("accuracy", "roc_auc")]
        found.append(F.max(F.when(here, F.col("n"))).alias(f"{prefix}_samples"))
    filling = F.lit("StandardScaler") if model_id == "model_1" else F.lit(None).cast("string")
    return evaluation.groupBy("model_id").agg(*found).withColumns(
        {
            "model_type": F.lit(MODEL_TYPES.get(model_id, "unknown")),
            "label_definition": F.lit(label_def),
            "snapshot_date": F.lit(snapshot),
            "feature_count": F.lit(len(features)),
            "features": F.array(*map(F.lit, features)),
            "imputation": F.lit("median"),
            "scaling": filling,
            "hyperparameters": F.lit(json.dumps(dict(params))),
            "temporal_splits": F.lit(json.dumps(list(windows))),
            "training_date": F.current_timestamp(),
        }
    )


@dataclass(frozen=True)
class Trained:
    """A fitted model; ``evaluation`` and ``record`` are None if it was not evaluated, ``rows`` are the labelled rows as stored."""

    model_id: str
    model: PipelineModel
    preprocessing: Preprocessing
    evaluation: DataFrame | None
    weights: DataFrame
    record: DataFrame | None
    rows: DataFrame | None = None


def train(
    features: DataFrame, labels: DataFrame, windows: Sequence[Mapping[str, str]], model_id: str, snapshot: str,
    label_def: str | None = None, rows_per_cell: int = ranking.ROWS_PER_CELL, **params,
) -> Trained:
    """The whole training job for one model."""
    return train_all(features, labels, windows, {model_id: params}, snapshot, label_def, rows_per_cell)[model_id]


def train_all(
    features: DataFrame, labels: DataFrame, windows: Sequence[Mapping[str, str]], models: Mapping[str, Mapping[str, object]], snapshot: str,
    label_def: str | None = None, rows_per_cell: int = ranking.ROWS_PER_CELL, evaluated: bool = True,
) -> dict[str, Trained]:
    """The training job for several models, given with their parameters, on the same rows and preprocessing.

    The labelled rows are joined and written once, without their ids, since fitting reads them many times. The
    label definition is taken from the labels unless it is given. ``evaluated`` False is for callers that need the models alone.
    """
    rows = training_rows(features, labels, windows, snapshot)
    names = feature_names(rows)
    used = {m: (LOGISTIC_PARAMS if m == "model_1" else BOOSTING_PARAMS) | params for m, params in models.items()}
    if any(p.get("subsample", 1.0) < 1.0 for p in used.values()):
        # a stable row order makes sampling by seed repeatable
        rows = rows.sortWithinPartitions(*rows.columns)
    rows = lineage.settled(rows.select(*names, *[c for c in ("label", "label_def", "split") if c in rows.columns]), "training")
    require_samples(rows, windows)
    label_def = label_def or rows.select("label_def").first().label_def
    train_split = rows.where(F.col("split") == "train")
    prep = fit_preprocessing(train_split, names, stored=True)
    fits = {}
    for model_id, params in models.items():
        model, weights = FITTERS[model_id](train_split, prep, **params)
        evaluation = evaluate(model, rows, windows, model_id, rows_per_cell) if evaluated else None
        record = training_record(evaluation, model_id, label_def, snapshot, prep.features, used[model_id], windows) if evaluated else None
        fits[model_id] = Trained(model_id, model, prep, evaluation, feature_weights(rows.sparkSession, prep, weights), record, rows)
    return fits


def save(trained: Trained, root: str) -> None:
    """Model, feature weights and registry row below ``root``/model id."""
    save_at(trained, f"{root.rstrip('/')}/{trained.model_id}")


def save_at(trained: Trained, base: str) -> None:
    trained.model.write().overwrite().save(f"{base}/model")
    trained.record.write.mode("overwrite").parquet(f"{base}/record")
    ordered = trained.weights.orderBy(F.abs("weight").desc(), "feature").coalesce(1)
    ordered.write.mode("overwrite").option("header", True).csv(f"{base}/feature_weights")


@dataclass(frozen=True)
class Saved:
    model: PipelineModel
    features: tuple[str, ...]
    record: DataFrame


def load(spark: SparkSession, root: str, model_id: str) -> Saved:
    """A saved model with its feature names in trained order and its registry row."""
    return load_at(spark, f"{root.rstrip('/')}/{model_id}")


def load_at(spark: SparkSession, base: str) -> Saved:
    record = spark.read.parquet(f"{base}/record")
    return Saved(PipelineModel.load(f"{base}/model"), tuple(record.first().features), record)


def promotion_check(record: DataFrame, incumbent: DataFrame | None = None) -> DataFrame:
    """Whether a trained model may replace the current one, condition by condition."""
    # The limits of the governance rules.
    checks = {
        "oot_high_enough": F.col("oot_roc_auc") >= 0.80,
        "oot_near_test": F.abs(F.col("oot_roc_auc") - F.col("test_roc_auc")) / F.col("test_roc_auc") <= 0.03,
        "no_overfit": F.col("train_roc_auc") - F.col("val_roc_auc") < 0.05,
    }
    out = record.select("model_id", "train_roc_auc", "val_roc_auc", "test_roc_auc", "oot_roc_auc")
    if incumbent is not None:
        current = incumbent.select("model_id", F.col("oot_roc_auc").alias("current_oot_roc_auc"))
        out = out.join(current, "model_id", "left")
        gain = (F.col("oot_roc_auc") - F.col("current_oot_roc_auc")) / F.col("current_oot_roc_auc")
        checks["better_than_current"] = F.col("current_oot_roc_auc").isNull() | (gain >= 0.02)
    promoted = F.lit(True)
    for check in checks.values():
        promoted = promoted & F.coalesce(check, F.lit(False))
    return out.withColumns({n: F.coalesce(c, F.lit(False)) for n, c in checks.items()} | {"promote": promoted})


def select_model(
    candidates: DataFrame, primary: str = "val_roc_auc", secondary: str = "val_accuracy", samples: str = "val_samples",
    minimum: int = SELECTION_MIN_SAMPLES,
) -> DataFrame:
    """The best candidate by primary, then secondary metric, then name, among those with enough rows."""
    enough = candidates.where((F.col(samples) >= minimum) & F.col(primary).isNotNull())
    return enough.orderBy(F.col(primary).desc(), F.col(secondary).desc_nulls_last(), "model_id").limit(1)
