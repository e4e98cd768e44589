"""Classification metrics as aggregates over scored rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenorlake.operators import ranking
from tenorlake.sources import lineage

CONFUSION = ("true_negatives", "false_positives", "false_negatives", "true_positives")


def _share(numerator: Column, denominator: Column) -> Column:
    return F.when(denominator > 0, numerator / denominator).otherwise(F.lit(0.0))


def confusion_columns(label: str = "label", predicted: str = "prediction_label") -> list[Column]:
    cases = zip(CONFUSION, (("!=", "!="), ("!=", "="), ("=", "!="), ("=", "=")))
    return [F.expr(f"count_if(`{label}` {truth} 1 and `{predicted}` {guess} 1) as {c}") for c, (truth, guess) in cases]


def confusion_matrix(
    df: DataFrame, by: Sequence[str] = (), label: str = "label", predicted: str = "prediction_label",
    zero_single_class: bool = False,
) -> DataFrame:
    """Confusion counts per group.

    ``zero_single_class`` returns zeros for groups where truth and prediction
    only ever take one and the same class.
    """
    counts = df.groupBy(*by).agg(*confusion_columns(label, predicted))
    if not zero_single_class:
        return counts
    tn, fp, fn, tp = map(F.col, CONFUSION)
    single = (fp + fn == 0) & ((tn == 0) | (tp == 0))
    return counts.withColumns({c: F.when(single, F.lit(0)).otherwise(F.col(c)).cast("bigint") for c in CONFUSION})


def rates(counts: DataFrame) -> DataFrame:
    """Accuracy, precision, recall and F1 from confusion counts; 0 where undefined."""
    tn, fp, fn, tp = map(F.col, CONFUSION)
    return counts.withColumns(
        {
            "accuracy": _share(tn + tp, tn + fp + fn + tp),
            "precision": _share(tp, tp + fp),
            "recall": _share(tp, tp + fn),
            "f1_score": _share(2 * tp, 2 * tp + fp + fn),
        }
    )


def class_report(
    df: DataFrame, by: Sequence[str] = (), label: str = "label", predicted: str = "prediction_label",
    names: tuple[str, str] = ("No Default", "Default"),
) -> DataFrame:
    """Per class and overall rows: precision, recall, F1 and support."""
    counts = df.groupBy(*by).agg(*confusion_columns(label, predicted))
    tn, fp, fn, tp = map(F.col, CONFUSION)

    def scores(hit: Column, wrong: Column, missed: Column) -> list[Column]:
        return [_share(hit, hit + wrong), _share(hit, hit + missed), _share(2 * hit, 2 * hit + wrong + missed)]

    zero, one = scores(tn, fn, fp), scores(tp, fp, fn)
    n_zero, n_one = tn + fp, tp + fn
    total = n_zero + n_one
    accuracy = _share(tn + tp, total)
    macro = [(a + b) / 2 for a, b in zip(zero, one)]
    weighted = [_share(a * n_zero + b * n_one, total) for a, b in zip(zero, one)]
    # the accuracy row repeats one number, as printed reports do
    rows = [
        (names[0], zero, n_zero),
        (names[1], one, n_one),
        ("accuracy", [accuracy] * 3, total),
        ("macro avg", macro, total),
        ("weighted avg", weighted, total),
    ]
    fields = ("precision", "recall", "f1_score")
    structs = [
        F.struct(
            F.lit(name).alias("class"),
            *[v.alias(f) for v, f in zip(values, fields)],
            support.cast("bigint").alias("support"),
        )
        for name, values, support in rows
    ]
    return counts.select(*by, F.inline(F.array(*structs)))


def score_distribution(
    df: DataFrame, by: Sequence[str] = (), score: str = "prediction_proba", rows_per_cell: int = ranking.ROWS_PER_CELL
) -> DataFrame:
    """Mean, population std, min, max and exact median of the score."""
    name = "prediction_proba"
    moments = df.groupBy(*by).agg(*_moments(score, name))
    median = ranking.medians(df, by, score, f"median_{name}", rows_per_cell)
    return _beside(moments, median, by)


def _moments(score: str, name: str) -> list[Column]:
    return [
        F.avg(score).alias(f"mean_{name}"),
        F.stddev_pop(score).alias(f"std_{name}"),
        F.min(score).alias(f"min_{name}"),
        F.max(score).alias(f"max_{name}"),
    ]


def _beside(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    """Put one row per group next to one row per group."""
    if by:
        return ranking.null_safe_join(left, right, by, "left")
    names = [c for c in right.columns if c not in left.columns]
    return left.withColumns({c: right.select(c).scalar() for c in names})


def class_counts(label: str = "label", predicted: str = "prediction_label") -> list[Column]:
    """Rows and both classes on either side; a null is in neither class."""

    def sides(column: str, name: str) -> list[Column]:
        return [F.count_if(F.col(column) == 1).alias(f"{name}_positives"), F.count_if(F.col(column) != 1).alias(f"{name}_negatives")]

    return [F.count(F.lit(1)).alias("total_samples"), *sides(label, "actual"), *sides(predicted, "predicted")]


def class_balance(
    df: DataFrame, by: Sequence[str] = (), label: str = "label", predicted: str = "prediction_label"
) -> DataFrame:
    """Actual and predicted counts with their shares in percent."""
    counts = df.groupBy(*by).agg(*class_counts(label, predicted))
    names = ("actual_positives", "actual_negatives", "predicted_positives", "predicted_negatives")
    return counts.withColumns({f"{n}_pct": 100 * F.col(n) / F.col("total_samples") for n in names})


def per_score(
    df: DataFrame, by: Sequence[str], label: str = "label", score: str = "prediction_proba", predicted: str = "prediction_label"
) -> DataFrame:
    """Counts per group and score, written once: all metrics follow from them."""
    counts = df.groupBy(*by, F.col(score).alias("score")).agg(*confusion_columns(label, predicted), *class_counts(label, predicted))
    return lineage.settled(counts, "per-score")


def model_metrics(
    df: DataFrame, by: Sequence[str] = ("model_id", "model_type", "snapshot_date"), label: str = "label",
    score: str = "prediction_proba", predicted: str = "prediction_label",
    rows_per_cell: int = ranking.ROWS_PER_CELL,
) -> DataFrame:
    """The full monitoring row per group: counts, rates, AUC and score distribution.

    The rows are read once, to counts per score; rates, moments, AUC and median come from these.
    """
    counts = per_score(df, by, label, score, predicted)
    names = [*CONFUSION, "total_samples", *(f"{a}_{b}" for a in ("actual", "predicted") for b in ("positives", "negatives"))]
    valued = F.when(F.col("score").isNotNull(), F.col("total_samples"))
    mean = F.sum(F.col("score") * valued) / F.sum(valued)
    base = counts.groupBy(*by).agg(
        *[F.sum(c).alias(c) for c in names], mean.alias("mean_prediction_proba"),
        F.min("score").alias("min_prediction_proba"), F.max("score").alias("max_prediction_proba"),
    )
    apart = ranking.null_safe_join(counts.where("score is not null"), base.select(*by, "mean_prediction_proba"), by) if by else None
    if apart is None:
        apart = counts.where("score is not null").withColumn("mean_prediction_proba", base.select("mean_prediction_proba").scalar())
    squares = F.sum(F.col("total_samples") * F.pow(F.col("score") - F.col("mean_prediction_proba"), 2)) / F.sum("total_samples")
    spread = apart.groupBy(*by).agg(F.sqrt(squares).alias("std_prediction_proba"))
    positives, negatives = F.col("actual_positives").cast("double"), F.col("actual_negatives").cast("double")
    weights = counts.where("score is not null").select(*by, "score", positives.alias("_pos"), negatives.alias("_neg"), F.col("total_samples").alias("_n"))
    ranks = ranking.auc_and_median_of(weights, by, "score", "median_prediction_proba", rows_per_cell)
    return _beside(_beside(rates(base), spread, by), ranks, by)
