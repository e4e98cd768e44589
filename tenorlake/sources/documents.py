"""JSON documents: monitoring metrics and action decisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The fields of a monitoring document.
COUNT_FIELDS = (
    "true_negatives", "false_positives", "false_negatives", "true_positives", "total_samples",
    "actual_positives", "actual_negatives", "predicted_positives", "predicted_negatives",
)
VALUE_FIELDS = (
    "accuracy", "roc_auc", "precision", "recall", "f1_score", "mean_prediction_proba",
    "median_prediction_proba", "std_prediction_proba", "min_prediction_proba", "max_prediction_proba",
)
TEXT_FIELDS = (
    "model_id", "model_type", "snapshot_date", "monitoring_timestamp",
    "prediction_snapshot_date", "label_snapshot_date",
)

METRIC_SCHEMA = ", ".join(
    [f"{c} string" for c in TEXT_FIELDS] + [f"{c} double" for c in VALUE_FIELDS] + [f"{c} bigint" for c in COUNT_FIELDS]
)


def _with_commas(text: Column) -> Column:
    """A comma between documents that follow each other; what stands in strings is left alone.

    Escaped backslashes and quotes are first written by their numbers, so every second part between quotes is a string.
    """
    plain = F.replace(F.replace(text, F.lit("\\\\"), F.lit("\\u005c")), F.lit('\\"'), F.lit("\\u0022"))
    apart = F.transform(F.split(plain, '"'), lambda p, i: F.when(i % 2 == 0, F.regexp_replace(p, r"\}\s*\{", "},{")).otherwise(p))
    return F.array_join(apart, '"')


def read_metric_documents(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """All metric documents as one table with their file name, by snapshot date.

    One document per line, as :func:`write_documents` has them. With ``multi_line`` documents may
    stretch over lines; a file is then read as a whole, with all the documents in it.
    """
    if multi_line:
        whole = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_name").alias("source_file"))
        listed = F.concat(F.lit("["), _with_commas(F.col("value")), F.lit("]"))
        docs = whole.select("source_file", F.inline(F.from_json(listed, f"array<struct<{METRIC_SCHEMA.replace(' ', ':').replace(',:', ',')}>>", {"mode": "FAILFAST"})))
    else:
        docs = spark.read.schema(METRIC_SCHEMA).json(path).withColumn("source_file", F.col("_metadata.file_name"))
    return (
        docs.withColumns(
            {
                "snapshot_date": F.col("snapshot_date").try_cast("date"),
                "monitoring_timestamp": F.try_to_timestamp(F.col("monitoring_timestamp"), F.lit("yyyy-MM-dd HH:mm:ss")),
            }
        )
        .orderBy("snapshot_date", "model_id")
    )


def write_documents(df: DataFrame, root: str, by: tuple[str, ...] = ("model_id",)) -> None:
    """JSON lines below one directory per key; rerunning replaces the keys written.

    The keys stay in the documents: the directories are named after copies of them.
    """
    df = df.withColumns({f"by_{c}": F.col(c) for c in by})
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("ignoreNullFields", False)
    writer.partitionBy(*[f"by_{c}" for c in by]).json(root)
