"""From raw documents to packed sequences, stage by stage.

A stage takes (spark, docs, sf_dir) and returns a DataFrame that is written and read again as
the docs of the next. All but the last return the columns of documents.

1. ``language``: texts without letters, and those whose words are split over languages so that none has
   half, go; lang becomes the predicted one.
2. ``near_duplicates``: one document of each group stays, that with the smallest id.
3. ``secrets``: every secret is replaced by a mark in the text; no document goes.
4. ``mix``: a row per repetition of a document, as the sources' targets ask for.
5. ``pack``: pieces of documents in sequences of at most 2,048 tokens.

Defined results: empty and null texts have no language and go in the first stage. Rows without
an id are kept by the second. Repeated rows leave one row. An empty table gives no rows. Columns beyond
those of documents stay until the last stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenorlake.llm import langid, mixing, neardup, packing, secrets
from tenorlake.sources import lineage

LEAST_SCORE = 0.5
TOKENIZER = "word_bpe_49k.json"


def _sized(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.labelled(docs, langid.fitted(docs), LEAST_SCORE)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.deduplicated(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _sized(secrets.masked(docs))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _sized(mixing.repeated(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path(TOKENIZER))


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("secrets", mask_secrets), ("mix", mix), ("pack", pack)]
#: SQL can't express the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written below the shared folder and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = lineage.settled(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
