"""A training corpus from raw documents.

Stages, in order: documents of low quality go, toxic documents go, one document of each group
of near duplicates stays, passages that another document has already are taken out, and what
is left is packed into sequences. Each stage works on all that the one before it kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm import packing, quality, simhash, substrings, toxicity
from tallyspark.llm.common import materialize, ship_package
from tallyspark.llm.queries import VOCABULARY, public_tokenizers


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text the quality model accepts, as they are; null and empty texts are scored like others."""
    return quality.good_rows(docs, _labels(spark, sf_dir))


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text scores below the toxicity threshold, as they are."""
    return toxicity.clean_rows(docs, _labels(spark, sf_dir))


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates, that of the least id; null ids come last."""
    ship_package(spark)
    return simhash.representatives(docs)


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, without the words that a document with a smaller id has in a passage; other texts stay as they are."""
    ship_package(spark)
    stripped = substrings.strip_repeats(docs)
    return stripped.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else stripped


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of each text, with its place in a sequence."""
    ship_package(spark)
    return packing.pack(docs, public_tokenizers.path(VOCABULARY))


STAGES = [
    ("quality", good_quality),
    ("toxicity", not_toxic),
    ("near_duplicates", one_of_near_duplicates),
    ("repeated_passages", without_repeated_passages),
    ("packing", packed),
]

# trained models and hashes are beyond SQL; the tests compare with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
