"""Corpus pipeline: five stages over the documents table, each calling one operator of ``tarmac.llm``.

A stage takes (spark, docs, sf_dir) and returns a DataFrame that the caller writes and reads
again as the next stage's ``docs``; ``run`` chains them without writing. All stages but the
last return every column of ``docs``. Null and empty texts, repeated rows, null ids and extra
columns are treated as the operators say; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm import decontam, mixing, pii, quality, ship, simhash, textnum


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from ``documents`` and ``labels``."""
    ship.ensure(spark)
    source = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.fit(source, labels, textnum.fold(F.col("doc_id"), 3) != 1)
    return quality.keep_good(docs, model)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    ship.ensure(spark)
    return simhash.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item."""
    ship.ensure(spark)
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; ``n_chars`` follows the text."""
    masked = pii.mask(docs)
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return masked


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """For each document how many of its words the mix takes."""
    return mixing.mix(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("personal_data", personal_data),
    ("source_mix", source_mix),
]

#: No stage but the last two could be said in SQL, so the pipeline is tested stage by stage instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each on what the one before it kept."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
