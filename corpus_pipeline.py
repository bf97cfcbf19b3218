"""Pipeline from documents to token ids: quality, near-duplicates, benchmark passages, personal data, encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is stored as Parquet and read again as the next
stage's documents. All but the last return the columns of documents. The benchmark and the labels come from `sf_dir`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradewise.llm import bpe, decontaminate, pii, quality_rules, setsketch
from gradewise.llm.tables import stored

# Texts with this share of their five-word shingles in common are near-duplicates.
NEAR_PERCENT = 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the classifier."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_rules.keep(docs, quality_rules.train(docs, labels))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the smallest id."""
    return setsketch.keep_one(docs, percent=NEAR_PERCENT)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.remove(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind, and their length brought up to date."""
    redacted = pii.redact(docs, pii.train(docs))
    return redacted.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and digests of the ids and of the text that they decode to."""
    coded = bpe.encode(docs)
    return coded.select(
        "doc_id", "n_tokens", "ids", F.sha2("packed_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality_rules", quality),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminated),
    ("pii", private),
    ("bpe", encoded),
]

# Trained models and merges of byte pairs can't be put in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
