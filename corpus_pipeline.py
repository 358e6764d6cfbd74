"""A training corpus from raw documents, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm import line_dedup, near_dedup, packing, quality, secrets
from skyledger.sources.scratch import materialize


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go.

    Labels name documents by id, so it learns from those that are still here.
    """
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.accepted(quality.score(docs, model))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines on more than a tenth of a source's documents go; no document does.

    Copies count once: of a group of them the next stage keeps one, with its text.
    """
    kept = line_dedup.drop_boilerplate(docs, copies=False).select(*docs.columns)
    return kept.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), "n_chars"))


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one with the least id."""
    return near_dedup.one_of_each(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every span that the scan reports gives way to a mask; no document goes."""
    masked = secrets.redact(secrets.find_secrets(docs)).select(*docs.columns)
    return masked.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), "n_chars"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut the tokens of every document into pieces of power-of-two length."""
    return packing.piece_digests(packing.pack(docs))


STAGES = [
    ("quality classifier", classify_quality),
    ("line dedup", dedup_lines),
    ("MinHash near-dedup", dedup_near),
    ("secret scans", mask_secrets),
    ("packing", pack),
]

# The quality classifier has no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is stored and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
