"""The corpus pipeline: from documents to packed training sequences.

Each stage takes what the one before kept and returns the columns of documents,
the last one the boundary records of the packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adperf.llm import lines, mixing, neardup, packing, quality
from adperf.sources.staging import stage

#: Shares of the tokens by domain; no document is repeated, so the clean ones stay whole.
WEIGHTS = {"good": 0.9, "poor": 0.1, "toxic": 0.0}


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return quality.keep(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that match an earlier one go; so do documents of which nothing is left."""
    rows = lines.deduplicated(docs)
    return rows.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if (
        "n_chars" in docs.columns) else rows


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return neardup.first_of_groups(docs)


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents stay at rates that bring the domains' tokens to their weights."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return mixing.mixed(docs, labels, weights=WEIGHTS, max_rate=1.0)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boundary records of the documents in sequences."""
    return packing.piece_digests(packing.pack(docs))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mix_domains", mix_domains),
    ("packing", pack),
]
#: Mixture rates and trained models have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over documents, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
