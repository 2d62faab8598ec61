"""The corpus pipeline: documents are classified, judged by rules, deduplicated and packed."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripaudit.llm import host_rules, jaccard_join, packing, quality_classifier
from tripaudit.llm.common import keep, table
from tripaudit.session import configure

# A trained classifier stands at the start: no SQL gives its rows.
ORACLE_SQL = None


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier accepts."""
    scored = quality_classifier.classify(docs, table(spark, sf_dir, "labels"))
    return scored.where("kept").select(*docs.columns)


def apply_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules on hosts that are not rejected."""
    return host_rules.judge(docs).where("kept").select(*docs.columns)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near-duplicates.

    Of rows that repeat an id and its text one stays; rows without an id stay
    unless all of them belong to a group with one.
    """
    joined = jaccard_join.join(docs)
    kept = joined.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("_kept")).distinct()
    left = docs.join(kept, docs["doc_id"].eqNullSafe(kept["_kept"]), "left_semi")
    return left.withColumn("_text", F.xxhash64("text")).dropDuplicates(["doc_id", "_text"]).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of what is left, in sequences of 1024 tokens."""
    # Workers still hold memory of the stages before: less text at once than in packing alone.
    pieces = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), text_bytes=2_000_000)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [("quality classifier", classify), ("quality rules", apply_rules), ("n-gram Jaccard join", deduplicate), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each but the last is kept as Parquet and read again."""
    configure(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
