"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripaudit.llm import best_fit, centroids, embedding_dedup, filter_audit, host_rules, html_text, jaccard_join, license_scan, lm_scoring, packing, piece_sampling, quality_classifier, tool_calls
from tripaudit.llm.common import table
from tripaudit.llm.oracle import ORACLE_SQL  # noqa: F401
from tripaudit.session import configure

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(configure(spark), sf_dir)

    run.__doc__ = fn.__doc__
    REGISTRY[fn.__name__] = run
    return fn


@query
def op1_lm_scoring(spark, sf):
    """Log-likelihoods of all documents; one in ten, by the checksum of its id, is held out of training."""
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 10 == 0
    return lm_scoring.score(table(spark, sf, "documents"), held)


@query
def op2_embedding_dedup(spark, sf):
    """Near-duplicate groups of all embeddings."""
    return embedding_dedup.dedup(table(spark, sf, "embeddings"))


@query
def op3_tool_calls(spark, sf):
    """Calls and results of all conversations, linked, validated and serialised."""
    return tool_calls.link(*tool_calls.calls_and_results(table(spark, sf, "conversations")))


@query
def op4_piece_sampling(spark, sf):
    """Sampled segmentations of all documents, with checksums of the ids and of what they decode to."""
    found = piece_sampling.sample(table(spark, sf, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return found.select(
        "doc_id", "rank", (F.octet_length("ids") / 4).cast("long").alias("n_pieces"), F.crc32("ids").alias("ids_crc32"),
        "log_prob", "perturbed", "log_inclusion", F.crc32(F.col("decoded").cast("binary")).alias("text_crc32"),
    )


@query
def op5_packing(spark, sf):
    """All documents packed into sequences of 1024 tokens."""
    pieces = packing.pack(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query
def op6_quality_classifier(spark, sf):
    """Scores of all documents by co-trained views."""
    scored = quality_classifier.classify(table(spark, sf, "documents"), table(spark, sf, "labels"))
    return scored.select("doc_id", *quality_classifier.ADDED)


@query
def op7_host_rules(spark, sf):
    """Counts, base rules and host verdicts of all documents."""
    docs = table(spark, sf, "documents").select("doc_id", "source", "text")
    judged = host_rules.judge(docs, carry_text=False)
    return judged.select("doc_id", *host_rules.COUNTS, "base_failed", "kept")


@query
def op8_html_text(spark, sf):
    """Main text of all pages."""
    return html_text.extract_pages(table(spark, sf, "pages")).withColumn("n_chars", F.char_length("text").cast("long"))


@query
def op9_jaccard_join(spark, sf):
    """Near-duplicate groups of all documents."""
    return jaccard_join.join(table(spark, sf, "documents"))


@query
def op10_license_scan(spark, sf):
    """License phrases and sentences of all documents."""
    return license_scan.scan(table(spark, sf, "documents"))


@query
def op11_filter_audit(spark, sf):
    """What each of five filters removes from the documents of every source under all orders."""
    return filter_audit.audit(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query
def op12_best_fit(spark, sf):
    """All documents packed into few sequences of at most 2048 tokens."""
    pieces = best_fit.pack(table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


@query
def op13_centroids(spark, sf):
    """Clusters of all embeddings of 64 components."""
    return centroids.cluster(table(spark, sf, "embeddings"))


@query
def pipeline(spark, sf):
    """Documents classified, judged, deduplicated and packed."""
    return corpus_pipeline.run(spark, sf)


if corpus_pipeline.ORACLE_SQL:
    ORACLE_SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
