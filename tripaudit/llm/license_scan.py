"""License scan by diagonal voting, native only."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripaudit.llm.common import let

# Phrases that count as base places, with their labels.
PHRASES = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]
UPPER = string.ascii_uppercase

# Customary license sentences, lower case without punctuation, with their labels.
SENTENCES = [
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit"),
    ("released under the mit license", "mit"),
    ("licensed under the apache license version 2 0", "apache"),
    ("you may not use this file except in compliance with the license", "apache"),
    ("this work is licensed under the gnu general public license version", "gpl"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu", "gpl"),
    ("gnu lesser general public license", "lgpl"),
    ("mozilla public license", "mpl"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("licensed under cc by 4 0", "cc-by"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("licensed under cc by sa 4 0", "cc-by-sa"),
    ("licensed under a creative commons attribution 4 0 international license", "cc-by"),
    ("all rights reserved", "reserved"),
]
WORD_GAP = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
MERGE = 2  # diagonals at most so far apart belong to one span
COVERAGE = 0.85  # share of a sentence's word pairs that a span needs
MARK = -1  # template number of the row that stands for the document itself


def templates(spark: SparkSession, phrases=None, sentences=None) -> DataFrame:
    """One row per word pair of every template (a fixed, small table) and one for the document mark."""
    values = [f"({MARK}, '', false, 1, 0L, 0L, NULL, NULL)"]
    both = [(t, label, "true") for t, label in (phrases or PHRASES)] + [(t, label, "false") for t, label in (sentences or SENTENCES)]
    for number, (text, label, base) in enumerate(both):
        words = text.split()
        if not 2 <= len(words) <= 63 or not (text + label).isascii() or "'" in text + label:
            raise ValueError("a template has 2 to 63 plain words")
        for i in range(len(words) - 1):
            values.append(f"({number}, '{label}', {base}, {len(words) - 1}, {i}L, {1 << i}L, '{words[i]}', '{words[i + 1]}')")
    frame = spark.sql(f"SELECT * FROM VALUES {', '.join(values)} AS v(_t, _label, _base, _pairs, _at, _bit, _w1, _w2)")
    return frame.withColumn("_hash", F.when(F.col("_t") == MARK, F.lit(0).cast("long")).otherwise(F.xxhash64("_w1", "_w2")))


def _words(text: Column) -> Column:
    return F.filter(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower()), WORD_GAP), lambda w: w != "")


def scan(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", phrases=None, sentences=None) -> DataFrame:
    """Per document ``n_words, n_base, first_word, last_word, base_labels, labels, score``, one row per input row.

    All word pairs of all texts are hashed and joined to the template
    positions; votes are summed per offset diagonal; diagonals at most
    ``MERGE`` apart become one span, which so tolerates a lost or added word;
    pairs are verified by their words. A phrase counts where one diagonal
    holds all its pairs. A sentence labels a document from ``COVERAGE`` on.
    ``score`` is the largest share of a template's pairs found in one span.

    Null and empty texts have no words and score 0; equal rows give equal
    rows again; rows of one id with different texts are told apart; an empty
    table gives an empty result; other columns are not looked at.
    """
    spark = docs.sparkSession
    pairs = lambda words: F.concat(
        F.transform(F.slice(words, F.lit(1), F.greatest(F.size(words) - 1, F.lit(0))), lambda w, i: F.xxhash64(w, F.get(words, i + 1))),
        F.array(F.lit(0).cast("long")),
    )
    rows = docs.select(
        F.col(id_col).alias("_id"),
        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("_text"),
        let(_words(F.col(text_col)), lambda w: F.struct(w.alias("words"), pairs(w).alias("pairs"))).alias("_s"),
    )
    grams = rows.select("_id", "_text", F.col("_s.words").alias("_words"), F.posexplode("_s.pairs").alias("_pos", "_gram"))
    joined = grams.join(F.broadcast(templates(spark, phrases, sentences)), F.col("_gram") == F.col("_hash"))
    n = F.size("_words")
    real = (F.get("_words", F.col("_pos")) == F.col("_w1")) & (F.get("_words", F.col("_pos") + 1) == F.col("_w2"))
    last = F.col("_pos") == F.greatest(n - 1, F.lit(0))
    votes = joined.where(F.when(F.col("_t") == MARK, last).otherwise(real)).select(
        "_id", "_text", "_t", "_label", "_base", "_pairs", "_bit", n.alias("_n"),
        F.when(F.col("_t") == MARK, F.lit(0)).otherwise(F.col("_pos") - F.col("_at")).alias("_diagonal"),
    )
    # A text's votes are few and stay together from here on: one exchange.
    votes = votes.repartition("_id", "_text")
    key = ["_id", "_text", "_t", "_label", "_base", "_pairs"]
    diagonals = votes.groupBy(*key, "_diagonal").agg(
        F.bit_or("_bit").alias("_bits"), F.count("*").alias("_rows"), F.max("_n").alias("_n")
    )
    order = Window.partitionBy(*key).orderBy("_diagonal")
    gap = F.coalesce(F.col("_diagonal") - F.lag("_diagonal").over(order) > MERGE, F.lit(False))
    spans = (
        diagonals.withColumn("_gap", F.when(gap, 1).otherwise(0))
        .withColumn("_span", F.sum("_gap").over(order))
        .groupBy(*key, "_span")
        .agg(
            F.bit_count(F.bit_or("_bits")).alias("_votes"),
            F.sum(F.when(F.bit_count("_bits") == F.col("_pairs"), 1).otherwise(0)).alias("_places"),
            F.min(F.when(F.bit_count("_bits") == F.col("_pairs"), F.col("_diagonal"))).alias("_first"),
            F.max(F.when(F.bit_count("_bits") == F.col("_pairs"), F.col("_diagonal"))).alias("_last"),
            F.max("_rows").alias("_rows"),
            F.max("_n").alias("_n"),
        )
    )
    share = F.col("_votes") / F.col("_pairs")
    mark, base = F.col("_t") == MARK, F.col("_base")
    hit = F.when(base, F.col("_places") > 0).otherwise(~mark & (share >= COVERAGE))
    join = lambda when: F.array_join(F.array_sort(F.collect_set(F.when(when, F.col("_label")))), ",")
    found = spans.groupBy("_id", "_text").agg(
        F.max(F.when(mark, F.col("_rows"))).cast("int").alias("_copies"),
        F.max(F.when(mark, F.col("_n"))).cast("long").alias("n_words"),
        F.sum(F.when(base, F.col("_places")).otherwise(0)).cast("long").alias("n_base"),
        F.min(F.when(base, F.col("_first"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("_last"))).cast("long").alias("last_word"),
        join(base & hit).alias("base_labels"),
        join(hit).alias("labels"),
        F.max(F.when(mark, F.lit(0.0)).otherwise(share)).alias("score"),
    )
    copies = F.explode(F.array_repeat(F.lit(0), F.col("_copies")))
    return found.select(
        F.col("_id").alias(id_col), "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", copies.alias("_copy")
    ).drop("_copy")
