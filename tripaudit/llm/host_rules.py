"""Host-level quality rules, native only: rule failures per host, shrunk rates, verdicts back to documents.

Every expression is a built-in column function; the text never leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripaudit.llm.common import SPACE_CHARS, keep, let, words_column

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
# A host with a shrunk failure rate of BLOCKED or more loses all documents; from WATCHED on its
# documents must also pass the milder rules.
BLOCKED, WATCHED = 0.5, 0.2
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _repeat_words(words: Column) -> Column:
    """Words covered by 3-word windows that occur twice or more in the text."""

    def covered(sorted_windows: Column) -> Column:
        twice = F.filter(
            sorted_windows,
            lambda s, i: F.coalesce(
                (s["h"] == F.get(sorted_windows, i - 1)["h"]) | F.lit(False), F.lit(False)
            )
            | F.coalesce(s["h"] == F.get(sorted_windows, i + 1)["h"], F.lit(False)),
        )
        starts = F.array_sort(F.transform(twice, lambda s: s["i"]))
        # A start covers three words, less what the next start covers again.
        return let(
            starts,
            lambda at: F.aggregate(
                F.transform(at, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(at, i + 1) - p, F.lit(3)))),
                F.lit(0),
                lambda total, gain: total + gain,
            ),
        )

    def of_hashes(hashes: Column) -> Column:
        windows = F.transform(
            F.slice(hashes, F.lit(1), F.size(hashes) - 2),
            lambda h, i: F.xxhash64(h, F.get(hashes, i + 1), F.get(hashes, i + 2)),
        )
        return let(
            windows,
            lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(
                let(F.array_sort(F.transform(w, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), covered)
            ),
        )

    hashed = let(F.transform(words, lambda w: F.xxhash64(w)), of_hashes)
    return F.when(F.size(words) < 4, F.lit(0)).otherwise(hashed)


def _dup_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(SPACE_CHARS)) != "")
    return let(lines, lambda found: F.size(found) - F.size(F.array_distinct(found)))


def with_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Add the five counts, ``n_lines`` and ``base_failed``; a null text counts as empty.

    Columns of these names that are already there are replaced.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))

    def counts(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.char_length(F.array_join(words, "")).cast("long").alias("word_chars"),
            F.char_length(F.regexp_replace(text, f"[^{SYMBOLS}]+", "")).cast("long").alias("n_symbols"),
            _dup_lines(text).cast("long").alias("n_dup_lines"),
            _repeat_words(words).cast("long").alias("n_repeat_words"),
            F.size(F.split(text, "\n")).cast("long").alias("n_lines"),
        )

    names = [*COUNTS, "n_lines"]
    found = docs.drop("_c", *names, "base_failed").withColumn("_c", let(words_column(F.col(text_col)), counts))
    wide = found.select("*", *[F.col("_c")[n].alias(n) for n in names]).drop("_c")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return wide.withColumn("base_failed", failed)


def mild_failures() -> Column:
    """How many of the milder rules a counted document fails."""
    rules = [
        F.col("n_symbols") * 10 > F.col("n_words"),
        F.col("n_dup_lines") * 10 > F.col("n_lines") * 3,
        (F.col("word_chars") < 2 * F.col("n_words")) | (F.col("word_chars") > 15 * F.col("n_words")),
    ]
    return sum((F.when(r, 1).otherwise(0) for r in rules), F.lit(0))


def host_rates(counted: DataFrame, host_col: str) -> DataFrame:
    """One row per host: ``host``, ``n_docs``, ``n_failed``, ``shrunk_rate``.

    The beta prior is fitted to all hosts by moments: its mean is the overall
    failure rate, its strength what the spread between hosts leaves beyond
    binomial noise. A null host is the host ''.
    """
    bad = F.col("base_failed") | (F.col("_mild") > 0)
    hosts = counted.groupBy(F.coalesce(F.col(host_col).cast("string"), F.lit("")).alias("host")).agg(
        F.count("*").alias("n_docs"), F.sum(F.when(bad, 1).otherwise(0)).alias("n_failed")
    )
    n, f = F.col("n_docs"), F.col("n_failed")
    prior = hosts.agg(
        F.sum(n).alias("_n"), F.sum(f).alias("_f"), F.count("*").alias("_hosts"), F.sum(f * f / n).alias("_ff")
    )
    mean = F.col("_f") / F.col("_n")
    between = (F.col("_ff") - F.col("_f") * mean - mean * (1 - mean) * (F.col("_hosts") - 1)) / F.col("_n")
    strength = F.when(
        (between > 0) & (mean > 0) & (mean < 1), F.least(F.lit(1e6), F.greatest(F.lit(1.0), mean * (1 - mean) / between - 1))
    ).otherwise(F.lit(1e6))
    prior = prior.select(mean.alias("_mean"), strength.alias("_strength"))
    joined = hosts.join(F.broadcast(prior))  # one row
    return joined.select(
        "host", "n_docs", "n_failed", ((f + F.col("_mean") * F.col("_strength")) / (n + F.col("_strength"))).alias("shrunk_rate")
    )


def judge(docs: DataFrame, text_col: str = "text", host_col: str = "source", carry_text: bool = True) -> DataFrame:
    """Documents with their counts, ``base_failed``, ``host_rate`` and ``kept``, one row per input row.

    A document is kept if it passes the base rules, its host is not blocked
    (shrunk failure rate below ``BLOCKED``) and, on a watched host (``WATCHED``
    or more), it also passes the milder rules. Null and blank texts fail the
    base rules; an empty table gives an empty result; repeated rows stay and
    count each; columns of the names added here are replaced. The counted rows
    are kept in the shared scratch folder so that texts are read once. The host
    table is kept too: its size is then known, and Spark broadcasts it where it
    is small and otherwise joins two plain scans, of which it can split a hot host.
    """
    counted = with_counts(docs, text_col).withColumn("_mild", mild_failures())
    counted = keep(counted if carry_text else counted.drop(text_col), "host-rules")
    rates = keep(host_rates(counted, host_col), "hosts")
    hosts = rates.select(F.col("host").alias("_host"), F.col("shrunk_rate").alias("host_rate"))
    key = F.coalesce(F.col(host_col).cast("string"), F.lit(""))
    joined = counted.drop("host_rate", "kept").withColumn("_key", key).join(hosts, F.col("_key") == F.col("_host"), "left")
    ok = (F.col("host_rate") < BLOCKED) & ((F.col("host_rate") < WATCHED) | (F.col("_mild") == 0))
    return joined.withColumn("kept", ~F.col("base_failed") & ok).drop("_key", "_host", "_mild")
