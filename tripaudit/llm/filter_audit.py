"""Filter interaction audit: what each of five filters removes under all 120 orders of application.

A document is reduced to the mask of filters it fails. In which orders a mask is
removed at a step depends on the mask alone: the filters before must pass it,
the filter of the step must fail it, what follows is free. So those orders are
intervals of the lexicographic ranks of the permutations, and counts of masks
are added at interval ends and summed over the ranks.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripaudit.llm.common import keep, let, words_column

FILTERS = "ABCDE"
MIN_WORDS = 50
SYMBOLS = "#$%&*|"
# In lexicographic order, so that the rank is the position.
ORDERS = ["".join(p) for p in permutations(FILTERS)]
MEASURES = ["n", "good", "toxic"]


def lehmer_rank(prefix: str, letters: str = FILTERS) -> int:
    """Rank of the first permutation of ``letters`` (sorted) that starts with ``prefix``."""
    left, rank = sorted(letters), 0
    for letter in prefix:
        at = left.index(letter)
        left.pop(at)
        rank += at * factorial(len(left))
    return rank


def removal_intervals(mask: int, letters: str = FILTERS) -> dict[int, list[tuple[int, int]]]:
    """Per step, the half-open rank intervals of orders that remove ``mask`` there; neighbours are merged."""
    found: dict[int, list[tuple[int, int]]] = {}

    def walk(prefix: str) -> None:
        for i, letter in enumerate(letters):
            if letter in prefix:
                continue
            longer = prefix + letter
            if not mask >> i & 1:
                walk(longer)
                continue
            start = lehmer_rank(longer, letters)
            end = start + factorial(len(letters) - len(longer))
            own = found.setdefault(len(longer), [])
            if own and own[-1][1] == start:
                own[-1] = (own[-1][0], end)
            else:
                own.append((start, end))

    walk("")
    return found


def _ends() -> list[tuple[int, int, int, int]]:
    """``mask, step, rank, sign`` at which a mask's count enters and leaves; fixed by the five letters."""
    rows = []
    for mask in range(1, 1 << len(FILTERS)):
        for step, intervals in removal_intervals(mask).items():
            for start, end in intervals:
                rows.append((mask, step, start, 1))
                if end < len(ORDERS):
                    rows.append((mask, step, end, -1))
    return rows


def text_mask(text: Column) -> Column:
    """Bits 0 to 3: what a text fails of A to D; a null text counts as empty."""
    text = F.coalesce(text, F.lit(""))

    def bits(words: Column) -> Column:
        n = F.size(words)
        conditions = [
            n < MIN_WORDS,
            100 * F.size(F.array_distinct(words)) < 65 * n,
            100 * F.char_length(F.regexp_replace(text, "[^A-Z]+", "")) > 5 * F.char_length(text),
            text.rlike(f"[{SYMBOLS}]"),
        ]
        return sum((F.when(c, 1 << i).otherwise(0) for i, c in enumerate(conditions)), F.lit(0))

    return let(words_column(text), bits)


def mask_counts(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, part_col: str) -> DataFrame:
    """``part, mask, n, good, toxic``: documents by the filters they fail, at most 32 rows a part.

    Copies are told by the SHA-256 of the text. Rows travel without their text;
    equal copies are counted per part before they meet their smallest id.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("_id"),
        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text, 256)).alias("_digest"),
        text_mask(F.col(text_col)).alias("_mask"),
    )
    flags = (
        labels.where(F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").alias("_id"))
        .agg(
            F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
            F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"),
        )
    )
    marked = rows.join(flags, "_id", "left").select(
        "_id", "part", "_digest", "_mask", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic")
    )
    kind = ["_digest", "part", "_mask", "good", "toxic"]
    by_id = marked.groupBy("_id", *kind).agg(F.count("*").alias("n"))
    has_id = F.col("_id").isNotNull()
    copies = by_id.groupBy(*kind).agg(
        F.sum("n").alias("n"),
        F.sum(F.when(has_id, F.lit(0)).otherwise(F.col("n"))).alias("_no_id"),
        F.min(F.when(has_id, F.struct("_id", "n"))).alias("_first"),
    )
    copies = keep(copies, "copies")
    least = copies.groupBy("_digest").agg(F.min("_first._id").alias("_least"))
    at_least = F.when(F.col("_first._id") == F.col("_least"), F.col("_first.n")).otherwise(0)
    passing = F.col("_no_id") + at_least
    both = F.array(
        F.struct(F.col("_mask").alias("mask"), passing.alias("n")),
        F.struct((F.col("_mask") + 16).alias("mask"), (F.col("n") - passing).alias("n")),
    )
    split = copies.join(least, "_digest").select("part", "good", "toxic", F.explode(both).alias("_m")).where("_m.n > 0")
    n = F.col("_m.n")
    return split.groupBy("part", F.col("_m.mask").alias("mask")).agg(
        F.sum(n).alias("n"), F.sum(n * F.col("good")).alias("good"), F.sum(n * F.col("toxic")).alias("toxic")
    )


def step_counts(counts: DataFrame) -> DataFrame:
    """The audit's rows from the mask counts of its parts (at most 32 each), by difference arrays over the ranks."""
    spark = counts.sparkSession
    ends = F.broadcast(spark.createDataFrame(_ends(), "mask int, step int, rank int, sign int"))
    changes = counts.join(ends, "mask").select("part", "step", "rank", *[(F.col("sign") * F.col(m)).alias(m) for m in MEASURES])
    grid = counts.select("part").distinct()
    grid = grid.select("part", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))
    grid = grid.select("part", "step", F.explode(F.sequence(F.lit(0), F.lit(len(ORDERS) - 1))).alias("rank"))
    grid = grid.select("*", *[F.lit(0).cast("long").alias(m) for m in MEASURES])
    # One exchange by part: a part has a bounded number of rows, and all windows below begin with it.
    summed = changes.unionByName(grid).repartition("part").groupBy("part", "step", "rank").agg(*[F.sum(m).alias(m) for m in MEASURES])
    over_ranks = Window.partitionBy("part", "step").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    order = F.element_at(F.array(*map(F.lit, ORDERS)), F.col("rank") + 1)
    removed = summed.select(
        "part", "step", "rank", order.alias("filter_order"), F.substring(order, F.col("step"), F.lit(1)).alias("_filter"),
        *[F.sum(m).over(over_ranks).alias(m) for m in MEASURES],
    )
    bit = [F.shiftright("mask", i).bitwiseAND(F.lit(1)) for i in range(len(FILTERS))]
    totals = counts.groupBy("part").agg(
        F.sum("n").alias("_docs"),
        F.array(*[F.sum(b * F.col("n")) for b in bit]).alias("_fails"),
        F.array(*[F.sum(F.when(F.col("mask") == 1 << i, F.col("n")).otherwise(0)) for i in range(len(FILTERS))]).alias("_only"),
    )
    over_steps = Window.partitionBy("part", "rank").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    over_filter = Window.partitionBy("part", "_filter")
    number = F.instr(F.lit(FILTERS), F.col("_filter"))
    return (
        removed.withColumn("_so_far", F.sum("n").over(over_steps))
        .withColumn("shapley", F.sum("n").over(over_filter))
        .join(totals, "part")
        .select(
            "part", "filter_order", "step",
            (F.col("_docs") - F.col("_so_far")).alias("kept"),
            F.col("n").alias("removed"),
            (F.element_at("_fails", number) - F.col("n")).alias("redundant"),
            F.element_at("_only", number).alias("unique_fails"),
            F.col("good").alias("good_lost"),
            F.col("toxic").alias("toxic_lost"),
            "shapley",
        )
    )


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """One row per part, order of the five filters and step, with the documents kept, removed and lost there.

    A null text is empty and fails A only, and E where a smaller id is empty
    too. A null or empty part is the part ''. Repeated rows count each; rows
    with one id and text are not copies of one another. A row without an id is
    no copy and makes no other row one. A document is good or toxic if any label
    row of its id says so; labels of null or unknown ids do nothing. An empty
    table has no parts and gives no rows; other columns are not looked at.
    """
    return step_counts(keep(mask_counts(docs, labels, id_col, text_col, part_col), "masks"))
