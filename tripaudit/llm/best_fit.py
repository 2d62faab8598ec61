"""Bulk-synchronous best-fit packing: documents and gaps are range-sorted, matched by sweeps, and gaps updated, round by round."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripaudit.llm.common import Rolling, keep
from tripaudit.llm.unit_cache import LETTERS, SIGNS, UnitCache, text_slices

CAPACITY = 2048
PIECES = "row bigint, doc_id {id}, piece int, start bigint, length bigint, ids binary"


class Words(UnitCache):
    """Ids of texts by way of their white-space separated words.

    The tokenizer drops white space and no token spans it, so the ids of a text
    are those of its words. Nor does one span a letter or digit and a run of
    signs behind it. What is then letters only is one word to the tokenizer,
    the same in upper and lower case.
    """

    def __init__(self, path: str):
        super().__init__(path, led=False)

    def encode_units(self, units: list[str]) -> list[bytes]:
        bare = [u.rstrip(SIGNS) for u in units]
        bare = [b.lower() if LETTERS.fullmatch(b) else b if b[-1:].isalnum() else u for b, u in zip(bare, units)]
        signs = [u[len(b) :] for b, u in zip(bare, units)]
        ids = {"": b""}
        distinct = set(bare)
        words = list(filter(LETTERS.fullmatch, distinct))
        ids.update(zip(words, self.encode_words(words)))
        rest = list({*distinct.difference(words), *signs} - {""})
        ids.update(zip(rest, self.encode(rest)))
        return [ids[b] + ids[s] for b, s in zip(bare, signs)]

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, each with the closing id 0, and how many each has.

        Words are cut at the white space of ASCII.
        """
        cut = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        ids, n = self.gather(cut.flatten())
        ends = np.concatenate(([0], np.cumsum(n)))[cut.offsets.to_numpy()[1:]]
        return np.insert(ids, ends, 0), np.diff(ends, prepend=0) + 1


@lru_cache(maxsize=1)
def words(path: str) -> Words:
    return Words(path)


def _cut(keys: pa.Array, ids: np.ndarray, n: np.ndarray, first: int, capacity: int) -> pa.RecordBatch:
    """Pieces of at most ``capacity`` tokens, numbered from ``first``; their ids stay one buffer."""
    pieces = -(-n // capacity)
    item = np.repeat(np.arange(len(n)), pieces)
    piece = np.arange(len(item)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    start = piece * capacity
    length = np.minimum(n[item] - start, capacity)
    ends = np.concatenate(([0], np.cumsum(4 * length)))
    data = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(item), [None, pa.py_buffer(ends), pa.py_buffer(ids)])
    columns = [first + np.arange(len(item)), keys.take(pa.array(item)), piece.astype(np.int32), start, length, data.cast(pa.binary())]
    names = ["row", "doc_id", "piece", "start", "length", "ids"]
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=names)


def pieces_of(docs: DataFrame, tokenizer: str, id_col: str, text_col: str, capacity: int) -> DataFrame:
    """Token pieces of all documents; ``row`` is the task's number times 2^40 plus a running number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, row = words(tokenizer).ids, TaskContext.get().partitionId() << 40
        for batch in batches:
            for at, n in text_slices(batch.column(1)):
                part = batch.slice(at, n)
                cut = _cut(part.column(0), *ids_of(part.column(1)), row, capacity)
                row += cut.num_rows
                yield cut

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, PIECES.format(id=kind))


def _ranked(state: DataFrame) -> DataFrame:
    """``kind, size, key, part, rank``: range-sorted by size, documents before gaps, with the rank among equals in a part.

    Equal sizes are spread by key, so that a size of very many documents is cut too.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, seen = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            kind, size = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            if not len(kind):
                continue
            group = size.astype(np.int64) * 2 + kind
            starts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
            rank = np.arange(len(group)) - np.repeat(starts, np.diff(np.append(starts, len(group))))
            if group[0] == last:
                first = starts[1] if len(starts) > 1 else len(group)
                rank[:first] += seen
            last, seen = group[-1], int(rank[-1]) + 1
            more = [pa.array(np.full(len(kind), part, np.int32)), pa.array(rank)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=["kind", "size", "key", "part", "rank"])

    ordered = state.select("kind", "size", "key").repartitionByRange("size", "kind", "key").sortWithinPartitions("size", "kind", "key")
    return ordered.mapInArrow(run, "kind int, size int, key bigint, part int, rank bigint")


def sweep(counts: list[tuple[int, int, int, int]], capacity: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """One sweep over counted runs ``size, kind, part, n`` of equal rows, in order: where each run lies, and new gaps.

    Documents (kind 0) open a bracket, a gap (kind 1) closes as many as it has
    slots, as the largest document it can hold says, not more than the gaps
    need on average. Rank r of a document run is at the depth ``base + r + 1``, slot s of
    rank r of a gap run at ``base - r * slots - s``. A document's successor is the
    next slot at its own depth. Where no gap holds a document, gaps of the
    whole capacity are opened, as many as the tokens left need; they stand last.
    """
    sizes = sorted({size for size, kind, _, _ in counts if kind == 0})
    n_docs = sum(n for _, kind, _, n in counts if kind == 0)
    n_gaps = sum(n for size, kind, _, n in counts if kind == 1 and size >= sizes[0])
    opened = 0
    if not n_gaps:
        opened = n_gaps = -(-sum(size * n for size, kind, _, n in counts if kind == 0) // capacity)
        counts = [*counts, (capacity, 1, -1, opened)]
    most, depth, runs = -(-n_docs // n_gaps), 0, []
    for size, kind, part, n in counts:
        slots = 1
        if kind == 0:
            runs.append((size, kind, part, depth, slots))
            depth += n
        elif size >= sizes[0]:
            slots = min(size // sizes[bisect_right(sizes, size) - 1], most)
            runs.append((size, kind, part, depth, slots))
            depth -= slots * n
    return runs, opened


def place(units: DataFrame, capacity: int) -> DataFrame:
    """``key, sequence_id, offset`` of every unit (``key, size`` with sizes below ``capacity``).

    A round range-sorts what is not yet placed together with the gaps, counts
    equal rows per part (at most a run per size, kind and part boundary; this is all the
    driver sees), sweeps over the counts, and matches rows by depth: at one
    depth there is at most one row of each size and kind, so no group is larger than twice
    the capacity. A gap that several documents want goes to the largest, equal
    ones by rank. Gaps are then reduced by what they took; those smaller than
    every document left are closed. The tables of a round are deleted when the
    next round has written its own, placements stay.
    """
    spark = units.sparkSession
    state = units.select(F.lit(0).alias("kind"), F.col("size").cast("int").alias("size"), "key")
    ranked, matched, placements, sequences, number = None, None, [], 0, 0
    while True:
        if ranked is None:
            ranked = Rolling(_ranked(state), "ranked")
        else:
            ranked.step(_ranked(state))
        counts = ranked.df.groupBy("size", "kind", "part").count().collect()
        counts = sorted((r["size"], r["kind"], r["part"], r["count"]) for r in counts)
        if not any(kind == 0 for _, kind, _, _ in counts):
            break
        runs, opened = sweep(counts, capacity)
        smallest = counts[0][0]
        rows = ranked.df.where((F.col("kind") == 0) | (F.col("size") >= smallest))
        if opened:
            new = spark.range(sequences, sequences + opened)
            new = new.select(F.lit(1).alias("kind"), F.lit(capacity).alias("size"), F.col("id").alias("key"), F.lit(-1).alias("part"), (F.col("id") - sequences).alias("rank"))
            rows, sequences = rows.unionByName(new), sequences + opened
        where = F.broadcast(spark.createDataFrame(runs, "size int, kind int, part int, base bigint, slots int"))
        slot = F.explode(F.sequence(F.lit(0), F.col("slots") - 1)).alias("slot")
        spread = rows.join(where, ["size", "kind", "part"]).select("size", "kind", "key", "rank", "base", "slots", slot)
        depth = F.when(F.col("kind") == 0, F.col("base") + F.col("rank") + 1).otherwise(F.col("base") - F.col("rank") * F.col("slots") - F.col("slot"))
        at_depth = Window.partitionBy("depth").orderBy("size", "kind")
        follower = F.lead(F.struct("kind", "key", "slot")).over(at_depth)
        found = spread.withColumn("depth", depth).withColumn("next", follower).where("kind = 0")
        taken = F.col("next.kind") == 1
        number += 1
        matched = keep(found.select("key", "size", F.when(taken, F.col("next.key")).alias("sequence_id"), F.when(taken, F.col("next.slot")).alias("slot")), "matched")
        placed = matched.where(F.col("sequence_id").isNotNull())
        placements.append(placed.withColumn("round", F.lit(number)))
        filled = placed.groupBy(F.col("sequence_id").alias("key")).agg(F.sum("size").cast("int").alias("_taken"))
        gaps = rows.where("kind = 1").join(filled, "key", "left")
        gaps = gaps.select("kind", (F.col("size") - F.coalesce("_taken", F.lit(0))).alias("size"), "key").where(F.col("size") >= smallest)
        state = matched.where(F.col("sequence_id").isNull()).select(F.lit(0).alias("kind"), "size", "key").unionByName(gaps)
    ranked.drop()
    if not placements:
        return spark.createDataFrame([], "key bigint, sequence_id bigint, offset bigint")
    every = placements[0]
    for more in placements[1:]:
        every = every.unionByName(more)
    before = Window.partitionBy("sequence_id").orderBy("round", "slot").rowsBetween(Window.unboundedPreceding, -1)
    return every.select("key", "sequence_id", F.coalesce(F.sum("size").over(before), F.lit(0)).cast("long").alias("offset"))


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """Pieces ``doc_id, piece, start, length, ids, sequence_id, offset`` of all documents.

    ``ids`` holds the piece's token ids as little-endian unsigned 32-bit bytes,
    the closing id 0 of the document included. Only documents of more than
    ``capacity`` tokens are cut; their full pieces are sequences of their own
    (negative ids) and are not moved, all else is placed by best fit.

    A null or empty text is the closing id alone; repeated rows are packed
    each; an empty table gives no pieces; other columns are not looked at.
    """
    pieces = keep(pieces_of(docs, tokenizer, id_col, text_col, capacity), "pieces")
    full, rest = F.col("length") == capacity, F.col("length") < capacity
    placed = place(pieces.where(rest).select(F.col("row").alias("key"), F.col("length").alias("size")), capacity)
    columns = ["doc_id", "piece", "start", "length", "ids", "sequence_id", "offset"]
    alone = pieces.where(full).select("*", (-1 - F.col("row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    beside = pieces.where(rest).join(placed, F.col("row") == F.col("key"))
    return alone.select(*columns).unionByName(beside.select(*columns))
