"""Document log-likelihoods by a gated recurrent language model trained and applied with Spark.

1. Documents are dealt into blocks of about ``BLOCK_BYTES`` of text by a hash
   of their id. Each block numbers its words and keeps its documents as
   numbers: texts are cut into words once. It sends its distinct words, with
   their training counts, to hashed buckets; each bucket adds up and answers
   each block with the totals. What moves is packed: one row per block and
   bucket.
2. Each block meets its word totals again: base scores are summed, and
   documents are kept as the model's ids, two bytes a token. The most frequent
   words are the model's head.
3. A warm start on a bounded sample is followed by a round in which every task
   trains on all of its own training documents; the weights are averaged,
   weighted by tokens.
4. All documents are scored whole, in batches.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripaudit.llm import gru
from tripaudit.llm.common import keep

BLOCK_BYTES = 16 << 20
WARM_DOCS = 3000  # documents of the warm start, about; bounds what one task trains on alone
WARM_EPOCHS = 2
WARM_BATCH = 128
BATCH = 512  # documents whose windows give one update together in the main round
SMOOTH = 0.1


def _local_ids(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words (binary) in order of appearance, all texts' words as positions in them, and how many words each text has."""
    cut = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    coded = cut.flatten().dictionary_encode()
    words, ids = coded.dictionary.cast(pa.binary()), coded.indices.to_numpy(zero_copy_only=False)
    counts = pc.list_value_length(cut).to_numpy(zero_copy_only=False).astype(np.int64)
    blank = pc.index(words, pa.scalar(b"", pa.binary())).as_py()
    if blank >= 0:  # white space at the ends of a text
        real = ids != blank
        counts = np.bincount(np.repeat(np.arange(len(counts)), counts)[real], minlength=len(counts))
        ids = ids[real]
        ids = ids - (ids > blank)
        words = words.filter(pa.array(np.arange(len(words)) != blank))
    return words, ids, counts


def _bytes_of(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of words end to end, and where each starts and ends in them."""
    _, offsets, data = words.buffers()
    offsets = np.frombuffer(offsets, np.int32)[words.offset : words.offset + len(words) + 1] if len(words) else np.zeros(1, np.int32)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.zeros(0, np.uint8), offsets - offsets[0]


def _by_bucket(words: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order of words by bucket, else as they stand; the buckets met, and where each starts and ends in that order."""
    text, offsets = _bytes_of(words)
    raw, bounds = memoryview(text.tobytes()), offsets.tolist()
    bucket = np.fromiter((zlib.crc32(raw[a:b]) % buckets for a, b in zip(bounds, bounds[1:])), np.int64, len(words))
    order = np.argsort(bucket, kind="stable")
    met, starts = np.unique(bucket[order], return_index=True)
    return order, met, np.append(starts, len(words))


def _model_ids(words: pa.Array, head: dict[bytes, int]) -> np.ndarray:
    at = pc.fill_null(pc.index_in(words, value_set=pa.array(list(head), pa.binary())), -1).to_numpy(zero_copy_only=False)
    numbers = np.array([*head.values(), 0], np.int32)
    return np.where(at >= 0, numbers[at], gru.HEAD + gru.tail_classes(*_bytes_of(words))).astype(np.int32)


def _closed(ids: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Each text's model ids with the end of a text, as binary rows of 16-bit numbers."""
    ends = np.cumsum(counts + 1)
    out = np.zeros(len(ids) + len(counts), "<i2")
    inside = np.ones(len(out), bool)
    inside[ends - 1] = False
    out[inside] = ids
    return _rows_of(out, counts + 1)


def _rows_of(numbers: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Binary rows that hold so many numbers each."""
    offsets = np.concatenate(([0], np.cumsum(counts))) * numbers.itemsize
    raw = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(numbers)])
    return raw.cast(pa.binary())


def _numbers_of(rows: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of binary rows, one row after the other, and how many each row has."""
    text, offsets = _bytes_of(rows.cast(pa.binary()))
    return np.frombuffer(text.tobytes(), kind), np.diff(offsets) // np.dtype(kind).itemsize


def _one(column: pa.ChunkedArray) -> pa.Array:
    found = column.combine_chunks()
    return pa.concat_arrays(found.chunks) if isinstance(found, pa.ChunkedArray) else found


def _block_words(blocked: DataFrame, buckets: int) -> DataFrame:
    """Per document (bucket null) its words as numbers; per block and bucket the distinct words, in the numbers' order, and their counts in training documents."""
    id_type = blocked.schema["_id"].dataType

    def run(group: pa.Table) -> pa.Table:
        words, ids, sizes = _local_ids(_one(group["_text"]))
        learnt = ~group["held_out"].to_numpy(zero_copy_only=False)
        train = np.bincount(ids[np.repeat(learnt, sizes)], minlength=len(words)).astype("<i8")
        order, met, bounds = _by_bucket(words, buckets)
        train, number = train[order], np.empty(len(words), "<i4")
        number[order] = np.arange(len(words))
        lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), words.take(pa.array(order)))
        docs, n = len(group), len(met)
        blank = lambda kind, rows: pa.nulls(rows, kind)
        both = {
            "_block": (pa.array([group["_block"][0].as_py()] * docs, pa.int64()), pa.array([group["_block"][0].as_py()] * n, pa.int64())),
            "_bucket": (blank(pa.int64(), docs), pa.array(met, pa.int64())),
            "_id": (_one(group["_id"]), blank(group["_id"].type, n)),
            "held_out": (_one(group["held_out"]), blank(pa.bool_(), n)),
            "ids": (_rows_of(number[ids], sizes), blank(pa.binary(), n)),
            "words": (blank(pa.binary(), docs), pc.binary_join(lists, b" ")),
            "counts": (blank(pa.binary(), docs), pa.array([train[a:b].tobytes() for a, b in zip(bounds, bounds[1:])], pa.binary())),
        }
        return pa.table({k: pa.chunked_array(list(v)) for k, v in both.items()})

    schema = T.StructType(
        [
            *(T.StructField(n, T.LongType()) for n in ("_block", "_bucket")),
            T.StructField("_id", id_type),
            T.StructField("held_out", T.BooleanType()),
            *(T.StructField(n, T.BinaryType()) for n in ("ids", "words", "counts")),
        ]
    )
    return blocked.groupBy("_block").applyInArrow(run, schema)


def _bucket_totals(pieces: DataFrame) -> DataFrame:
    """Per block and bucket the words' training totals; per bucket (block null) its sums and most frequent words."""

    def run(group: pa.Table) -> pa.Table:
        lists = pc.split_pattern(group["words"].combine_chunks(), b" ")  # in Arrow: only the most frequent words become objects
        coded = lists.flatten().dictionary_encode()
        index = coded.indices.to_numpy(zero_copy_only=False)
        words = coded.dictionary
        counts = np.frombuffer(b"".join(group["counts"].to_pylist()), "<i8")
        # Counts add up exactly in doubles below 2^53.
        totals = np.bincount(index, weights=counts, minlength=len(words)).astype("<i8")
        answers = totals[index]
        bounds = np.cumsum([0, *pc.list_value_length(lists).to_pylist()])
        kinds = gru.tail_classes(*_bytes_of(words))
        seen = totals > 0
        tail = np.stack([np.bincount(kinds, weights=totals, minlength=gru.TAIL_CLASSES), np.bincount(kinds, weights=seen, minlength=gru.TAIL_CLASSES)])
        top = [i for i in np.argsort(-totals, kind="stable")[: gru.HEAD].tolist() if totals[i] > 0]
        bucket = group["_bucket"][0].as_py()
        n = len(lists)
        return pa.table(
            {
                "_bucket": pa.array([bucket] * (n + 1), pa.int64()),
                "_block": pa.array([*group["_block"].to_pylist(), None], pa.int64()),
                "counts": pa.array([*(answers[a:b].tobytes() for a, b in zip(bounds, bounds[1:])), tail.astype("<i8").tobytes()], pa.binary()),
                "top_words": pa.array([*[None] * n, words.take(pa.array(top, pa.int64())).to_pylist()], pa.list_(pa.binary())),
                "top_counts": pa.array([*[None] * n, totals[top].tolist()], pa.list_(pa.int64())),
            }
        )

    schema = "_bucket long, _block long, counts binary, top_words array<binary>, top_counts array<long>"
    return pieces.groupBy("_bucket").applyInArrow(run, schema)


class Vocabulary:
    """Bounded summary of the counts: head words, tail sums, corpus sums."""

    def __init__(self, totals: DataFrame, end_count: int):
        sums = totals.where(F.col("_block").isNull())
        kinds = F.posexplode("parts")
        # Sums of tail classes are added in Spark; each bucket's are 2 * TAIL_CLASSES numbers.
        numbers = sums.select(F.transform(F.sequence(F.lit(0), F.lit(2 * gru.TAIL_CLASSES - 1)), _le_long("counts")).alias("parts"))
        added = {r["pos"]: r["n"] for r in numbers.select(kinds).groupBy("pos").agg(F.sum("col").alias("n")).collect()}
        tail = np.array([added.get(i, 0) for i in range(2 * gru.TAIL_CLASSES)], np.int64).reshape(2, -1)
        top = sums.select(F.explode(F.arrays_zip("top_words", "top_counts")).alias("w")).select("w.top_words", "w.top_counts")
        top = top.orderBy(F.desc("top_counts"), "top_words").limit(gru.HEAD - 1).collect()
        self.tokens = int(tail[0].sum()) + end_count
        self.distinct = int(tail[1].sum()) + (end_count > 0)
        self.end_count = end_count
        self.head = {bytes(r.top_words): i + 1 for i, r in enumerate(top)}  # 0 is the end of a text
        self.head_counts = np.array([end_count, *[r.top_counts for r in top]], np.int64)
        for word, n in zip(self.head, self.head_counts[1:]):
            tail[:, gru.tail_class(word)] -= (n, 1)
        self.tail_counts, self.tail_words = tail
        self.tail_norm = np.log10(self.tail_counts + SMOOTH * (self.tail_words + 1))
        self.base_norm = math.log10(self.tokens + SMOOTH * (self.distinct + 1))


def _le_long(column: str):
    """Native decoding of the i-th little-endian 64-bit number of a binary column."""
    # Counts are below 2^63; the bytes are reversed pairwise in hexadecimal.
    def at(i: Column) -> Column:
        text = F.hex(F.substring(F.col(column), i * 8 + 1, F.lit(8)))
        reversed_pairs = F.concat(*[F.substring(text, 15 - 2 * k, 2) for k in range(8)])
        return F.conv(reversed_pairs, 16, 10).cast("long")

    return at


def _portions(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.Array]:
    """The first column of all batches in arrays that end with the row by which they hold ``size`` bytes."""
    held, room = [], size
    for batch in batches:
        rows = batch.column(0)
        ends = np.cumsum(pc.fill_null(pc.binary_length(rows), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at, before = 0, 0
        while at < len(rows):
            to = min(int(np.searchsorted(ends, before + room)) + 1, len(rows))
            held.append(rows.slice(at, to - at))
            room -= int(ends[to - 1]) - before
            at, before = to, int(ends[to - 1])
            if room <= 0:
                yield pa.concat_arrays(held)
                held, room = [], size
    if held:
        yield pa.concat_arrays(held)


def _documents(rows: pa.Array) -> list[np.ndarray]:
    """Model ids of each document."""
    ids, counts = _numbers_of(rows, "<i2")
    return np.split(ids.astype(np.int32), np.cumsum(counts)[:-1]) if len(counts) else []


def _train(docs: DataFrame, start: np.ndarray, batch_docs: int, epochs: int, rate: float) -> DataFrame:
    """Each task trains from ``start`` on its rows of ``_model_ids``: one row ``(tokens, weights)`` per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer = gru.Trainer(gru.unflatten(start), rate)
        for rows in _portions(batches, BLOCK_BYTES // 3):  # two bytes a token, of about six of text
            ready = _documents(rows)
            for _ in range(epochs):
                trainer.learn(ready, batch_docs)
        if trainer.tokens:
            flat = trainer.flat.astype(np.float64)
            yield pa.record_batch({"tokens": pa.array([trainer.tokens], pa.int64()), "weights": pa.array([flat.tolist()], pa.list_(pa.float64()))})

    return docs.select("_model_ids").mapInArrow(run, "tokens long, weights array<double>")


def _with_model_ids(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``_id`` and ``_model_ids`` of texts, without a table of word totals."""
    head = vocabulary.head

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, ids, counts = _local_ids(batch["_text"])
            yield pa.RecordBatch.from_arrays([batch["_id"], _closed(_model_ids(words, head)[ids], counts)], names=["_id", "_model_ids"])

    schema = T.StructType([docs.schema["_id"], T.StructField("_model_ids", T.BinaryType())])
    return docs.select("_id", "_text").mapInArrow(run, schema)


def _average(models: DataFrame, fallback: np.ndarray) -> np.ndarray:
    """Token-weighted mean of the tasks' weights: as many numbers as the model has."""
    n = F.col("tokens").cast("double")
    parts = models.select(n.alias("n"), F.posexplode("weights")).groupBy("pos").agg((F.sum(F.col("n") * F.col("col")) / F.sum("n")).alias("w"))
    rows = parts.toPandas()
    if rows.empty:
        return fallback
    out = np.zeros(len(fallback), np.float32)
    out[rows["pos"].to_numpy()] = rows["w"].to_numpy()
    return out


def train_model(docs: DataFrame, vocabulary: Vocabulary, n_train: int) -> np.ndarray:
    """Flat weights of the model, trained on the rows of ``docs`` (``_id``, and ``_text`` or ``_model_ids``)."""
    if "_model_ids" not in docs.columns:
        docs = _with_model_ids(docs, vocabulary)
    start = gru.flatten(gru.initial(vocabulary.head_counts, vocabulary.tail_counts))
    share = max(1, n_train // WARM_DOCS)
    warm = docs.where(F.pmod(F.xxhash64("_id", F.lit(1)), F.lit(share)) == 0).repartition(1)
    start = _average(_train(warm, start, WARM_BATCH, WARM_EPOCHS, 0.01), start)
    return _average(_train(docs, start, BATCH, 1, 0.003), start)


def _with_totals(docs: DataFrame, words: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Base scores of documents, their model ids, and ``_rest``: what the words' shares of their classes add to the score.

    ``docs`` has the numbers of ``_block_words``; ``words`` has rows with
    ``words`` and rows with their total ``counts``, per block and bucket.
    """
    v, id_type = vocabulary, docs.schema["_id"].dataType

    def run(docs: pa.Table, words: pa.Table) -> pa.Table:
        words = words.sort_by("_bucket")
        c = np.frombuffer(b"".join(words["counts"].drop_null().to_pylist()), "<i8")
        own = pc.split_pattern(_one(words["words"].drop_null()), b" ").flatten()
        ids, sizes = _numbers_of(_one(docs["ids"]), "<i4")
        model = _model_ids(own, v.head)
        tail = model >= gru.HEAD
        logs = np.log10(c + SMOOTH)
        rest = np.where(tail, logs - v.tail_norm[np.where(tail, model - gru.HEAD, 0)], 0.0)
        end = math.log10(v.end_count + SMOOTH) - v.base_norm
        document = np.repeat(np.arange(len(sizes)), sizes)
        added = lambda values: np.bincount(document, weights=values[ids], minlength=len(sizes)).astype(np.float64)
        return pa.table(
            {
                "_id": docs["_id"],
                "held_out": docs["held_out"],
                "n_tokens": pa.array(sizes + 1, pa.int64()),
                "n_known": pa.array(added(c > 0).astype(np.int64) + (v.end_count > 0), pa.int64()),
                "base_score": pa.array(added(logs - v.base_norm) + end),
                "_rest": pa.array(added(rest)),
                "_model_ids": _closed(model[ids], sizes),
            }
        )

    schema = T.StructType(
        [
            T.StructField("_id", id_type),
            T.StructField("held_out", T.BooleanType()),
            *(T.StructField(n, T.LongType()) for n in ("n_tokens", "n_known")),
            *(T.StructField(n, T.DoubleType()) for n in ("base_score", "_rest")),
            T.StructField("_model_ids", T.BinaryType()),
        ]
    )
    return docs.groupBy("_block").cogroup(words.groupBy("_block")).applyInArrow(run, schema)


def _likelihoods(ready: DataFrame, weights: np.ndarray, tokens: int) -> DataFrame:
    """The scored rows of ``_with_totals``, a batch of documents of bounded size at a time."""
    kept = ["_id", "held_out", "n_tokens", "n_known", "base_score"]
    schema = T.StructType([*(ready.schema[n] for n in kept), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = gru.unflatten(weights)
        for batch in batches:
            parts = [gru.log_likelihoods(p, _documents(rows)) for rows in _portions(iter([batch.select(["_model_ids"])]), BLOCK_BYTES // 3)]
            found = np.concatenate([*parts, np.zeros(0)]) / math.log(10) + batch["_rest"].to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([*(batch[n] for n in kept), pa.array(found, pa.float64())], names=[*kept, "score"])

    scored = ready.mapInArrow(run, schema)
    return scored.select("_id", "held_out", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score")


def score(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row.

    The model learns from the rows where ``held_out`` is false and scores all
    rows whole. A null or empty text is the closing token alone; rows of one
    id, or equal rows, are scored each; an empty table gives an empty result;
    without training rows every word is unknown and the model is its uniform
    start; other columns are not looked at. Gradients and counts come from all
    tokens of the training documents.
    """
    rows = docs.select(
        F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), F.coalesce(held_out, F.lit(True)).alias("held_out")
    )
    size = rows.agg(
        F.coalesce(F.sum(F.octet_length("_text")), F.lit(0)).alias("bytes"), F.sum(F.when(F.col("held_out"), 0).otherwise(1)).alias("train")
    ).first()
    buckets = max(1, -(-size.bytes // block_bytes))
    n_train = size.train or 0
    blocked = rows.withColumn("_block", F.pmod(F.xxhash64("_id", "_text"), F.lit(buckets)))
    coded = keep(_block_words(blocked, buckets), "lm-blocks")
    pieces = coded.where(F.col("_bucket").isNotNull())
    totals = keep(_bucket_totals(pieces.select("_bucket", "_block", "words", "counts")), "lm-words")
    vocabulary = Vocabulary(totals, n_train)
    answers = totals.where(F.col("_block").isNotNull()).select("_block", "_bucket", F.lit(None).cast("binary").alias("words"), "counts")
    words = pieces.select("_block", "_bucket", "words", F.lit(None).cast("binary").alias("counts")).unionAll(answers)
    numbered = coded.where(F.col("_bucket").isNull()).select("_block", "_id", "held_out", "ids")
    ready = keep(_with_totals(numbered, words, vocabulary), "lm-documents")
    weights = train_model(ready.where(~F.col("held_out")), vocabulary, n_train)
    return _likelihoods(ready, weights, vocabulary.tokens).withColumnRenamed("_id", id_col)
