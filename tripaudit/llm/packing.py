"""Cost-balanced packing of tokenised documents into sequences of fixed capacity."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache
from heapq import heappop, heappush
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tripaudit.llm.unit_cache import BYTES_AT_ONCE, LETTERS, SIGNS, UnitCache, text_slices

CAPACITY = 1024
# Cost of a piece of n tokens: LINEAR * n for projections, QUADRATIC * n * n for attention.
LINEAR, QUADRATIC = 1.0, 1.0 / CAPACITY
GROUP_TOKENS = 2_000_000
END = b"\0\0\0\0"
INNER_SPACE = re.compile(r"(?<=\S) (?=\S)")


class Units(UnitCache):
    """Token ids of texts as little-endian unsigned 32-bit bytes, by way of a cache of space-led units.

    A single space between two visible characters always starts a new token of
    the byte-level pattern, so the ids of a text are those of its parts cut
    before such spaces. Letters with the space ahead of them are one word to
    the tokenizer, and so is a run of signs behind a letter or digit.
    """

    def __init__(self, path: str):
        super().__init__(path, led=True)

    def encode_units(self, units: list[str]) -> list[bytes]:
        """Ids of each unit with a space ahead of it; none for one that begins or ends with white space."""
        bare = [u.rstrip(SIGNS) for u in units]
        bare = [b if b[-1:].isalnum() else u for b, u in zip(bare, units)]
        signs = [u[len(b) :] for b, u in zip(bare, units)]
        distinct = {b for b in bare if b and b == b.strip()}
        words = list(filter(LETTERS.fullmatch, distinct))
        ids = dict(zip(words, self.encode_words([" " + w for w in words])))
        rest = list(distinct.difference(words))
        ids.update(zip(rest, self.encode([" " + u for u in rest])))
        ends = list(set(signs))
        tails = dict(zip(ends, self.encode(ends)))
        return [ids[b] + tails[s] if b in ids else b"" for b, s in zip(bare, signs)]

    def ids(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text, the closing id 0 included."""
        cut = pc.split_pattern(pc.fill_null(texts, ""), " ")
        parts, offsets = cut.flatten(), cut.offsets.to_numpy()
        led = np.ones(len(parts), bool)
        led[offsets[:-1]] = False
        ids, n = self.gather(parts.filter(pa.array(led)))
        ends = offsets[1:] - np.arange(1, len(offsets))  # units before the end of each text
        odd = np.diff(np.concatenate(([0], np.cumsum(n == 0)))[ends], prepend=0) > 0
        stops = (4 * np.concatenate(([0], np.cumsum(n)))[ends]).tolist()
        several = (np.diff(ends, prepend=0) > 0).tolist()
        heads = parts.take(pa.array(offsets[:-1])).to_pylist()
        data, at, out = memoryview(ids.tobytes()), 0, []
        for row, (first, head, stop) in enumerate(zip(heads, self.encode(heads), stops)):
            if odd[row] or first[-1:].isspace() or (several[row] and not first):
                # White space runs: cut only where both neighbours are visible.
                whole = INNER_SPACE.split(texts[row].as_py())
                own = self.encode([(" " if k else "") + u for k, u in enumerate(whole)])
                out.append(b"".join((*own, END)))
            else:
                out.append(b"".join((head, data[at:stop], END)))
            at = stop
        return out


@lru_cache(maxsize=1)
def units(path: str) -> Units:
    return Units(path)


def encoded(keys: list, texts: pa.Array, encode, most: int = BYTES_AT_ONCE) -> Iterator[tuple[list, list[bytes]]]:
    """Keys and ids of a batch, about ``most`` bytes of text at a time."""
    for at, n in text_slices(texts, most):
        yield keys[at : at + n], encode(texts.slice(at, n))


def cost(length, linear: float = LINEAR, quadratic: float = QUADRATIC):
    return linear * length + quadratic * length * length


def balance(lengths: Sequence[int], capacity: int = CAPACITY, linear: float = LINEAR, quadratic: float = QUADRATIC):
    """Place items of at most ``capacity`` tokens; returns ``(item, start, length, sequence, offset)`` rows.

    Items go in descending length (ties by position) to the cheapest sequence
    whose remaining capacity holds them whole; where none does, to the cheapest
    with any room, and what is left over goes on from there. There are just as
    many sequences as the tokens need, so less than one sequence is padding.
    """
    n_sequences = -(-sum(lengths) // capacity)
    heaps: list[list] = [[] for _ in range(capacity + 1)]  # by remaining capacity
    best = np.full(capacity + 1, np.inf)
    heaps[capacity] = [(0.0, s) for s in range(n_sequences)]
    if n_sequences:
        best[capacity] = 0.0
    out = []
    for item in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        left, start = lengths[item], 0
        while left:
            room = left + int(best[left:].argmin())
            if best[room] == np.inf:
                room = 1 + int(best[1:].argmin())
            spent, sequence = heappop(heaps[room])
            best[room] = heaps[room][0][0] if heaps[room] else np.inf
            take = min(left, room)
            out.append((item, start, take, sequence, capacity - room))
            if room > take:
                heappush(heaps[room - take], (spent + cost(take, linear, quadratic), sequence))
                best[room - take] = heaps[room - take][0][0]
            left, start = left - take, start + take
    return out, n_sequences


def _pack_group(keys: list, ids: list[bytes], capacity: int, linear: float, quadratic: float, first: int):
    """Pieces of a group of documents; full runs of ``capacity`` stand alone, the rests are balanced."""
    rows, sequence, rests = [], first, []
    for key, own in zip(keys, ids):
        n = len(own) // 4
        full = n - n % capacity
        for start in range(0, full, capacity):
            rows.append((key, start, capacity, own[4 * start : 4 * (start + capacity)], n, sequence, 0))
            sequence += 1
        if n > full:
            rests.append((key, full, own, n))
    placed, used = balance([n - full for _, full, _, n in rests], capacity, linear, quadratic)
    for item, start, length, at, offset in placed:
        key, full, own, n = rests[item]
        start += full
        rows.append((key, start, length, own[4 * start : 4 * (start + length)], n, sequence + at, offset))
    return rows, sequence + used


def pack(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    linear: float = LINEAR,
    quadratic: float = QUADRATIC,
    group_tokens: int = GROUP_TOKENS,
    text_bytes: int = BYTES_AT_ONCE,
) -> DataFrame:
    """Pieces ``doc_id, start, length, ids, doc_tokens, sequence_id, offset`` of all documents.

    ``ids`` holds the piece's token ids as little-endian unsigned 32-bit bytes.
    Each task packs what it reads in groups of about ``group_tokens`` tokens: no
    shuffle, bounded memory, and less than one sequence of padding per group.
    The units of about ``text_bytes`` of text are looked up at once: less takes
    less memory and more time, and gives the same ids.
    ``sequence_id`` is the task's number times 2^32 plus a running number, the
    same when a lost task runs again on the same input.

    A null or empty text is the closing id alone; repeated rows are packed
    each; an empty table gives no pieces; other columns are not looked at.
    """
    kind = docs.schema[id_col].dataType
    schema = T.StructType(
        [
            T.StructField("doc_id", kind),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids", T.BinaryType()),
            T.StructField("doc_tokens", T.LongType()),
            T.StructField("sequence_id", T.LongType()),
            T.StructField("offset", T.LongType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = units(tokenizer).ids
        sequence = TaskContext.get().partitionId() << 32
        keys, ids, held, names = [], [], 0, None

        def flush():
            nonlocal keys, ids, held, sequence
            rows, sequence = _pack_group(keys, ids, capacity, linear, quadratic, sequence)
            keys, ids, held = [], [], 0
            for at in range(0, len(rows), 4096):
                columns = list(zip(*rows[at : at + 4096]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], names), *(pa.array(c, pa.binary() if k == 2 else pa.int64()) for k, c in enumerate(columns[1:]))],
                    names=[f.name for f in schema],
                )

        for batch in batches:
            names = batch.schema.field(0).type
            for own, found in encoded(batch.column(0).to_pylist(), batch.column(1), encode, text_bytes):
                keys += own
                ids += found
                held += sum(map(len, found)) // 4
                if held >= group_tokens:
                    yield from flush()
        if keys:
            yield from flush()

    return docs.select(id_col, text_col).mapInArrow(run, schema)
