"""N-gram Jaccard join of whole texts by signature trees.

1. Blocks of documents send the hashes of their shingles, cut to a few bytes,
   to hash ranges, which answer in how many documents each occurs. A document
   of which under 75 % of the shingles occur elsewhere cannot have a link.
2. What is left is reduced to distinct sets. Two linked sets share one of
   their rarest shingles (prefix of the order by frequency), so components of
   "shares a prefix shingle" hold every link: the neighbourhoods.
3. Each neighbourhood becomes a signature tree; the dual traversal finds links
   that connect what all links connect. A neighbourhood too large for a task is first
   compared with one central member; only those it does not link meet all
   others, in pairs of blocks of a bounded size.
"""

from __future__ import annotations

import math
from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripaudit.llm.common import keep, lower_ascii
from tripaudit.llm.components import components
from tripaudit.llm.signature_tree import Join, build, linked

SHARE = 75
SHINGLE = 5
BLOCK_BYTES = 16 << 20
TREE_SHINGLES = 3_000_000  # shingles of the sets that one task joins at most, but for a single larger set

_ODD = [np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63)]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _local_ids(texts: list[str | None]) -> tuple[list[bytes], list[np.ndarray]]:
    """Distinct words in order of appearance, and each text as positions in that list."""
    ids: defaultdict = defaultdict(count().__next__)
    docs = []
    for text in texts:
        words = lower_ascii(text).split()
        docs.append(np.fromiter(map(ids.__getitem__, words), np.int32, len(words)))
    return list(ids), docs


def shingle_sets(texts: list[str | None], size: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text; fewer words than ``size`` are one shingle."""
    words, docs = _local_ids(texts)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    out = []
    for ids in docs:
        own = hashes[ids]
        k = min(size, len(own))
        n = len(own) - k + 1 if k else 0
        total = np.full(n, k, np.uint64)
        for i in range(k):
            total = _mix(total + own[i : i + n] * _ODD[i % len(_ODD)])
        out.append(np.unique(total))
    return out


def hash_bytes(total: int) -> int:
    """Bytes of a hash that keep false sharing under about 1 in 1000 for so many shingles."""
    return min(8, max(4, math.ceil((math.log2(max(2, total)) + 10) / 8)))


def _cut(hashes: np.ndarray, width: int) -> np.ndarray:
    return hashes >> np.uint64(64 - 8 * width) if width < 8 else hashes


def _range_of(hashes: np.ndarray, width: int, ranges: int) -> np.ndarray:
    """Bounds of equal ranges of the hash space in a sorted array."""
    top = 1 << (8 * width)
    return np.searchsorted(hashes, np.array([top * r // ranges for r in range(1, ranges)], np.uint64))


def _pack(values: np.ndarray, width: int) -> bytes:
    """Sorted hashes as gaps, plane by plane: the upper bytes of gaps are mostly zero and compress away."""
    gaps = np.diff(values, prepend=np.uint64(0)).astype("<u8")
    return gaps.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def _unpack(data: bytes, width: int) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(width, -1)
    full = np.zeros((planes.shape[1], 8), np.uint8)
    full[:, :width] = planes.T
    return np.cumsum(full.view("<u8").ravel(), dtype=np.uint64)


def _block_hashes(sets: list[np.ndarray], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct cut hashes of a block, sorted, and in how many of its documents each is."""
    every = np.concatenate([np.unique(_cut(s, width)) for s in sets]) if sets else np.zeros(0, np.uint64)
    return np.unique(every, return_counts=True)


def _send(blocked: DataFrame, width: int, ranges: int) -> DataFrame:
    def run(group: pa.Table) -> pa.Table:
        hashes, counts = _block_hashes(shingle_sets(group["_text"].to_pylist()), width)
        counts = np.minimum(counts, 255).astype(np.uint8)
        bounds = [0, *_range_of(hashes, width, ranges).tolist(), len(hashes)]
        rows = [(r, a, b) for r, (a, b) in enumerate(zip(bounds, bounds[1:])) if b > a]
        block = group["_block"][0].as_py()
        return pa.table(
            {
                "_range": pa.array([r for r, _, _ in rows], pa.int64()),
                "_block": pa.array([block] * len(rows), pa.int64()),
                "hashes": pa.array([_pack(hashes[a:b], width) for _, a, b in rows], pa.binary()),
                "counts": pa.array([counts[a:b].tobytes() for _, a, b in rows], pa.binary()),
            }
        )

    return blocked.groupBy("_block").applyInArrow(run, "_range long, _block long, hashes binary, counts binary")


def _answer(pieces: DataFrame, width: int) -> DataFrame:
    """In how many documents each hash is, 255 at most, in the order in which the block sent them."""

    def run(group: pa.Table) -> pa.Table:
        sent = [_unpack(h, width) for h in group["hashes"].to_pylist()]
        counts = np.frombuffer(b"".join(group["counts"].to_pylist()), np.uint8)
        _, place = np.unique(np.concatenate(sent), return_inverse=True)
        totals = np.minimum(np.bincount(place, weights=counts), 255).astype(np.uint8)[place]
        bounds = np.cumsum([0, *map(len, sent)])
        return pa.table(
            {
                "_block": group["_block"].cast(pa.int64()),
                "_range": group["_range"].cast(pa.int64()),
                "totals": pa.array([totals[a:b].tobytes() for a, b in zip(bounds, bounds[1:])], pa.binary()),
            }
        )

    return pieces.groupBy("_range").applyInArrow(run, "_block long, _range long, totals binary")


def _survivors(blocked: DataFrame, answers: DataFrame, width: int, id_type: T.DataType) -> DataFrame:
    """Every row with its set size; those that may have links with their set, digest and rare shingles."""

    def run(docs: pa.Table, totals: pa.Table) -> pa.Table:
        sets = shingle_sets(docs["_text"].to_pylist())
        hashes, _ = _block_hashes(sets, width)
        known = dict(zip(totals["_range"].to_pylist(), totals["totals"].to_pylist()))
        spread = np.frombuffer(b"".join(known[r] for r in sorted(known)), np.uint8)
        digests, tokens, prefixes, alone = [], [], [], []
        for own in sets:
            n = len(own)
            count = spread[np.searchsorted(hashes, _cut(own, width))] if n else own
            single = int((count < 2).sum())
            if not n or 100 * (n - single) < SHARE * n:
                digests.append(None)
                tokens.append(None)
                prefixes.append(None)
                alone.append(None)
                continue
            raw = own.tobytes()
            length = n - -(-SHARE * n // 100) + 1
            order = np.lexsort((own, count))[:length]
            digests.append(xxhash.xxh3_128_digest(raw))
            tokens.append(raw)
            prefixes.append(own[order[count[order] >= 2]].view(np.int64).tolist())
            alone.append(single / n)
        return pa.table(
            {
                "_id": docs["_id"],
                "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                "digest": pa.array(digests, pa.binary()),
                "tokens": pa.array(tokens, pa.binary()),
                "prefix": pa.array(prefixes, pa.list_(pa.int64())),
                "alone": pa.array(alone, pa.float64()),
            }
        )

    schema = T.StructType(
        [
            T.StructField("_id", id_type),
            T.StructField("n_shingles", T.LongType()),
            T.StructField("digest", T.BinaryType()),
            T.StructField("tokens", T.BinaryType()),
            T.StructField("prefix", T.ArrayType(T.LongType())),
            T.StructField("alone", T.DoubleType()),
        ]
    )
    return blocked.groupBy("_block").cogroup(answers.groupBy("_block")).applyInArrow(run, schema)


def _neighbourhoods(sets: DataFrame) -> DataFrame:
    """``digest, hood``: sets that share a prefix shingle, directly or by others, have one hood."""
    shared = keep(sets.select("digest", F.explode("prefix").alias("token")), "prefixes")
    first = shared.groupBy("token").agg(F.min("digest").alias("b"), F.max("digest").alias("_last"))
    first = first.where(F.col("b") != F.col("_last")).drop("_last")
    edges = shared.join(first, "token").where(F.col("digest") != F.col("b")).select(F.col("digest").alias("a"), "b")
    return components(edges).select(F.col("node").alias("digest"), F.col("component").alias("hood"))


_LINKS = "a binary, b binary"


def _tree_links(group: pa.Table) -> pa.Table:
    """Links of one task: ``side`` 0 is joined with itself, or, where there is a side 1, with that."""
    sets = [np.frombuffer(t, np.uint64) for t in group["tokens"].to_pylist()]
    sides, names = group["side"].to_pylist(), group["digest"].to_pylist()
    join = Join(sets, SHARE)
    trees = [build(sets, [i for i, s in enumerate(sides) if s == k]) for k in (0, 1)]
    if trees[1] is None:
        join.within(trees[0])
    else:
        join.between(*trees)
    return pa.table({k: pa.array([names[link[n]] for link in join.links], pa.binary()) for n, k in enumerate("ab")})


def _star(batches):
    for batch in batches:
        names, centres = batch["digest"].to_pylist(), batch["centre"].to_pylist()
        own, other = batch["tokens"].to_pylist(), batch["centre_tokens"].to_pylist()
        core = [a == b or linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), SHARE) for a, b, x, y in zip(names, centres, own, other)]
        columns = [batch[c] for c in ("hood", "digest", "n", "centre", "tokens")]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(core)], names=["hood", "digest", "n", "centre", "tokens", "core"])


def _links(sets: DataFrame, tree_shingles: int) -> DataFrame:
    """Links ``a, b`` between digests, enough to connect what all links connect."""
    hoods = keep(sets.select("digest", "n").join(_neighbourhoods(sets.select("digest", "prefix")), "digest"), "hoods")
    sizes = hoods.groupBy("hood").agg(F.sum("n").alias("_total"))
    narrow = hoods.select("digest", "hood").join(sizes, "hood")
    sized = sets.drop("prefix").join(narrow, "digest")
    small = sized.where(F.col("_total") <= tree_shingles).select("hood", "digest", "tokens", F.lit(0).alias("side"))
    found = small.groupBy("hood").applyInArrow(_tree_links, _LINKS)
    large = sized.where(F.col("_total") > tree_shingles)
    if large.isEmpty():
        return found
    centre = large.groupBy("hood").agg(F.min_by(F.struct("digest", "tokens"), F.struct("alone", "digest")).alias("c"))
    with_centre = large.join(centre, "hood").select(
        "hood", "digest", "n", F.col("c.digest").alias("centre"), "tokens", F.col("c.tokens").alias("centre_tokens")
    )
    star = with_centre.mapInArrow(_star, "hood binary, digest binary, n long, centre binary, tokens binary, core boolean")
    star = keep(star, "stars")
    to_centre = star.where(F.col("core") & (F.col("digest") != F.col("centre"))).select(F.col("digest").alias("a"), F.col("centre").alias("b"))
    rest = F.when(~F.col("core"), F.col("n")).otherwise(0)
    blocks = star.groupBy("hood").agg(F.sum(rest).alias("_r"), F.sum(F.col("n") - rest).alias("_c"))
    half = tree_shingles // 2
    blocks = blocks.where(F.col("_r") > 0).select(
        "hood", F.ceil(F.col("_r") / half).cast("int").alias("_nr"), F.ceil(F.col("_c") / half).cast("int").alias("_nc")
    )
    # Blocks 0 .. nr-1 hold the rest, nr .. nr+nc-1 the core; a pair (low, high) has a low block of the rest.
    dealt = star.join(blocks, "hood").withColumn(
        "_own",
        F.when(F.col("core"), F.col("_nr") + F.pmod(F.xxhash64("digest"), F.col("_nc"))).otherwise(F.pmod(F.xxhash64("digest"), F.col("_nr"))),
    )
    partners = F.when(F.col("core"), F.sequence(F.lit(0), F.col("_nr") - 1)).otherwise(F.sequence(F.lit(0), F.col("_nr") + F.col("_nc") - 1))
    pairs = dealt.select("hood", "digest", "tokens", F.col("_own").cast("int").alias("_own"), F.explode(partners).alias("_other"))
    pairs = pairs.select(
        "hood", "digest", "tokens", F.least("_own", "_other").alias("_low"), F.greatest("_own", "_other").alias("_high"),
        F.when(F.col("_own") > F.col("_other"), 1).otherwise(0).alias("side"),
    )
    crossed = pairs.groupBy("hood", "_low", "_high").applyInArrow(_tree_links, _LINKS)
    return found.unionAll(to_centre).unionAll(crossed)


def join(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES, tree_shingles: int = TREE_SHINGLES
) -> DataFrame:
    """``id, n_shingles, component_id`` per input row.

    ``component_id`` is the smallest id reachable by links of 100 *
    intersection >= 75 * union. Rows without words have no shingles and link
    with nothing, also not with each other; equal sets link; a row without
    links, or with a null id and no partner with an id, has its own id. Rows
    repeat as they came; an empty table gives an empty result; other columns are not looked at.
    """
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("_text")), F.lit(0)).alias("bytes")).first().bytes
    ranges, width = max(1, -(-size // block_bytes)), hash_bytes(size // 6)
    blocked = rows.withColumn("_block", F.pmod(F.xxhash64("_id", "_text"), F.lit(ranges)))
    answers = _answer(_send(blocked, width, ranges), width)
    marked = keep(_survivors(blocked, answers, width, docs.schema[id_col].dataType), "shingles")
    may = marked.where(F.col("digest").isNotNull())
    first = F.min_by(F.struct("tokens", "prefix", "alone", "n_shingles"), F.struct("n_shingles"))
    sets = may.groupBy("digest").agg(F.min("_id").alias("_least"), first.alias("_s"))
    sets = keep(sets.select("digest", "_least", "_s.tokens", "_s.prefix", "_s.alone", F.col("_s.n_shingles").alias("n")), "sets")
    groups = components(_links(sets.drop("_least"), tree_shingles))
    labelled = sets.select("digest", "_least").join(groups.withColumnRenamed("node", "digest"), "digest", "left")
    labelled = labelled.withColumn("component", F.coalesce("component", "digest"))
    least = labelled.groupBy("component").agg(F.min("_least").alias("_component"))
    of_digest = labelled.select("digest", "component").join(least, "component").select("digest", "_component")
    out = marked.select("_id", "n_shingles", "digest").join(of_digest, "digest", "left")
    return out.select(F.col("_id").alias(id_col), "n_shingles", F.coalesce("_component", "_id").alias("component_id"))
