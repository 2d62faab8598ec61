"""Embedding near-duplicates by counting collisions of one-dimensional projections.

Vectors are dealt into cells by the signs of a few projections, several times
over (tables), so that a pair at the threshold shares a cell of some table
with probability ``RECALL``. Within a cell, many further projections are
sorted; around each vector's value lies a window, and each pair's collisions
are counted. A pair with enough of them is verified by its cosine. The needed
count is the largest that a pair at the threshold reaches with probability
``COUNT_RECALL``. A pair is judged in the first table that it shares a cell of.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripaudit.llm.common import keep
from tripaudit.llm.components import components

COSINE = 0.95
RECALL = 0.9995
COUNT_RECALL = 0.99999
PROJECTIONS = 48
CELL = 128  # vectors of a cell, about, where none are alike
BLOCK = 1024  # a cell with more vectors than twice this is joined in blocks
SEED = 20170329


def plan(n: int, cosine: float = COSINE, recall: float = RECALL) -> tuple[int, int]:
    """Signs per table and number of tables for ``n`` distinct vectors."""
    signs = min(60, max(0, math.ceil(math.log2(max(1, n / CELL)))))
    same = (1 - math.acos(cosine) / math.pi) ** signs
    return signs, 1 if same == 1 else math.ceil(math.log(1 - recall) / math.log(1 - same))


def window(cosine: float = COSINE) -> float:
    """Half width: two standard deviations of the projected difference of a pair at the threshold."""
    return 2 * math.sqrt(2 - 2 * cosine)


def needed_count(projections: int = PROJECTIONS, recall: float = COUNT_RECALL) -> int:
    """Largest count that a pair at the threshold reaches with probability ``recall``."""
    p, total = math.erf(2 / math.sqrt(2)), 0.0
    for count in range(projections, 0, -1):
        total += math.comb(projections, count) * p**count * (1 - p) ** (projections - count)
        if total >= recall:
            return count
    return 0


def directions(dim: int, n: int, salt: int) -> np.ndarray:
    return np.random.default_rng((SEED, dim, salt)).standard_normal((dim, n))


def units(raw: list[bytes], kind: str) -> np.ndarray:
    x = np.frombuffer(b"".join(raw), kind).reshape(len(raw), -1).astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def collisions(own: np.ndarray, others: np.ndarray, half: float) -> np.ndarray:
    """For each pair, in how many projections the other lies in the window around the own value."""
    counts = np.zeros((len(own), len(others)), np.uint8)
    for j in range(own.shape[1]):
        order = np.argsort(others[:, j], kind="stable")
        values = others[order, j]
        low = np.searchsorted(values, own[:, j] - half)
        high = np.searchsorted(values, own[:, j] + half, side="right")
        rank = np.empty(len(others), np.int64)
        rank[order] = np.arange(len(others))
        counts += (rank[None, :] >= low[:, None]) & (rank[None, :] < high[:, None])
    return counts


def _vectors(table: DataFrame, id_col: str, vector_col: str, kind: str) -> DataFrame:
    """Every row with its vector as bytes and a digest; both null where it can have no link."""

    def run(batches):
        for batch in batches:
            raw, digests = [], []
            for values in batch.column(1).to_pylist():
                x = np.array([math.nan if v is None else v for v in values or ()], kind)
                good = len(x) and np.isfinite(x).all() and x.any()
                raw.append(x.tobytes() if good else None)
                digests.append(xxhash.xxh3_128_digest((x + 0).tobytes()) if good else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(raw, pa.binary()), pa.array(digests, pa.binary())], names=["_id", "raw", "digest"])

    id_type = table.schema[id_col].dataType
    schema = T.StructType([T.StructField("_id", id_type), T.StructField("raw", T.BinaryType()), T.StructField("digest", T.BinaryType())])
    return table.select(id_col, vector_col).mapInArrow(run, schema)


def _cells(distinct: DataFrame, signs: int, tables: int, kind: str) -> DataFrame:
    def run(batches):
        for batch in batches:
            raw = batch["raw"].to_pylist()
            cells: list = [None] * len(raw)
            for size in set(map(len, raw)):
                rows = [i for i, r in enumerate(raw) if len(r) == size]
                x = units([raw[i] for i in rows], kind)
                bits = (x @ directions(x.shape[1], max(1, signs * tables), 1) > 0).astype(np.int64)
                bits = bits[:, : signs * tables].reshape(len(rows), tables, signs)
                codes = (bits << np.arange(signs)).sum(axis=2)
                for i, code in zip(rows, codes.tolist()):
                    cells[i] = code
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells, pa.list_(pa.int64()))], names=["digest", "raw", "weight", "cells"])

    return distinct.select("digest", "raw", "weight").mapInArrow(run, "digest binary, raw binary, weight long, cells array<long>")


def _judge(kind: str, cosine: float):
    half, least = window(cosine), needed_count()

    def run(group: pa.Table) -> pa.Table:
        """Summed weights of each vector's links in this task, and links that connect what they all connect."""
        names, weight = group["digest"].to_pylist(), group["weight"].to_numpy()
        side = group["side"].to_numpy()
        within = not side.any()
        first, second = (np.arange(len(side)),) * 2 if within else (np.nonzero(side == 0)[0], np.nonzero(side)[0])
        n_links, parent, links = np.zeros(len(side), np.int64), list(range(len(side))), []

        def find(i):
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        if len(side) > 1 and len(first) and len(second):
            x = units(group["raw"].to_pylist(), kind)
            table = group["table"][0].as_py()
            cells = np.array(group["cells"].to_pylist(), np.int64)[:, :table]
            projected = x @ directions(x.shape[1], PROJECTIONS, 2)
            for at in range(0, len(first), BLOCK):
                own = first[at : at + BLOCK]
                i, j = np.nonzero(collisions(projected[own], projected[second], half) >= least)
                i, j = own[i], second[j]
                if within:
                    i, j = i[i < j], j[i < j]
                for start in range(0, len(i), 1 << 16):
                    a, b = i[start : start + (1 << 16)], j[start : start + (1 << 16)]
                    good = np.einsum("ij,ij->i", x[a], x[b]) >= cosine
                    a, b = a[good], b[good]
                    if table:
                        new = ~(cells[a] == cells[b]).any(axis=1)
                        a, b = a[new], b[new]
                    n_links += np.bincount(a, weights=weight[b], minlength=len(side)).astype(np.int64)
                    n_links += np.bincount(b, weights=weight[a], minlength=len(side)).astype(np.int64)
                    for p, q in zip(a.tolist(), b.tolist()):
                        u, v = find(p), find(q)
                        if u != v:
                            parent[max(u, v)] = min(u, v)
                            links.append((names[p], names[q], 0))
        out = [(names[k], None, int(n_links[k])) for k in np.nonzero(n_links)[0]] + links
        columns = list(zip(*out)) or [(), (), ()]
        return pa.table({"a": pa.array(columns[0], pa.binary()), "b": pa.array(columns[1], pa.binary()), "n": pa.array(columns[2], pa.int64())})

    return run


def _found(distinct: DataFrame, kind: str, cosine: float) -> DataFrame:
    """Rows ``a, null, n``: links of ``a`` by weight, in part; rows ``a, b``: links."""
    signs, tables = plan(distinct.count(), cosine)
    placed = _cells(distinct, signs, tables, kind)
    dealt = placed.select("digest", "raw", "weight", "cells", F.length("raw").alias("size"), F.posexplode("cells").alias("table", "cell"))
    key = ["size", "table", "cell"]
    narrow = placed.select(F.length("raw").alias("size"), F.posexplode("cells").alias("table", "cell"))
    large = narrow.groupBy(*key).count().where(F.col("count") > 2 * BLOCK)
    large = large.select(*key, F.ceil(F.col("count") / BLOCK).cast("int").alias("_blocks"))
    dealt = dealt.join(large, key, "left").withColumn("_blocks", F.coalesce("_blocks", F.lit(1)))
    dealt = dealt.withColumn("_own", F.pmod(F.xxhash64("digest"), F.col("_blocks")).cast("int"))
    pairs = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    pairs = pairs.select(
        *key, "digest", "raw", "weight", "cells", F.least("_own", "_other").alias("_low"), F.greatest("_own", "_other").alias("_high"),
        F.when(F.col("_own") > F.col("_other"), 1).otherwise(0).alias("side"),
    )
    return pairs.groupBy(*key, "_low", "_high").applyInArrow(_judge(kind, cosine), "a binary, b binary, n long")


def dedup(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = COSINE) -> DataFrame:
    """``id, n_links, component_id, kept`` of every row.

    Null and zero vectors, and those with null or non-finite parts, link with
    nothing; vectors of different lengths do not link. Equal vectors are one
    vector with a weight, so copies are never paired. A repeated row is another vector.
    A row without links is its own component; a null id counts last in a
    component and is kept only where it stands alone. An empty table gives an
    empty result; other columns are not looked at.
    """
    kind = "<f4" if isinstance(table.schema[vector_col].dataType.elementType, T.FloatType) else "<f8"
    rows = keep(_vectors(table, id_col, vector_col, kind), "vectors")
    distinct = rows.where(F.col("digest").isNotNull()).groupBy("digest")
    distinct = keep(distinct.agg(F.first("raw").alias("raw"), F.count("*").alias("weight"), F.min("_id").alias("_least")), "distinct")
    found = keep(_found(distinct, kind, cosine), "links")
    counts = found.where(F.col("b").isNull()).groupBy("a").agg(F.sum("n").alias("_n")).withColumnRenamed("a", "digest")
    groups = components(found.where(F.col("b").isNotNull())).withColumnRenamed("node", "digest")
    known = distinct.drop("raw").join(counts, "digest", "left").join(groups, "digest", "left")
    known = known.select("digest", "_least", F.coalesce("component", "digest").alias("component"), (F.coalesce("_n", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    least = known.groupBy("component").agg(F.min("_least").alias("_component"))
    known = known.join(least, "component").select("digest", "n_links", "_component")
    out = rows.select("_id", "digest").join(known, "digest", "left")
    component = F.coalesce("_component", "_id")
    alone = F.coalesce("n_links", F.lit(0).cast("long"))
    return out.select(
        F.col("_id").alias(id_col), alone.alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("_id") == component, alone == 0).alias("kept"),
    )
