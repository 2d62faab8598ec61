"""Centroid clustering in exact integers, with dot products kept per vector between rounds."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripaudit.llm.common import Rolling

DIMENSIONS = 64
CLUSTERS = 8
ROUNDS = 10
SCALE = 1024
SEED = "3:"
# Beyond this a squared distance of 64 components need not fit in a long.
LARGEST = 1 << 27
STATE = "vec_id {id}, x array<int>, dots array<bigint>, cluster int, distance bigint"


def integer_vectors(vectors: DataFrame, id_col: str, vector_col: str, dimensions: int, scale: int) -> DataFrame:
    """``vec_id, x`` of the vectors with just ``dimensions`` finite components, in whole steps of 1 / ``scale``."""
    whole = F.col(vector_col)
    fine = F.forall(whole, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    steps = F.transform(whole, lambda v: F.floor(scale * v.cast("double")))
    kept = vectors.where((F.size(whole) == dimensions) & fine).select(F.col(id_col).alias("vec_id"), steps.alias("x"))
    far = F.exists("x", lambda v: F.abs(v) >= LARGEST)
    error = F.raise_error(F.lit(f"a component of {LARGEST // scale} or more: squared distances would not fit in a long"))
    return kept.select("vec_id", F.when(far, error.cast("array<int>")).otherwise(F.col("x").cast("array<int>")).alias("x"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), width)


def move(x: np.ndarray, dots: np.ndarray, old: np.ndarray, new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bring ``dots`` from the old to the new centroids by the components that changed; nearest centroid and distance."""
    for k, step in enumerate(new - old):
        changed = np.flatnonzero(step)
        if len(changed):
            dots[:, k] += x[:, changed] @ step[changed]
    distances = (x * x).sum(1)[:, None] - 2 * dots + (new * new).sum(1)
    nearest = distances.argmin(1)
    return nearest, distances[np.arange(len(x)), nearest]


def _moved(state: DataFrame, old: np.ndarray, new: np.ndarray) -> DataFrame:
    """The state after the centroids went from ``old`` to ``new``."""
    k, dimensions = new.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, steps, before = (batch.column(i) for i in range(3))
            x = _matrix(steps, dimensions).astype(np.int64)
            dots = _matrix(before, k).astype(np.int64)
            nearest, distance = move(x, dots, old, new)
            offsets = pa.array(np.arange(0, k * len(x) + 1, k, dtype=np.int32))
            columns = [ids, steps, pa.ListArray.from_arrays(offsets, pa.array(dots.ravel())), pa.array(nearest.astype(np.int32)), pa.array(distance)]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "x", "dots", "cluster", "distance"])

    kind = state.schema["vec_id"].dataType.simpleString()
    return state.select("vec_id", "x", "dots").mapInArrow(run, STATE.format(id=kind))


def _sums(state: DataFrame, k: int, dimensions: int) -> tuple[np.ndarray, np.ndarray]:
    """Vectors and component sums of each cluster: every task adds up its own, ``k`` times ``dimensions`` rows arrive."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((k, dimensions), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            x, cluster = _matrix(batch.column(0), dimensions), batch.column(1).to_numpy()
            for c in np.unique(cluster):
                own = x[cluster == c]
                total[c] += own.sum(0, dtype=np.int64)
                count[c] += len(own)
        cells = [np.repeat(np.arange(k), dimensions), np.tile(np.arange(dimensions), k), total.ravel(), np.repeat(count, dimensions)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in cells], names=["k", "j", "total", "n"])

    parts = state.select("x", "cluster").mapInArrow(run, "k bigint, j bigint, total bigint, n bigint")
    total, count = np.zeros((k, dimensions), np.int64), np.zeros(k, np.int64)
    for row in parts.groupBy("k", "j").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect():
        total[row.k, row.j], count[row.k] = row.total, row.n
    return total, count


def cluster(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    dimensions: int = DIMENSIONS,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    seed: str = SEED,
) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every vector that is kept.

    Kept are the vectors with ``dimensions`` components, none null or not
    finite; others have no row. The state of a round, the integer vector and
    its dot products with all centroids, is a table in the shared folder, of
    which the one before is deleted. A round updates the dot products by the
    components in which a centroid moved and takes the nearest centroid (ties:
    the smaller number). When no centroid moves, later rounds change nothing
    and are left out.

    Repeated rows count each; a null id is hashed as an empty text, ids that
    are equal go by their components. With fewer vectors than clusters each is
    a centroid of its own, an empty table gives no rows. A component of 131,072
    or more is an error, as distances might not fit in a long; an inertia that
    does not is null. Other columns are not looked at.
    """
    whole = integer_vectors(vectors, id_col, vector_col, dimensions, scale)
    kind = whole.schema["vec_id"].dataType.simpleString()
    state = Rolling(whole.withColumn("dots", F.array_repeat(F.lit(0).cast("long"), clusters)), "vectors")
    order = F.sha2(F.concat(F.lit(seed), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = state.df.orderBy(order, "vec_id", "x").limit(clusters).select("x").collect()
    new = np.array([r.x for r in first], np.int64).reshape(len(first), dimensions)
    if not len(new):
        columns = "cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
        return vectors.sparkSession.createDataFrame([], f"vec_id {kind}, {columns}")
    if len(new) < clusters:
        state.step(state.df.withColumn("dots", F.slice("dots", 1, len(new))))
    old = np.zeros_like(new)
    for _ in range(rounds):
        state.step(_moved(state.df, old, new))
        total, count = _sums(state.df, *new.shape)
        old, new = new, np.where(count[:, None] > 0, total // np.maximum(count, 1)[:, None], new)
        if (old == new).all():
            break
    else:
        state.step(_moved(state.df, old, new))
    sums = state.df.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()
    own = {r.cluster: int(r.s) for r in sums}
    fits = lambda total: total if total < 1 << 63 else None
    inertia = fits(sum(own.values()))
    rows = [
        (k, fits(own.get(k, 0)), inertia, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for k, c in enumerate(new.tolist())
    ]
    schema = "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    facts = F.broadcast(vectors.sparkSession.createDataFrame(rows, schema))  # one row per cluster
    return state.df.select("vec_id", "cluster", "distance").join(facts, "cluster")
