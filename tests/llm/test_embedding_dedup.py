import math

import numpy as np
import pytest

from tripaudit.llm import embedding_dedup
from tripaudit.llm.queries import REGISTRY


def brute(rows):
    """id -> (n_links, component) for unique ids by all cosines."""
    good = [(i, np.array(v, np.float64)) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = {i: (0, i) for i, _ in rows}
    if not good:
        return out
    ids = [i for i, _ in good]
    x = np.stack([v / np.linalg.norm(v) for _, v in good])
    near = (x @ x.T) >= 0.95
    label = np.array(ids)
    while True:
        new = np.array([label[near[k]].min() for k in range(len(ids))])
        if (new == label).all():
            break
        label = new
    return out | {i: (int(near[k].sum()) - 1, int(label[k])) for k, i in enumerate(ids)}


def outcome(frame):
    rows = frame.collect()
    assert all(r.kept == (r.vec_id == r.component_id) for r in rows)
    return {r.vec_id: (r.n_links, r.component_id) for r in rows}


def clusters(seed, sizes, dim=64, noise=0.028):
    rng = np.random.default_rng(seed)
    rows = []
    for size in sizes:
        base = rng.standard_normal(dim)
        base /= np.linalg.norm(base)
        for _ in range(size):
            rows.append((len(rows), (base + noise * rng.standard_normal(dim)).astype(np.float32).tolist()))
    return rows


def frame_of(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<float>, kept string, n_links int")


@pytest.mark.parametrize("noise", [0.012, 0.026])
def test_clusters(spark, noise):
    """With the larger noise cosines lie on both sides of the threshold."""
    rows = clusters(1, [1] * 300 + [2] * 60 + [40, 300], noise=noise)
    want, got = brute(rows), outcome(embedding_dedup.dedup(frame_of(spark, rows)))
    assert set(got) == set(want)
    links, found = sum(n for n, _ in want.values()), sum(n for n, _ in got.values())
    assert all(got[i][0] <= want[i][0] for i in want) and found >= 0.999 * links > 0
    assert sum(got[i][1] == want[i][1] for i in want) >= 0.999 * len(want)


def test_hot_cell_in_blocks(spark, monkeypatch):
    rows = clusters(2, [90, 3, 1, 1, 20])
    monkeypatch.setattr(embedding_dedup, "BLOCK", 16)
    assert outcome(embedding_dedup.dedup(frame_of(spark, rows))) == brute(rows)


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert outcome(REGISTRY["op2_embedding_dedup"](spark, sf)) == brute(rows)


def test_bad_vectors_copies_and_lengths(spark):
    one = [1.0, 2.0, 3.0]
    rows = [(9, one), (4, one), (5, [2.0, 4.0, 6.0]), (6, None), (7, []), (8, [0.0, 0.0, 0.0]), (10, [1.0, None, 3.0])]
    rows += [(11, [math.nan, 1.0, 1.0]), (12, [math.inf, 0.0, 0.0]), (13, [1.0, 2.0]), (14, [-1.0, -2.0, -3.0]), (15, [1e-30, 2e-30, 3e-30])]
    got = outcome(embedding_dedup.dedup(frame_of(spark, rows)))
    want = {i: (0, i) for i, _ in rows} | {i: (3, 4) for i in (4, 5, 9, 15)}
    assert got == want
    repeated = embedding_dedup.dedup(frame_of(spark, [(1, one), (1, one), (None, one)])).collect()
    assert sorted((r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in repeated) == [(0, 2, 1, False), (1, 2, 1, True), (1, 2, 1, True)]
    assert embedding_dedup.dedup(frame_of(spark, [])).collect() == []


def test_calibration():
    """Pairs at the threshold reach the needed count; unrelated pairs do not."""
    rng = np.random.default_rng(6)
    a = rng.standard_normal((4000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    side = rng.standard_normal((4000, 64))
    side -= (side * a).sum(1, keepdims=True) * a
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    b = 0.95 * a + math.sqrt(1 - 0.95**2) * side
    d = embedding_dedup.directions(64, embedding_dedup.PROJECTIONS, 2)
    half, least = embedding_dedup.window(), embedding_dedup.needed_count()
    near = (np.abs((a - b) @ d) <= half).sum(1)
    far = (np.abs((a - side) @ d) <= half).sum(1)
    assert (near >= least).mean() > 0.998 and (far >= least).mean() < 0.001
    counts = embedding_dedup.collisions(a[:50] @ d, b[:60] @ d, half)
    assert counts[7, 33] == (np.abs((a[7] - b[33]) @ d) <= half).sum()
