import hashlib
import random

import numpy as np
import pytest

from tripaudit.llm import centroids

SCHEMA = "vec_id long, embedding array<float>, x string, cluster int"


def brute_force(rows, k=8, rounds=10, size=64, seed="3:"):
    """Plain integer Lloyd rounds with every distance computed anew."""
    kept = [(i, [int(np.floor(1024 * float(v))) for v in e]) for i, e in rows if e is not None and len(e) == size and all(v is not None and np.isfinite(v) for v in e)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[0] or 0, r[1]))
    centers = [x for _, x in order[:k]]

    def assign():
        out = []
        for _, x in kept:
            d = [sum((a - b) ** 2 for a, b in zip(x, c)) for c in centers]
            out.append((d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        groups = [[x for (_, x), (c, _) in zip(kept, assigned) if c == n] for assigned in [assign()] for n in range(len(centers))]
        centers = [[sum(col) // len(g) for col in zip(*g)] if g else c for g, c in zip(groups, centers)]
    final = assign()
    total = sum(d for _, d in final)
    own = {n: sum(d for c, d in final if c == n) for n in range(len(centers))}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centers]
    return sorted((-1 if i is None else i, c, d, own[c], total, digest[c]) for (i, _), (c, d) in zip(kept, final))


def collected(frame):
    return sorted((-1 if r.vec_id is None else r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in frame.collect())


def vectors(n, seed=1):
    rng = random.Random(seed)
    centers = [[rng.uniform(-1, 1) for _ in range(64)] for _ in range(12)]
    return [(i, [float(np.float32(v + rng.gauss(0, 0.2))) for v in rng.choice(centers)]) for i in range(n)]


@pytest.mark.parametrize("repeats", [0, 200])
def test_against_brute_force(spark, repeats):
    rows = vectors(300)
    rows += [(5000 + i, rows[7][1]) for i in range(repeats)]
    rows += [(900, None), (901, []), (902, [1.0] * 63), (903, [1.0] * 65), (904, [1.0] * 63 + [None]), (905, [float("nan")] + [0.0] * 63),
             (906, [float("-inf")] + [0.0] * 63), (907, [0.0] * 64), (None, rows[3][1]), (11, rows[11][1]), (12, rows[40][1])]
    frame = spark.createDataFrame([(*r, "x", 3) for r in rows], SCHEMA).repartition(5)
    assert collected(centroids.cluster(frame)) == brute_force(rows)


def test_few_and_equal_vectors(spark):
    one = vectors(3)
    assert collected(centroids.cluster(spark.createDataFrame([(*r, "x", 0) for r in one], SCHEMA))) == brute_force(one)
    same = [(i, one[0][1]) for i in range(20)]
    got = collected(centroids.cluster(spark.createDataFrame([(*r, "x", 0) for r in same], SCHEMA)))
    assert got == brute_force(same) and {r[1] for r in got} == {0}
    assert centroids.cluster(spark.createDataFrame([], SCHEMA)).collect() == []


def test_far_components_are_an_error(spark):
    far = spark.createDataFrame([(1, [2e5] + [0.0] * 63, "x", 0)], SCHEMA)
    with pytest.raises(Exception, match="squared distances"):
        centroids.cluster(far)


def test_dots_move_by_changed_components_only():
    rng = np.random.default_rng(2)
    x, old = rng.integers(-2000, 2000, (50, 64)), rng.integers(-2000, 2000, (8, 64))
    new = old.copy()
    new[2, [3, 60]] += 5
    new[7] -= 1
    dots = x @ old.T
    nearest, distance = centroids.move(x, dots, old, new)
    full = ((x[:, None, :] - new) ** 2).sum(2)
    assert (dots == x @ new.T).all() and (nearest == full.argmin(1)).all() and (distance == full.min(1)).all()


def test_only_the_last_state_is_left(spark, tmp_path):
    before = spark.conf.get("spark.checkpoint.dir")
    from pathlib import Path

    from tripaudit.session import scratch_dir

    root = Path(scratch_dir(spark, "x").removeprefix("file:")).parent
    had = set(root.glob("vectors-*"))
    centroids.cluster(spark.createDataFrame([(*r, "x", 0) for r in vectors(40)], SCHEMA)).collect()
    assert len(set(root.glob("vectors-*")) - had) == 1 and before == spark.conf.get("spark.checkpoint.dir")
