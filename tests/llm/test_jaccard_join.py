import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tripaudit.llm import jaccard_join, signature_tree
from tripaudit.llm.components import components
from tripaudit.llm.queries import REGISTRY

SF = "/root/testdata/sf0.01"


def shingles(text):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    if len(words) < 5:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute(rows):
    """id -> (n_shingles, component) from all pairs that share a shingle."""
    sets, posting = {}, defaultdict(list)
    for i, text in rows:
        sets[i] = shingles(text)
    for i, s in sets.items():
        for x in s:
            posting[x].append(i)
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, s in sets.items():
        for j, n in Counter(j for x in s for j in posting[x] if j > i).items():
            if 100 * n >= 75 * (len(s) + len(sets[j]) - n):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def outcome(frame):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in frame.collect()}


def test_query_against_brute_force(spark):
    rows = [(d.doc_id, d.text) for d in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = brute(rows)
    assert len({c for _, c in want.values()}) < len(rows)
    assert outcome(REGISTRY["op9_jaccard_join"](spark, SF)) == want


def near_copies(seed, groups=12, size=9, length=60):
    rng = random.Random(seed)
    rows = []
    for g in range(groups):
        base = [f"w{rng.randrange(4000)}" for _ in range(length + g)]
        for _ in range(size):
            own = list(base)
            for _ in range(rng.randrange(4)):
                own[rng.randrange(len(own))] = f"x{rng.randrange(10**6)}"
            rows.append((len(rows) * 3 + 1, " ".join(own)))
    return rows


@pytest.mark.parametrize("tree_shingles", [3_000_000, 300, 60])
def test_near_copies_in_small_trees_and_blocks(spark, tree_shingles):
    """Also neighbourhoods larger than a task, where one centre does not link all."""
    rows = near_copies(5)
    frame = spark.createDataFrame([(i, t, "c", 0) for i, t in rows], "doc_id long, text string, component_id string, n_shingles int")
    got = jaccard_join.join(frame, block_bytes=5000, tree_shingles=tree_shingles)
    assert outcome(got) == brute(rows)


def test_chains_over_the_threshold(spark):
    """Texts of which each is near the next only; links lie close to the threshold."""
    words = [f"v{i}" for i in range(400)]
    rows = [(k, " ".join(words[4 * k : 4 * k + 50])) for k in range(60)] + [(100 + k, " ".join(words[7 * k : 7 * k + 50])) for k in range(30)]
    want = brute(rows)
    assert len({c for _, c in want.values()}) < len(rows)
    for tree in (3_000_000, 200):
        assert outcome(jaccard_join.join(spark.createDataFrame(rows, "doc_id long, text string"), tree_shingles=tree)) == want


def test_edges(spark):
    texts = [None, "", " \n", "a", "A", "b", "a b c d", "a b c d", "a b c d e", "A b\tc D e", "é x", "É x", "long " * 30000, "long " * 40000]
    rows = list(enumerate(texts))
    assert outcome(jaccard_join.join(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)
    same = [(7, "a b c d e f"), (7, "a b c d e f"), (3, "a b c d e f"), (None, "a b c d e f"), (None, None), (None, "z z z z z z")]
    got = jaccard_join.join(spark.createDataFrame(same, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in got) == [(0, 0), (0, 0), (0, 3), (3, 3), (7, 3), (7, 3)]
    assert jaccard_join.join(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_cut_hashes_round_trip():
    values = np.unique(np.random.default_rng(1).integers(0, 2**64, 1000, dtype=np.uint64))
    for width in range(4, 9):
        cut = np.unique(jaccard_join._cut(values, width))
        assert (jaccard_join._unpack(jaccard_join._pack(cut, width), width) == cut).all()
    assert jaccard_join.hash_bytes(10**8) == 5 and jaccard_join.hash_bytes(10**13) == 7


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(2, 40))
def test_tree_join_finds_all_components(seed, n):
    rng = np.random.default_rng(seed)
    base = [np.unique(rng.integers(0, 2**63, 30).astype(np.uint64)) for _ in range(3)]
    sets = []
    for _ in range(n):
        own = base[rng.integers(3)].copy()
        own[rng.integers(0, len(own), rng.integers(0, 6))] = rng.integers(0, 2**63, 1).astype(np.uint64)[0]
        sets.append(np.unique(own))
    def full(pairs):
        parent = list(range(n))
        for i, j in pairs:
            a, b = parent[i], parent[j]
            parent = [min(a, b) if p in (a, b) else p for p in parent]
        return parent

    pairs = [(i, j) for i in range(n) for j in range(i) if signature_tree.linked(sets[i], sets[j])]
    join = signature_tree.Join(sets)
    join.within(signature_tree.build(sets, range(n)))
    assert full(join.links) == full(pairs)
    cut = n // 2
    between = signature_tree.Join(sets)
    between.between(signature_tree.build(sets, range(cut)), signature_tree.build(sets, range(cut, n)))
    assert full(between.links) == full([(i, j) for i, j in pairs if (i < cut) != (j < cut)])


def test_tree_prunes():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 2**63, 200).astype(np.uint64)) for _ in range(300)]
    join = signature_tree.Join(sets)
    join.within(signature_tree.build(sets, range(300)))
    assert not join.links and join.compared < 300 * 299 / 2 / 10


def test_components(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(100, 164)] + [(rng.randrange(60), rng.randrange(60)) for _ in range(40)]
    frame = spark.createDataFrame(edges, "a long, b long")
    nodes = sorted({x for e in edges for x in e})
    label = {x: x for x in nodes}
    for _ in nodes:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    assert {r.node: r.component for r in components(frame).collect()} == label
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
