import math
import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tripaudit.llm import gru, lm_scoring
from tripaudit.llm.queries import REGISTRY

SF = "/root/testdata/sf0.01"


def brute(rows):
    """id -> (held_out, n_tokens, n_known, N, base) by plain counting."""
    words = lambda t: (t or "").encode().lower().split() + ["end"]
    held = lambda i: zlib.crc32(str(i).encode()) % 10 == 0
    c = Counter(w for i, t in rows if not held(i) for w in words(t))
    n, v = sum(c.values()), len(c)
    norm = n + 0.1 * (v + 1)
    return {i: (held(i), len(words(t)), sum(c[w] > 0 for w in words(t)), n, sum(math.log10((c[w] + 0.1) / norm) for w in words(t))) for i, t in rows}


def test_query_against_brute_force(spark):
    want = brute([(d.doc_id, d.text) for d in spark.read.parquet(f"{SF}/documents.parquet").collect()])
    got = REGISTRY["op1_lm_scoring"](spark, SF).collect()
    assert len(got) == len(want)
    gain = tokens = 0
    for r in got:
        held, n, known, total, base = want[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score < 0
        if held:
            gain += r.score - r.base_score
            tokens += n
    assert gain / tokens > 0.02  # better than the unigram on held-out texts


def small(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, score string, held_out string")


def test_blocks_do_not_change_counts(spark):
    rows = [(i, f"Common word{i % 7} WORD{i % 3} é{i}", "x", "y") for i in range(60)]
    held = F.col("doc_id") % 5 == 0
    one = {r.doc_id: r for r in lm_scoring.score(small(spark, rows), held).collect()}
    many = {r.doc_id: r for r in lm_scoring.score(small(spark, rows), held, block_bytes=100).collect()}
    for i in one:
        assert one[i][1:5] == many[i][1:5] and one[i].base_score == pytest.approx(many[i].base_score)


def test_nulls_repeats_empty(spark):
    rows = [(1, None, "a", "b"), (2, "", None, None), (3, "a b", "", ""), (3, "a b", "", ""), (None, "z " * 3000, "", "")]
    got = lm_scoring.score(small(spark, rows), F.col("doc_id") == 2).collect()
    assert sorted((r.doc_id or 0, r.n_tokens) for r in got) == [(0, 3001), (1, 1), (2, 1), (3, 3), (3, 3)]
    assert lm_scoring.score(small(spark, []), F.lit(False)).collect() == []
    only_held = lm_scoring.score(small(spark, rows[:3]), F.lit(True)).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and math.isfinite(r.score) for r in only_held)


def test_every_window_gives_an_update(spark):
    """The main round of short documents, against the same passes by hand."""
    texts = [f"a b c{i % 3} d" for i in range(20)]
    words = [b"a", b"b", b"d", b"c0", b"c1", b"c2"]
    counts = np.array([20, 20, 20, 20, 7, 7, 6])
    vocabulary = SimpleNamespace(head={w: i + 1 for i, w in enumerate(words)}, head_counts=counts, tail_counts=np.zeros(gru.TAIL_CLASSES))
    docs = [np.array([*(vocabulary.head[w] for w in t.encode().split()), 0], np.int32) for t in texts]
    p = gru.initial(counts, vocabulary.tail_counts)
    for rate, epochs in ((0.01, 2), (0.003, 1)):
        trainer = gru.Trainer(p, rate)
        for _ in range(epochs):
            trainer.learn(docs)
        p = trainer.p
    rows = spark.createDataFrame(list(enumerate(texts)), "_id long, _text string").coalesce(1)
    got = lm_scoring.train_model(rows, vocabulary, len(texts))
    assert np.allclose(got, gru.flatten(p), atol=1e-4)


def test_probabilities_sum_to_one():
    p = gru.initial(np.arange(1, 200), np.arange(gru.TAIL_CLASSES))
    states = np.random.default_rng(1).standard_normal((3, gru.HIDDEN)).astype(np.float32)
    for s in states:
        tokens = np.arange(gru.INPUTS)
        total = np.exp(gru.token_scores(p, np.repeat(s[None], len(tokens), 0), tokens)).sum()
        assert total == pytest.approx(1, abs=1e-4)


def test_gradients():
    """Analytic gradients against central differences."""
    rng = np.random.default_rng(3)
    p = {k: v.astype(np.float64) for k, v in gru.initial(np.ones(40), np.ones(gru.TAIL_CLASSES)).items()}
    for k in p:
        p[k] = p[k] + 0.3 * rng.standard_normal(p[k].shape) * (p[k] > -20)
    docs = [rng.integers(0, 40, 9).astype(np.int32), np.array([1050, 3, 7, 1060], np.int32)]

    def loss(q):
        grid, counts = next(gru.windows(docs))
        live = np.arange(2)[None, :] < counts[:, None]
        before, saved = gru.run_states(q, grid, counts, np.zeros((2, gru.HIDDEN)), save=True)
        out, grads, d = gru.token_scores(q, before[live], grid[live], gradient=True)
        d_before = np.zeros_like(before)
        d_before[live] = d
        return -float(out.sum()), gru.backward(q, grid, counts, before, saved, d_before, grads)

    _, grads = loss(p)
    for k in p:
        places = np.argsort(-np.abs(grads[k].ravel()))[:3]
        for at in places:
            eps, near = 1e-2, []
            for sign in (1, -1):
                q = {n: v.copy() for n, v in p.items()}
                q[k].ravel()[at] += sign * eps
                near.append(loss(q)[0])
            assert grads[k].ravel()[at] == pytest.approx((near[0] - near[1]) / (2 * eps), rel=0.05, abs=0.02), k


def test_state_is_carried():
    """Scoring in windows equals one long window."""
    p = gru.initial(np.ones(50), np.ones(gru.TAIL_CLASSES))
    doc = np.random.default_rng(5).integers(0, 50, 70).astype(np.int32)
    whole = gru.log_likelihoods(p, [doc])[0]
    grid, counts = next(gru.windows([doc], steps=100))
    before, _ = gru.run_states(p, grid, counts, np.zeros((1, gru.HIDDEN), np.float32))
    assert whole == pytest.approx(float(gru.token_scores(p, before[:, 0], grid[:, 0]).sum()), rel=1e-4)


def test_words_and_classes_in_arrays():
    """Words, their classes and buckets found in arrays equal those found word by word."""
    texts = [None, "", " \t\n", "A b\x0bC\x0cd\re", " é!! ab, É ;;. x9 9. !a. a!. \x1c\x1f q\x00z ", "A b 日本.", "z " * 50]
    for part in (texts, texts[:3], texts[4:5], []):
        words, ids, counts = lm_scoring._local_ids(pa.array(["cut off", *part, None], pa.string()).slice(1, len(part)))
        plain = [(t or "").encode().lower().split() for t in part]
        own = words.to_pylist()
        assert [own[i] for i in ids] == [w for t in plain for w in t] and counts.tolist() == [len(t) for t in plain]
        assert len(set(own)) == len(own)
        assert gru.tail_classes(*lm_scoring._bytes_of(words)).tolist() == [gru.tail_class(w) for w in own]
        head = {w: i + 1 for i, w in enumerate(own[:3])}
        assert lm_scoring._model_ids(words, head).tolist() == [head.get(w, gru.HEAD + gru.tail_class(w)) for w in own]
        order, met, bounds = lm_scoring._by_bucket(words, 3)
        assert {zlib.crc32(own[i]) % 3 for i in order} == set(met.tolist()) and bounds[-1] == len(own) == len(set(order.tolist()))
        closed = lm_scoring._documents(lm_scoring._closed(ids + 1, counts))
        assert [c[-1] for c in closed] == [0] * len(part) and [len(c) - 1 for c in closed] == counts.tolist()
        assert [own[i - 1] for c in closed for i in c[:-1]] == [w for t in plain for w in t]


def test_portions_hold_all_texts_once():
    texts = [None, "ab", "", "c" * 30, "é", "d", None, "e" * 9]
    for size in (1, 4, 10, 1000):
        batches = [pa.record_batch({"t": pa.array(part, pa.string())}) for part in (texts[:3], [], texts[3:4], texts[4:])]
        got = [p.to_pylist() for p in lm_scoring._portions(iter(batches), size)]
        assert [t for p in got for t in p] == texts
        assert all(sum(len((t or "").encode()) for t in p) >= size for p in got[:-1])


def test_blocks_without_words(spark):
    got = lm_scoring.score(small(spark, [(i, None if i % 2 else " ", "", "") for i in range(9)]), F.col("doc_id") == 2, block_bytes=1).collect()
    assert sorted((r.doc_id, r.n_tokens, r.train_tokens) for r in got) == [(i, 1, 8) for i in range(9)]


def test_far_logits():
    """Numbers whose exponentials would overflow or vanish give the same as small ones moved together."""
    x = np.array([[100.0, 99, 0], [-200, -201, -300], [0, 1, 2]], np.float32)
    places = np.array([1, 3, 8])
    want = [float(r[k] - r.max() - np.log(np.exp(r - r.max()).sum())) for r, k in zip(x.astype(float), (1, 0, 2))]
    assert gru._softmax(x.copy(), places)[0] == pytest.approx(want, abs=1e-5)
