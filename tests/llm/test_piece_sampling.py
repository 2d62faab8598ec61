import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from tripaudit.llm import piece_sampling as ps
from tripaudit.llm.queries import REGISTRY

PATH = public_tokenizers.path("piece_bpe_32k.model")
MODEL = sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def lattices():
    return ps.Lattices(PATH)


def segmentations(text):
    """All piece sequences of a text with their weights, without cuts or sharing."""
    norm = ps.SPACE + text.replace(" ", ps.SPACE)
    ids = {MODEL.id_to_piece(i): i for i in range(3, 32000) if not MODEL.is_byte(i) and not MODEL.is_unused(i)}
    spell = {int(MODEL.id_to_piece(i)[3:-1], 16): i for i in range(3, 259)}
    weight = lambda i: -ps.ALPHA * math.log(2 + min(32000, max(0.0, -MODEL.get_score(i))))

    def go(at):
        if at == len(norm):
            yield (), 0.0
            return
        for end in range(at + 1, len(norm) + 1):
            i = ids.get(norm[at:end])
            if i is not None:
                own, w = (i,), weight(i)
            elif end == at + 1:
                own = tuple(spell[b] for b in norm[at].encode())
                w = len(own) * -ps.ALPHA * math.log(2 + 32000)
            else:
                continue
            for rest, v in go(end):
                yield own + rest, w + v

    return dict(go(0))


@pytest.mark.parametrize("text", ["the", "a  b", " the", "in\nan", "é日x", "on 𝒳", "x▁y"])
def test_all_segmentations_once(lattices, text):
    want = segmentations(text)
    total = math.log(sum(map(math.exp, want.values())))
    got = ps.sample_texts(lattices, [5], [text], len(want) + 3)[0]
    assert {tuple(r[0].tolist()): r[1] for r in got} == pytest.approx({k: w - total for k, w in want.items()})
    assert len(got) == len(want) and all(r[3] == 0 for r in got)
    values = [r[2] for r in got]
    assert values == sorted(values, reverse=True)


def test_draws_follow_the_probabilities(lattices):
    """First draws by probability; pairs of draws by probability without replacement."""
    text, n = "then", 6000
    want = segmentations(text)
    total = sum(map(math.exp, want.values()))
    p = {k: math.exp(w) / total for k, w in want.items()}
    got = ps.sample_texts(lattices, [k * 7919 + 3 for k in range(n)], [text] * n, 2)
    first = Counter(tuple(r[0][0].tolist()) for r in got)
    pairs = Counter(tuple(tuple(x[0].tolist()) for x in r) for r in got)
    for k, q in p.items():
        assert abs(first[k] / n - q) < 5 * math.sqrt(q / n) + 1e-3
    for (a, b), seen in pairs.most_common(8):
        q = p[a] * p[b] / (1 - p[a])
        assert a != b and abs(seen / n - q) < 5 * math.sqrt(q / n) + 1e-3


def test_far_regions_are_opened(lattices, monkeypatch):
    """With far regions from the first step on, still every segmentation once and by its probability."""
    monkeypatch.setattr(ps, "FAR", 0.0)
    test_all_segmentations_once(lattices, "in\nan")
    test_all_segmentations_once(lattices, "on the")
    test_draws_follow_the_probabilities(lattices)


def test_inclusion_scores_estimate_sums(lattices):
    """Weighting by 1 / inclusion gives unbiased sums over all segmentations (here: their number and pieces)."""
    text, n = "ones", 5000
    want = segmentations(text)
    rows = ps.sample_texts(lattices, [k * 104729 + 1 for k in range(n)], [text] * n, 3)
    totals = [sum(math.exp(lp - inc) for _, lp, _, inc in r) for r in rows]
    assert np.mean(totals) == pytest.approx(1, abs=0.05) and len(want) > 3


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=25), st.integers(0, 2**63))
def test_round_trip_distinct_and_same(lattices, text, key):
    got = ps.sample_texts(lattices, [key], [text], 4)[0]
    assert all(ps.Decoder(lattices.pieces)(r[0]) == text.replace(ps.SPACE, " ") for r in got)
    assert len({tuple(r[0].tolist()) for r in got}) == len(got) >= 1
    again = ps.sample_texts(ps.lattices_of(PATH, ps.ALPHA), [1, key, 2], ["other text", text, text + " more"], 4)[1]
    assert [(r[0].tolist(), r[2]) for r in got] == [(r[0].tolist(), pytest.approx(r[2])) for r in again]
    if text and got:
        assert MODEL.decode(got[0][0].tolist()) == text.replace(ps.SPACE, " ") or "\x00" in text or "�" in text


def test_spark_nulls_repeats_long(spark):
    schema = "doc_id long, text string, rank string, ids int"
    rows = [(1, None, "x", 0), (2, "", "x", 0), (3, "some text here", "x", 0), (3, "some text here", "x", 0), (None, "a b", None, None)]
    rows.append((9, "wordswithoutanyspace" * 3000, "x", 0))
    got = ps.sample(spark.createDataFrame(rows, schema), PATH).collect()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert len(by[1]) == len(by[2]) == 1 and by[1][0].ids == b"" and by[1][0].decoded == ""
    assert len(by[3]) == 4 and by[3][0].ids == by[3][2].ids and len(by[9]) == 2
    assert by[9][0].decoded == "wordswithoutanyspace" * 3000 and by[9][0].ids != by[9][1].ids
    assert ps.sample(spark.createDataFrame([], schema), PATH).collect() == []


def test_query_round_trip(spark):
    from pyspark.sql import functions as F

    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = REGISTRY["op4_piece_sampling"](spark, sf).join(docs, "doc_id")
    same = F.crc32(F.coalesce("text", F.lit("")).cast("binary")) == F.col("text_crc32")
    out = got.groupBy("doc_id").agg(F.count("*").alias("n"), F.count_distinct("ids_crc32").alias("d"), F.min(same).alias("same")).collect()
    assert len(out) == docs.count() and all(r.same and r.n == r.d for r in out) and sum(r.n == 2 for r in out) > 0.99 * len(out)


ODD = ["the quick brown fox", "a  b", " lead", "trail ", "x▁y z", "", "é日x 日本語 on 𝒳", "\ud800 lone \udfff", "in\nan\ttab", "same same same", "wordswithoutanyspace" * 20, "tie aa aa bb ab ba"]


def test_draws_stay_the_same():
    """Checksum of the draws before parts were numbered and edges sorted by single numbers."""
    crc = 0
    for own in ps.sample_texts(ps.Lattices(PATH), list(range(len(ODD))), ODD, 3):
        for ids, *_ in own:
            crc = zlib.crc32(ids.astype("<i4").tobytes(), crc)
    assert crc == 2852474206


def test_chunks_do_not_depend_on_the_batch():
    """Texts cut together, alone, and after others give chunks that spell them."""
    together, again = ps.Lattices(PATH), ps.Lattices(PATH)
    found = together.chunks_of(ODD)
    for text, own in zip(ODD, found):
        for numbers, lattices in ((own, together), (again.chunks_of([text])[0], again)):
            spelled = list(lattices.chunks)
            assert "".join(spelled[i] for i in numbers) == (ps.SPACE + text.replace(" ", ps.SPACE) if text else "")
    assert [x.tolist() for x in together.chunks_of(ODD)] == [x.tolist() for x in found]
    assert together.chunks_of([]) == []


def test_edges_are_sorted_as_by_lexsort():
    rng = np.random.default_rng(2)
    source, value, step = rng.integers(0, 50, 900), rng.integers(-4, 1, 900) * 0.25, rng.permutation(900)
    got = np.argsort((source * len(value) + ps._falling_ranks(value)) * 900 + step)
    assert got.tolist() == np.lexsort((step, -value, source)).tolist()
    assert ps._falling_ranks(np.array([0.5, -1.0, 0.5, -0.0, 0.0])).tolist() == [0, 2, 0, 1, 1]
