import random
import zlib
from bisect import bisect_left, insort
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tripaudit.llm import best_fit, unit_cache
from tripaudit.llm.queries import REGISTRY

PATH = public_tokenizers.path("word_bpe_49k.json")
SF = "/root/testdata/sf0.01"
TOKENIZER = Tokenizer.from_file(PATH)
ODD = [
    "", " ", "a", "Don't STOP  it's", "x <|endoftext|> y<|startoftext|>z", "é b́ ́c", "日本 語 text", "1 22 333", "#$ %& x",
    "a\x1cb \x1dc\x1e \x1fd", "a\u180eb\u200bc\ufeffd", "ΣΑΣ İi ẞ", "end \n", *[f"a{chr(c)}b" for c in range(1 << 16) if chr(c).isspace()],
    "\t\v\f\r\n", "a\x00b", "x" * 3000,
]


def best_fit_decreasing(lengths, capacity):
    free, n = [], 0
    for length in sorted(lengths, reverse=True):
        at = bisect_left(free, length)
        gap = free.pop(at) if at < len(free) else capacity
        n += gap == capacity
        if gap > length:
            insort(free, gap - length)
    return n


def check(rows, ids_of, capacity=2048):
    """Every id once, only long documents cut, sequences gapless and within capacity; returns their number."""
    own, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        own[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    assert set(own) == set(ids_of)
    for key, pieces in own.items():
        ids = ids_of[key]
        pieces.sort(key=lambda r: r.piece)
        assert [(r.piece, r.start, r.length) for r in pieces] == [(i, s, min(capacity, len(ids) - s)) for i, s in enumerate(range(0, len(ids), capacity))]
        for r in pieces:
            assert r.ids_crc32 == zlib.crc32(np.asarray(ids[r.start : r.start + r.length], "<u4").tobytes())
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_query_against_plain_encoding(spark):
    tokenizer = Tokenizer.from_file(PATH)
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    want = {d.doc_id: tokenizer.encode(d.text or "", add_special_tokens=False).ids + [0] for d in docs}
    n = check(REGISTRY["op12_best_fit"](spark, SF).collect(), want)
    lengths = [len(i) for i in want.values()]
    pieces = [2048] * sum(x // 2048 for x in lengths) + [x % 2048 for x in lengths if x % 2048]
    assert n <= 1.01 * best_fit_decreasing(pieces, 2048) + 1


def test_words_equal_whole_encoding():
    tokenizer, own = Tokenizer.from_file(PATH), best_fit.Words(PATH)
    ids, n = own.ids(pa.array([*ODD, None]))
    for text, found in zip([*ODD, ""], np.split(ids, np.cumsum(n)[:-1])):
        assert found.tolist() == tokenizer.encode(text, add_special_tokens=False).ids + [0], repr(text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=" \n\tab'SésÉ́1#<|endoftx>\x1c\x85 Σ", max_size=30))
def test_words_random(text):
    want = TOKENIZER.encode(text, add_special_tokens=False).ids + [0]
    assert best_fit.words(PATH).ids(pa.array([text]))[0].tolist() == want


def test_slices_hold_about_so_many_bytes():
    rng = random.Random(6)
    for _ in range(100):
        texts = [None if rng.random() < 0.1 else "x" * rng.choice([0, 1, 5, 40]) for _ in range(rng.randint(0, 30))]
        runs = unit_cache.text_slices(pa.array(texts, pa.string()), 20)
        assert [i for at, n in runs for i in range(at, at + n)] == list(range(len(texts)))
        assert all(sum(len(t or "") for t in texts[at + 1 : at + n]) <= 20 for at, n in runs)


def test_cache_stays_bounded(monkeypatch):
    monkeypatch.setattr(unit_cache, "KEPT_UNITS", 10)
    own = best_fit.Words(PATH)
    for n in range(30):
        texts = [" ".join(f"w{i}" for i in range(n, n + 8)) + " common " + "y" * (100 + n)]
        assert own.ids(pa.array(texts))[0].tolist() == TOKENIZER.encode(texts[0], add_special_tokens=False).ids + [0]
        assert len(own.young) <= 21 and len(own.old) <= 21 and "common" in own.young
    assert all(len(u) <= 64 for u in own.old)


def layout(spark, sizes, capacity):
    units = spark.createDataFrame(list(enumerate(sizes)), "key long, size long")
    rows = best_fit.place(units, capacity).collect()
    assert sorted(r.key for r in rows) == list(range(len(sizes)))
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, sizes[r.key]))
    for own in sequences.values():
        own.sort()
        assert [o for o, _ in own] == [sum(s for _, s in own[:i]) for i in range(len(own))]
        assert sum(s for _, s in own) <= capacity
    return len(sequences)


SIZES = {
    "uniform": lambda r: [r.randint(1, 127) for _ in range(3000)],
    "halves": lambda r: [r.choice([63, 64, 65]) for _ in range(600)],
    "hot": lambda r: [1] * 5000 + [r.randint(1, 120) for _ in range(600)],
    "one": lambda r: [5],
    "thirds": lambda r: [43] * 400 + [2] * 50,
}


@pytest.mark.parametrize("name", sorted(SIZES))
def test_number_of_sequences(spark, name):
    sizes = SIZES[name](random.Random(4))
    assert layout(spark, sizes, 128) <= 1.02 * best_fit_decreasing(sizes, 128) + 1


def test_sweep_is_bracket_matching():
    rng = random.Random(5)
    for _ in range(200):
        docs, gaps = [rng.randint(1, 15) for _ in range(rng.randint(1, 30))], [rng.randint(1, 16) for _ in range(rng.randint(0, 12))]
        counts = defaultdict(int)
        for size, kind in [(d, 0) for d in docs] + [(g, 1) for g in gaps]:
            counts[size, kind, 0] += 1
        counts = sorted((*k, n) for k, n in counts.items())
        runs, opened = best_fit.sweep(counts, 16)
        n_of = {c[:3]: c[3] for c in counts} | {(16, 1, -1): opened}
        events = []
        for size, kind, part, base, slots in runs:
            for rank in range(n_of[size, kind, part]):
                if kind == 0:
                    events.append((size, kind, base + rank + 1))
                else:
                    events += [(size, kind, base - rank * slots - s) for s in range(slots)]
        stack, last = [], {}
        for size, kind, depth in events:
            if kind == 0:
                stack.append((size, depth))
            elif stack and stack[-1][1] == depth:
                assert stack.pop()[0] <= size
            else:
                assert not stack
            assert last.get(depth, (0, -1)) < (size, kind)
            last[depth] = (size, kind)
        assert opened > 0 or any(k == 1 for _, k, _ in events)


def test_nulls_repeats_empty_and_long(spark):
    schema = "doc_id bigint, text string, row int, key string, size int"
    rows = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "z"), (4, "word " * 5000), (5, "word " * 2047), (6, "word " * 2048)]
    out = best_fit.pack(spark.createDataFrame([(*r, 1, "x", 2) for r in rows], schema), PATH).collect()
    got = sorted((r.doc_id or -1, r.piece, r.start, r.length) for r in out)
    assert got == [(-1, 0, 0, 2), (1, 0, 0, 1), (2, 0, 0, 1), (3, 0, 0, 3), (3, 0, 0, 3), (4, 0, 0, 2048), (4, 1, 2048, 2048), (4, 2, 4096, 905),
                   (5, 0, 0, 2048), (6, 0, 0, 2048), (6, 1, 2048, 1)]
    assert len({r.sequence_id for r in out}) == 5
    assert best_fit.pack(spark.createDataFrame([], schema), PATH).collect() == []
