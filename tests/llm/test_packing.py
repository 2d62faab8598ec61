import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tripaudit.llm import packing
from tripaudit.llm.queries import REGISTRY

PATH = public_tokenizers.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.01"
ODD = [
    "", " ", "a", " a", "a ", "a  b", "a \n b", "\n a", "don't stop  it's", "a\tb c", "x <|endoftext|> y", "é b c",
    "a  b", "\r\n\r\n x  \n", "日本 語 text", "1 22 333", "#$ %& x", "a\x1c b", "end \n",
]


def check_layout(rows, ids_of, capacity=1024):
    """Every id once, sequences gapless from 0 and within capacity; returns the padding."""
    own, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        own[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    assert set(own) == set(ids_of)
    for key, pieces in own.items():
        ids, at = ids_of[key], 0
        for r in sorted(pieces, key=lambda r: r.start):
            assert r.start == at and r.length > 0 and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(np.asarray(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    padding = 0
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
        padding += capacity - at
    return padding


def test_query_against_plain_encoding(spark):
    tokenizer = Tokenizer.from_file(PATH)
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    want = {d.doc_id: tokenizer.encode(d.text or "", add_special_tokens=False).ids + [0] for d in docs}
    padding = check_layout(REGISTRY["op5_packing"](spark, SF).collect(), want)
    assert padding < 0.02 * sum(map(len, want.values()))


def test_units_equal_whole_encoding():
    tokenizer, own = Tokenizer.from_file(PATH), packing.Units(PATH)
    got = own.ids(pa.array(ODD))
    for text, ids in zip(ODD, got):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids + [0], text


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=" \n\tab'sé1#<|endoftx> ", max_size=30))
def test_units_random(text):
    own, tokenizer = packing.units(PATH), Tokenizer.from_file(PATH)
    want = tokenizer.encode(text, add_special_tokens=False).ids + [0]
    assert np.frombuffer(own.ids(pa.array([text]))[0], "<u4").tolist() == want


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=60))
def test_balance(lengths):
    rows, n = packing.balance(lengths, 64)
    assert n == -(-sum(lengths) // 64)
    fill, got = defaultdict(int), defaultdict(int)
    for item, start, length, sequence, offset in rows:
        assert start == got[item] and offset == fill[sequence] and length > 0 and sequence < n
        got[item] += length
        fill[sequence] += length
    assert [got[i] for i in range(len(lengths))] == lengths and all(v <= 64 for v in fill.values())


def test_balance_evens_cost():
    rows, n = packing.balance([60, 50, 40, 30, 30, 20, 10, 10, 6], 64)
    costs = defaultdict(float)
    for _, _, length, sequence, _ in rows:
        costs[sequence] += packing.cost(length, 1.0, 1 / 64)
    assert n == 4 and max(costs.values()) < 1.8 * min(costs.values())


@pytest.mark.parametrize("schema", ["doc_id bigint, text string, offset int, ids string"])
def test_nulls_repeats_empty(spark, schema):
    rows = [(1, None, 1, "x"), (2, "", None, None), (3, "a b", 1, "y"), (3, "a b", 1, "y"), (None, "z", 1, "z")]
    out = packing.pack(spark.createDataFrame(rows, schema), PATH).collect()
    assert sorted((r.doc_id or -1, r.doc_tokens) for r in out) == [(-1, 2), (1, 1), (2, 1), (3, 3), (3, 3)]
    assert packing.pack(spark.createDataFrame([], schema), PATH).collect() == []


def test_long_text_and_small_groups(spark):
    frame = spark.createDataFrame([(i, "word " * 3000 if i == 4 else "alpha beta") for i in range(40)], "doc_id long, text string")
    out = packing.pack(frame.coalesce(1), PATH, group_tokens=500).collect()
    assert max(r.length for r in out) == 1024 and len({r.doc_id for r in out}) == 40


def test_few_texts_are_looked_up_at_once():
    """A task held the units of 6 MB of text, which took the pipeline over an executor's memory."""
    texts, seen = pa.array(["a" * 500_000] * 12 + [None]), []

    def encode(part):
        seen.append(sum(len(t or "") for t in part.to_pylist()))
        return [b""] * len(part)

    parts = list(packing.encoded(list(range(13)), texts, encode, 2_000_000))
    assert [k for keys, _ in parts for k in keys] == list(range(13))
    assert max(seen) <= 2_500_000 and sum(seen) == 6_000_000


def test_gathered_ids_are_those_of_each_unit():
    """Repeated, empty and Latin-1 units, more than one run of words, a slice and no unit at all."""
    cache = packing.Units(PATH)
    words = [chr(97 + k % 26) * (1 + k // 26) + "é" * (k % 3) for k in range(600)]
    units = pa.array(["a", *words, "", "über,", "ÿ", *words])
    for part in (units, units.slice(5, 9), units.slice(0, 0)):
        ids, n = cache.gather(part)
        own = [cache.tokenizer.encode(" " + u, add_special_tokens=False).ids if u else [] for u in part.to_pylist()]
        assert ids.tolist() == [i for u in own for i in u] and n.tolist() == [len(u) for u in own]
