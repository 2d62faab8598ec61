import re
from collections import Counter

from tripaudit.llm import host_rules
from tripaudit.llm.queries import REGISTRY

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words), sum(map(len, words)), sum(c in host_rules.SYMBOLS for c in text), len(lines) - len(set(lines)), len(covered),
    )


def test_query_counts_against_brute_force(spark):
    want = {d.doc_id: counts(d.text) for d in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = REGISTRY["op7_host_rules"](spark, SF).collect()
    assert len(got) == len(want)
    for r in got:
        n, chars, symbols, lines, repeat = want[r.doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want[r.doc_id]
        assert r.base_failed == (n < 50 or 100 * repeat > 50 * n)
        assert not (r.kept and r.base_failed)


def test_edge_texts(spark):
    texts = [None, "", " \n\t", "a", "a a a a", "a b c a b c", "\na b\na b\n \n", "x y é\x0bz\x1c w", "#a|b <c>", "a b a b a b a",
             "w " * 5000 + "tail", "a\x00b a\x00b a\x00b a\x00b"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in host_rules.with_counts(frame).collect():
        assert tuple(r[c] for c in host_rules.COUNTS) == counts(r.text), repr(r.text)


GOOD = " ".join(f"word{i}" for i in range(60))
BAD = "#### " * 60


def test_hosts(spark):
    rows = [(i, GOOD, "good") for i in range(60)] + [(100 + i, BAD, "bad") for i in range(60)]
    rows += [(200, GOOD, "bad"), (201, GOOD, None), (202, GOOD, "new"), (203, BAD, "good"), (204, GOOD + " ##### #####", "good")]
    schema = "doc_id long, text string, source string, kept string, n_words int"
    out = host_rules.judge(spark.createDataFrame([(*r, "x", 1) for r in rows], schema))
    got = {r.doc_id: r for r in out.collect()}
    assert len(got) == len(rows) and out.columns.count("kept") == 1
    assert all(got[i].kept for i in range(60)) and got[201].kept and got[202].kept and got[204].kept
    assert not got[200].kept and not got[203].kept and not got[100].kept
    assert 0.9 < got[200].host_rate < 1 and got[202].host_rate > got[0].host_rate


def test_empty_repeats_and_one_host(spark):
    schema = "doc_id long, text string, source string"
    assert host_rules.judge(spark.createDataFrame([], schema)).collect() == []
    out = host_rules.judge(spark.createDataFrame([(1, GOOD, "a"), (1, GOOD, "a"), (None, None, None)], schema)).collect()
    assert sorted((r.doc_id or 0, r.kept) for r in out) == [(0, False), (1, True), (1, True)]
