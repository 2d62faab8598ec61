from itertools import permutations

import pytest

from tripaudit.llm import filter_audit

PLAIN = " ".join(f"word{i}" for i in range(60))
DULL = "same words again " * 20
LOUD = " ".join(f"WORD{i}" for i in range(60))
MARKED = PLAIN + " #tag"
SCHEMA = "doc_id long, text string, source string"


def failing(rows):
    """Plain masks of ``(doc_id, text)`` rows."""
    out = []
    for key, text in rows:
        text = text or ""
        words = text.translate(str.maketrans("\t\n\x0b\x0c\r", "     ")).split(" ")
        words = [w for w in words if w]
        found = set()
        if len(words) < 50:
            found.add("A")
        if 100 * len(set(words)) < 65 * len(words):
            found.add("B")
        if 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text):
            found.add("C")
        if set("#$%&*|") & set(text):
            found.add("D")
        if key is not None and any(k is not None and k < key and (t or "") == text for k, t in rows):
            found.add("E")
        out.append(found)
    return out


def brute_force(docs, labels):
    flags = {}
    for key, quality, toxic in labels:
        good, bad = flags.get(key, (False, False))
        flags[key] = (good or quality == 1, bad or toxic == 1)
    flags.pop(None, None)
    failed = failing([d[:2] for d in docs])
    want = {}
    for part in {d[2] or "" for d in docs}:
        own = [(flags.get(d[0], (False, False)), f) for d, f in zip(docs, failed) if (d[2] or "") == part]
        total = dict.fromkeys("ABCDE", 0)
        rows = {}
        for order in map("".join, permutations("ABCDE")):
            left = own
            for step, letter in enumerate(order, 1):
                removed = [x for x in left if letter in x[1]]
                left = [x for x in left if letter not in x[1]]
                total[letter] += len(removed)
                rows[part, order, step] = [
                    len(left), len(removed), sum(letter in f for _, f in own) - len(removed),
                    sum(f == {letter} for _, f in own), sum(x[0][0] for x in removed), sum(x[0][1] for x in removed),
                ]
        for (p, order, step), row in rows.items():
            want[p, order, step] = (*row, total[order[step - 1]])
    return want


def collected(frame):
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    rows = frame.collect()
    got = {(r.part, r.filter_order, r.step): tuple(r[n] for n in names) for r in rows}
    assert len(got) == len(rows)
    return got


def test_ranks_and_intervals():
    orders = filter_audit.ORDERS
    assert orders == sorted(orders) and len(orders) == 120
    for length in range(1, 6):
        for prefix in {o[:length] for o in orders}:
            assert filter_audit.lehmer_rank(prefix) == min(i for i, o in enumerate(orders) if o.startswith(prefix))
    for mask in range(32):
        covered = {}
        for step, intervals in filter_audit.removal_intervals(mask).items():
            assert all(a[1] < b[0] for a, b in zip(intervals, intervals[1:]))
            for start, end in intervals:
                covered.update(dict.fromkeys(range(start, end), step))
        for rank, order in enumerate(orders):
            first = next((s for s, c in enumerate(order, 1) if mask >> "ABCDE".index(c) & 1), None)
            assert covered.get(rank) == first


@pytest.mark.parametrize("case", ["mixed", "hot"])
def test_against_brute_force(spark, case):
    if case == "mixed":
        texts = [PLAIN, None, "", " \t\n", DULL, LOUD, MARKED, DULL + "#", LOUD.replace("5", "*"), "a", "A|a", "x " * 3000, PLAIN, MARKED, "É" * 60]
        docs = [(i, t, s) for i, (t, s) in enumerate(zip(texts, ["a", None, "", "b"] * 4))]
        docs += [(0, PLAIN, "a"), (3, PLAIN, "b"), (None, PLAIN, "b"), (None, "fresh", None), (99, "fresh", "a"), (98, "fresh", "a"), (98, "fresh", "a")]
        labels = [(0, 1, 0), (0, 0, 1), (1, None, 1), (4, 1, 1), (None, 1, 1), (77, 1, 1), (98, 1, None)]
    else:
        docs = [(i, DULL, "hot") for i in range(400)] + [(1000 + i, f"{PLAIN} {i}", f"s{i % 7}") for i in range(100)]
        labels = [(i, i % 2, (i + 1) % 3 == 0) for i in range(0, 1100, 3)]
        labels = [(k, q, int(t)) for k, q, t in labels]
    wide = spark.createDataFrame([(*d, 1, "x") for d in docs], SCHEMA + ", good int, mask string")
    marks = spark.createDataFrame([(*r, "x") for r in labels], "doc_id long, quality int, toxic int, part string")
    assert collected(filter_audit.audit(wide, marks)) == brute_force(docs, labels)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(spark.createDataFrame([], SCHEMA), none).collect() == []
    got = collected(filter_audit.audit(spark.createDataFrame([(1, "a", "s")], SCHEMA), none))
    assert len(got) == 600 and got["s", "ABCDE", 1] == (0, 1, 0, 1, 0, 0, 120)
