import re

import pytest

from tripaudit.llm import license_scan

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def base(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = WORD.findall(text)
    starts, labels = [], set()
    for phrase, label in license_scan.PHRASES:
        p = phrase.split()
        at = [i for i in range(len(words)) if words[i : i + len(p)] == p]
        starts += at
        labels |= {label} if at else set()
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


TEXTS = [
    None, "", "mit", "license", "MIT License", "the mit-license, mit license and MIT\nLICENSE", "mit  é license", "general public license",
    "general public public license", "apache license apache license mit license", "Émit license", "mit licenseé", "x" * 20000 + " mit license",
    "word " * 9000 + "General Public License", "licensed under the apache licence version 2 0", "\x7fmit\x00license\x80",
]


def test_base_against_brute_force(spark):
    frame = spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(TEXTS)], "doc_id long, text string, n_words int, labels string")
    got = {r.doc_id: r for r in license_scan.scan(frame).collect()}
    assert len(got) == len(TEXTS)
    for i, text in enumerate(TEXTS):
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base(text), text
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(","))) and 0 <= r.score <= 1


@pytest.mark.parametrize(
    "text, labels",
    [
        ("Licensed under CC BY-NC 4.0.", "cc-by-nc"),
        ("Permission is hereby granted, free of charge, to any new person obtaining a copy of this software", "mit"),
        ("Permission is hereby granted only to Bob", ""),
        ("All rights reserved.", "reserved"),
        ("This work is licensed under the GNU General Public License, version 3", "gpl"),
    ],
)
def test_sentences(spark, text, labels):
    row = license_scan.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()[0]
    assert row.labels == labels


def test_repeats_and_empty(spark):
    schema = "doc_id long, text string"
    rows = [(1, "mit license"), (1, "mit license"), (1, "none here"), (None, "mit license")]
    got = license_scan.scan(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.doc_id or 0, r.n_base) for r in got) == [(0, 1), (1, 0), (1, 1), (1, 1)]
    assert license_scan.scan(spark.createDataFrame([], schema)).collect() == []


def test_native(spark):
    plan = license_scan.scan(spark.createDataFrame(TEXTS and [(1, "a")], "doc_id long, text string"))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


def test_only_ascii_letters_are_lower_cased(spark):
    """A Kelvin sign is no k: the word pairs with it are no votes."""
    text = "THIS WORK IS LICENSED UNDER THE GNU"
    rows = [(1, text), (2, text.replace("K", "\u212a"))]
    got = {r.doc_id: r for r in license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].score > got[2].score > 0
