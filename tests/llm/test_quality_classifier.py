import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tripaudit.llm import quality_classifier as qc
from tripaudit.llm.queries import REGISTRY

DOCS = "doc_id long, text string, source string, lang string, n_chars long, kept string"
LABELS = "doc_id long, quality int, toxic int"


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    held = F.col("doc_id") % 4 == 0
    scored = qc.classify(docs, labels.where(~held)).join(labels.where(held), "doc_id").select("doc_id", "kept", "quality", "toxic").collect()
    rates = {k: np.mean([r.kept for r in rows]) for k, rows in (
        ("clean", [r for r in scored if r.quality == 1 and not r.toxic]),
        ("junk", [r for r in scored if r.quality == 0]),
        ("toxic", [r for r in scored if r.toxic]),
    )}
    assert rates["clean"] > 0.985 and rates["junk"] < 0.1 and rates["toxic"] < 0.25, rates


def test_query_covers_all(spark):
    sf = "/root/testdata/sf0.01"
    got = REGISTRY["op6_quality_classifier"](spark, sf)
    assert got.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert got.columns == ["doc_id", *qc.ADDED]


def test_nulls_repeats_empty_no_labels(spark):
    rows = [(1, None, None, None, None, "x"), (2, "", "s", "en", 0, "x"), (3, "word " * 4000, "s", "en", 2**40, "x"), (3, "a", "s", "en", 1, "x"), (None, "b", "s", "en", -5, None)]
    frame = spark.createDataFrame(rows, DOCS)
    for labels in ([], [(1, 1, None)], [(None, 1, 0), (2, None, 1)], [(1, 1, 0), (1, 0, 0), (2, 0, 0)]):
        out = qc.classify(frame, spark.createDataFrame(labels, LABELS)).collect()
        assert len(out) == len(rows) and all(r.kept for r in out)
    assert qc.classify(spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)).collect() == []


def test_scorer_equals_plain_features():
    view = qc.View()
    texts = [f"good word{i} plain text here" for i in range(40)] + [f"bad### word{i} AWFUL awful### text" for i in range(40)]
    view.fit([qc.text_features(t) for t in texts], np.arange(80) < 40)
    scorer = qc.Scorer(qc.Model(view, qc.View(), 0.5, 0.5), bound=3)
    texts += ["", None, "awful### new", "  bad###\tAWFUL \n", "É éb### \u2003x", "w " * 3000]
    for part in (texts, texts[:1], texts[-6:-4]):
        got = scorer.texts(pa.array(part, pa.string()))
        assert np.allclose(got, [view.raw(qc.text_features(t)) for t in part])
    assert len(scorer.texts(pa.array([], pa.string()))) == 0
    assert view.raw(qc.text_features("awful###")) < view.raw(qc.text_features("good plain"))


def test_views_teach_each_other():
    """Only the metadata tells the pool apart; the text view learns its words from pseudo-labels."""
    rng = np.random.default_rng(1)
    texts, metadata, labels = [], [], []
    for i in range(800):
        good = bool(i % 2)
        known = i < 200
        words = {f"w:common{rng.integers(9)}".encode()}
        words |= {b"w:fine" if good else b"w:foul"} if known else {b"w:late-fine" if good else b"w:late-foul"}
        texts.append(words)
        metadata.append({b"source:a" if good else b"source:b"})
        labels.append(good if known else None)
    model = qc.co_train(texts, metadata, labels)
    assert b"w:late-foul" in model.text.weights and model.text.weights[b"w:late-foul"] < 0
    alone = qc.co_train(texts[:200], metadata[:200], labels[:200])
    assert b"w:late-foul" not in alone.text.weights


def test_pseudo_labels_come_from_all_documents(spark):
    """A word of 36 in 20,000 unlabelled documents, of which a sample of 6,000 has too few, is learnt."""
    rows, labels = [], []
    for i in range(20_800):
        good, known = bool(i % 2), i < 800
        word = ("fine" if good else "foul") if known else "rarefoul" if i in range(1000, 1072) and not good else "late"
        rows.append((i, f"common{i % 9} {word} word{i}", "a" if good else "b", "en", 20, None))
        if known:
            labels.append((i, int(good), 0))
    docs = spark.createDataFrame(rows, DOCS)
    known = spark.createDataFrame(labels, LABELS).select(F.col("doc_id").alias("_id"), (F.col("quality") == 1).alias("_good"))
    model = qc.fit(docs.withColumnRenamed("doc_id", "_id"), known, ("text", "source", "lang", "n_chars"))
    assert model.text.weights.get(b"w:rarefoul", 0) < 0


def test_only_equal_texts_are_copies(spark):
    """Documents that share almost all words, with another word each, are all fitted."""
    words = " ".join(f"same{i}" for i in range(400))
    rows = [(i, f"{words} {'fine' if i % 2 else 'foul'} own{i}", "s", "en", 20, None) for i in range(400)]
    known = spark.createDataFrame([(i, bool(i % 2)) for i in range(400)], "_id long, _good boolean")
    model = qc.fit(spark.createDataFrame(rows, DOCS).withColumnRenamed("doc_id", "_id"), known, ("text", "source", "lang", "n_chars"))
    assert model.text.weights[b"w:foul"] < 0 < model.text.weights[b"w:fine"]


def test_classify_equals_plain_co_training(spark):
    """The distributed rounds against the same in one process, on 500 documents of which 300 are labelled."""
    rng = np.random.default_rng(5)
    rows, labels = [], []
    for i in range(500):
        good = bool(rng.integers(2))
        words = [f"w{rng.integers(40)}" for _ in range(20)] + ["fine" if good else "foul"] * int(rng.integers(2)) + [f"own{i}"]
        rows.append((i, " ".join(words), "a" if good == (rng.random() < 0.97) else "b", "en", 100, None))
        if i < 300:
            labels.append((i, int(good), 0))
    frame = spark.createDataFrame(rows, DOCS).repartition(3)
    got = {r.doc_id: r for r in qc.classify(frame, spark.createDataFrame(labels, LABELS)).collect()}
    order = sorted(range(300), key=lambda i: (str(i), qc._digest(sorted(qc.text_features(rows[i][1]))))) + list(range(300, 500))
    known = dict((i, bool(q)) for i, q, _ in labels)
    texts = [qc.text_features(rows[i][1]) for i in order]
    metadata = [qc.metadata_features(*rows[i][2:5]) for i in order]
    model = qc.co_train(texts, metadata, [known.get(i) for i in order])
    p = model.combine(model.text.probability(texts), model.metadata.probability(metadata))
    assert len(got) == 500 and np.allclose([got[i].quality_score for i in order], p, atol=1e-4)
    sure = np.abs(p - model.threshold) > 1e-3
    assert np.array([got[i].kept for i in order])[sure].tolist() == (p >= model.threshold)[sure].tolist() and sure.sum() > 400


def test_words_are_looked_up_in_arrays(monkeypatch):
    """A batch's scores need no features made word by word, and equal them on odd words."""
    words = ["word", "words", "wordsy", "WORDSY", "ééé", "éa", "a##", "##", "#", "x1!?", "日本語", "-\x00-", "a\x1c\x1d", "!!é", "p:w", ""]
    texts = [f" {a} {b}\n" for a in words for b in words] + [None, "é" * 30]
    every = sorted(set().union(*(qc.text_features(t) for t in texts)))
    view = qc.View()
    view.weights, view.bias = {f: 0.01 * 1.01**i for i, f in enumerate(every)}, 0.5
    want = [view.raw(qc.text_features(t)) for t in texts]

    def never(word):
        raise AssertionError(word)

    monkeypatch.setattr(qc, "_word_features", never)
    for bound in (1, 7, 512):
        got = qc.Scorer(qc.Model(view, qc.View(), 0.5, 0.5), bound).texts(pa.array(texts, pa.string()))
        assert np.allclose(got, want, rtol=1e-12)
