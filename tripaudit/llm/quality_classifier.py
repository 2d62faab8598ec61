"""Quality classifier by co-training of a text view and a metadata view.

The views are fitted on a bounded sample of at most about ``LABELLED``
labelled documents, chosen by a hash of the id, and on feature counts of all
other documents that a view is confident about: in each round a map scores
them, and their counts are added up by feature. All documents are scored.
"""

from __future__ import annotations

import math
import pickle
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripaudit.llm.common import keep

LABELLED = 12_000
ROUNDS = 3
CONFIDENT = 0.95  # least probability of a pseudo-label
FLUSH = 150_000  # distinct features that a task counts before it passes them on
TEXTS_AT_ONCE = 512
LOST = 0.002  # of good calibration documents that the threshold may cost, at most
MIN_DOCS, MIN_Z = 5, 5.0  # a feature counts from so many documents and so many standard deviations on

SIGN_END = re.compile(rb"[^0-9A-Za-z\x80-\xff]{2,}$")
UPPER = bytes(range(65, 91))
SIGNS = bytes(b for b in range(33, 127) if not chr(b).isalnum() and chr(b) not in ".,;:'\"-()?")
DIGITS = b"0123456789"


def _word_features(word: bytes) -> tuple[bytes, ...]:
    lower = word.lower()
    out = [b"w:" + lower]
    if len(lower) > 4:
        out.append(b"p:" + lower[:4])
    if len(lower) > 5:
        out.append(b"p:" + lower[:5])
    end = SIGN_END.search(word)
    if end:
        out.append(b"s:" + end[0][-2:])
    return tuple(out)


def _level(x: float, steps: Sequence[float]) -> int:
    return sum(x >= s for s in steps)


def shape_features(raw: bytes, n_words: int, distinct: int) -> list[bytes]:
    """Levels of a text's overall shape."""
    n, size = max(1, n_words), max(1, len(raw))
    values = {
        "upper": _level((size - len(raw.translate(None, UPPER))) / size, (0.1, 0.25, 0.5)),
        "signs": _level((size - len(raw.translate(None, SIGNS))) / size, (0.01, 0.03, 0.1, 0.2)),
        "digits": _level((size - len(raw.translate(None, DIGITS))) / size, (0.05, 0.15, 0.3)),
        "distinct": _level(distinct / n, (0.05, 0.15, 0.3, 0.5)) if n >= 20 else 9,
        "length": _level(size / n, (2, 4, 8, 12, 20)),
    }
    return [f"h:{k}:{v}".encode() for k, v in values.items()]


def text_features(text: str | None) -> set[bytes]:
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    distinct = set(words)
    out = set(shape_features(raw, len(words), len(distinct)))
    for word in distinct:
        out.update(_word_features(word))
    return out


def metadata_features(source, lang, n_chars) -> set[bytes]:
    size = -1 if n_chars is None else min(20, int(math.log2(max(1, n_chars))))
    return {f"source:{source}".encode(), f"lang:{lang}".encode(), f"size:{size}".encode(), f"lang:{lang}:size:{size}".encode()}


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Rows:
    """Feature sets of documents as numbers: ``items[starts[i] : starts[i + 1]]`` are those of document i in ``names``."""

    def __init__(self, names: list[bytes], starts: np.ndarray, items: np.ndarray):
        self.names, self.starts, self.items = names, starts, items

    @classmethod
    def of(cls, docs) -> Rows:
        """From feature sets, one at a time: only numbers and one object per feature stay."""
        if isinstance(docs, cls):
            return docs
        numbers: dict[bytes, int] = {}
        parts = [np.fromiter((numbers.setdefault(f, len(numbers)) for f in own), np.int32, len(own)) for own in docs]
        starts = np.concatenate(([0], np.cumsum([len(p) for p in parts]))).astype(np.int64)
        return cls(list(numbers), starts, np.concatenate(parts) if parts else np.zeros(0, np.int32))

    def __len__(self) -> int:
        return len(self.starts) - 1

    def document(self) -> np.ndarray:
        """The document of each item."""
        return np.repeat(np.arange(len(self)), np.diff(self.starts))

    def take(self, chosen: np.ndarray) -> Rows:
        """The documents that ``chosen`` (boolean) marks, in order."""
        sizes = np.diff(self.starts)
        return Rows(self.names, np.concatenate(([0], np.cumsum(sizes[chosen]))), self.items[np.repeat(chosen, sizes)])


class View:
    """Logistic regression on the presence of features that set good and bad documents apart."""

    def __init__(self, bound: int = 4000, min_z: float = MIN_Z):
        self.bound, self.min_z = bound, min_z
        self.weights: dict[bytes, float] = {}
        self.bias, self.scale, self.shift = 0.0, 1.0, 0.0

    def select(self, counts, n: int, n_good: int) -> list[bytes]:
        """The features ``(name, in all, in good)`` that set ``n_good`` of ``n`` documents apart most."""
        rate = n_good / n if n else 0.5
        scored = []
        for f, k, k_good in counts:
            if k >= MIN_DOCS and 0 < rate < 1:
                spread = math.sqrt(k * rate * (1 - rate) * (1 - k / (n + 1)))
                z = abs(k_good - k * rate) / max(spread, 1e-9)
                if z >= self.min_z:
                    scored.append((-z, f))
        return [f for _, f in sorted(scored)[: self.bound]]

    def fit(self, docs: Sequence[set[bytes]], good: np.ndarray, pseudo: dict[bytes, tuple[int, int]] | None = None) -> None:
        """Fit on documents and on ``pseudo``: per feature its count in all and in good pseudo-labelled documents.

        Each feature's pseudo-labels are a likelihood of its own: they count
        at most as much as the documents with the feature, or in full where
        fewer than ``MIN_DOCS`` have it. The key b"" has the totals.
        """
        pseudo, docs = pseudo or {}, Rows.of(docs)
        n, n_good = len(docs), int(good.sum())
        total, total_good = pseudo.get(b"", (0, 0))
        document = docs.document()
        in_all = np.bincount(docs.items, minlength=len(docs.names))
        in_good = np.bincount(docs.items[good[document]], minlength=len(docs.names))
        several = np.flatnonzero(in_all >= MIN_DOCS)
        names = self.select(((docs.names[i], int(in_all[i]), int(in_good[i])) for i in several), n, n_good)
        known = set(names)
        names += [f for f in self.select(((f, *k) for f, k in pseudo.items() if f), total, total_good) if f not in known]
        extra = np.array([pseudo.get(f, (0, 0)) for f in names], np.float64).reshape(-1, 2)
        at = {f: i for i, f in enumerate(names)}
        column = np.array([at.get(f, -1) for f in docs.names], np.int64)
        own_counts = np.zeros(len(names))
        own_counts[column[column >= 0]] = in_all[column >= 0]
        extra *= np.where(own_counts < MIN_DOCS, 1.0, np.minimum(1.0, own_counts / np.maximum(extra[:, 0], 1)))[:, None]
        odds = math.log((total_good + 1) / (total - total_good + 1))
        columns = column[docs.items]
        rows, columns = document[columns >= 0], columns[columns >= 0]
        y = good.astype(np.float64)
        w, bias = np.zeros(len(names)), math.log((n_good + 1) / (n - n_good + 1))
        grad_w, grad_b, squares, square_b = w, 0.0, np.full(len(names), 1e-6), 1e-6
        for _ in range(150):
            p = _sigmoid(bias + np.bincount(rows, weights=w[columns], minlength=n)) if n else y
            error = p - y
            grad_w = np.bincount(columns, weights=error[rows], minlength=len(names)) + 0.5 * w
            grad_w += extra[:, 0] * _sigmoid(odds + w) - extra[:, 1]
            grad_b = error.sum()
            squares += grad_w * grad_w
            square_b += grad_b * grad_b
            w = w - 0.3 * grad_w / np.sqrt(squares)
            bias -= 0.1 * grad_b / math.sqrt(square_b)
        self.weights, self.bias, self.scale, self.shift = dict(zip(names, w.tolist())), float(bias), 1.0, 0.0

    def raw(self, own) -> float:
        get = self.weights.get
        return self.bias + sum(get(f, 0.0) for f in own)

    def raw_rows(self, docs: Rows) -> np.ndarray:
        get = self.weights.get
        weights = np.array([get(f, 0.0) for f in docs.names])
        return self.bias + np.bincount(docs.document(), weights=weights[docs.items], minlength=len(docs)) if len(docs) else np.zeros(0)

    def probability(self, docs) -> np.ndarray:
        raw = self.raw_rows(docs) if isinstance(docs, Rows) else np.array([self.raw(d) for d in docs])
        return _sigmoid(raw * self.scale + self.shift)

    def calibrate(self, docs, good: np.ndarray) -> None:
        """Platt scaling with smoothed targets on documents that were not fitted."""
        if not len(docs) or good.all() or not good.any():
            return
        x = self.raw_rows(Rows.of(docs))
        n1, n0 = good.sum(), (~good).sum()
        y = np.where(good, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
        a, b = 1.0, 0.0
        for _ in range(60):  # Newton steps, lightly damped towards a = 1
            p = _sigmoid(a * x + b)
            v = p * (1 - p)
            g = np.array([((p - y) * x).sum() + 0.1 * (a - 1), (p - y).sum()])
            h = np.array([[(v * x * x).sum() + 0.1, (v * x).sum()], [(v * x).sum(), v.sum() + 1e-6]])
            step = np.linalg.solve(h, g)
            a, b = a - step[0], b - step[1]
        self.scale, self.shift = float(max(a, 0.0)), float(b)


class Model:
    """Both calibrated views, the prior of good documents and the threshold."""

    def __init__(self, text: View, metadata: View, prior: float, threshold: float):
        self.text, self.metadata, self.prior, self.threshold = text, metadata, prior, threshold

    def combine(self, p_text, p_metadata):
        logit = lambda p: np.log(np.clip(p, 1e-9, 1 - 1e-9) / np.clip(1 - p, 1e-9, 1))
        return _sigmoid(logit(p_text) + logit(p_metadata) - logit(np.asarray(self.prior)))


def fit_views(texts: list[set[bytes]], metadata: list[set[bytes]], labels: list[bool], pseudo: Sequence[dict | None] = (None, None)) -> Model:
    """Both views from labelled documents and pseudo-label counts of each view.

    Every fifth document calibrates and is not fitted. Without good or without
    bad labels nothing is rejected.
    """
    labels = np.array(labels, bool)
    calibration = np.arange(len(labels)) % 5 == 0
    views, y = [View(), View(min_z=2.0)], labels[~calibration]
    if not len(y) or y.all() or not y.any():
        return Model(*views, 0.5, 0.0)
    p = []
    for side, view, counts in zip((texts, metadata), views, pseudo):
        side = Rows.of(side)
        view.fit(side.take(~calibration), y, counts)
        held = side.take(calibration)
        view.calibrate(held, labels[calibration])
        p.append(view.probability(held))
    model = Model(*views, float(y.mean()), 0.5)
    right = np.sort(model.combine(*p)[labels[calibration]])
    if len(right):
        model.threshold = float(min(0.5, right[int(LOST * len(right))]))
    return model


def confident(p: np.ndarray) -> list[bool | None]:
    """Pseudo-labels: good, bad, or none."""
    return [True if x >= CONFIDENT else False if x <= 1 - CONFIDENT else None for x in p]


def count_labels(counts: dict[bytes, list[int]], own: set[bytes], good: bool) -> None:
    for f in (b"", *own):
        n = counts.setdefault(f, [0, 0])
        n[0] += 1
        n[1] += good


def co_train(texts: list[set[bytes]], metadata: list[set[bytes]], labels: list[bool | None], rounds: int = ROUNDS) -> Model:
    """Co-training in one process: views label documents without a label (None) for each other over some rounds."""
    known, pool = ([i for i, y in enumerate(labels) if (y is None) == none] for none in (False, True))
    sides = texts, metadata
    sample = *([side[i] for i in known] for side in sides), [labels[i] for i in known]
    model = fit_views(*sample)
    for _ in range(rounds if pool and model.threshold else 0):
        pseudo: list[dict] = [{}, {}]
        for k, view in enumerate((model.text, model.metadata)):
            for i, y in zip(pool, confident(view.probability([sides[k][i] for i in pool]))):
                if y is not None:
                    count_labels(pseudo[1 - k], sides[1 - k][i], y)
        model = fit_views(*sample, pseudo)
    return model


def _digest(own: list[bytes]) -> bytes:
    """Equal for equal sorted features."""
    return xxhash.xxh3_128_digest(b"\n".join(own))


def _pseudo_counts(docs: DataFrame, columns: Sequence[str], model: Model) -> list[dict[bytes, tuple[int, int]]]:
    """Feature counts per view of all ``docs`` that the other view is confident about, as far as they can matter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer, counts = Scorer(model), ({}, {})

        def flush(side: int) -> pa.RecordBatch:
            own = counts[side]
            n = np.array(list(own.values()), np.int64).reshape(-1, 2)
            out = pa.record_batch([pa.array([side] * len(own), pa.int32()), pa.array(list(own), pa.binary()), pa.array(n[:, 0]), pa.array(n[:, 1])], names=["side", "feature", "n", "good"])
            own.clear()
            return out

        for batch in batches:
            other = [batch[c].to_pylist() for c in columns[1:]]
            meta = [metadata_features(*row) for row in zip(*other)]
            by_text = confident(_sigmoid(scorer.texts(batch[columns[0]]) * model.text.scale + model.text.shift))
            by_meta = confident(model.metadata.probability(meta))
            for t, m, y_text, y_meta in zip(batch[columns[0]], meta, by_text, by_meta):
                if y_meta is not None:
                    count_labels(counts[0], text_features(t.as_py()), y_meta)
                    if len(counts[0]) > FLUSH:
                        yield flush(0)
                if y_text is not None:
                    count_labels(counts[1], m, y_text)
                    if len(counts[1]) > FLUSH:
                        yield flush(1)
        yield flush(0)
        yield flush(1)

    counted = docs.select(*columns).mapInArrow(run, "side int, feature binary, n long, good long")
    summed = keep(counted.groupBy("side", "feature").agg(F.sum("n").alias("n"), F.sum("good").alias("good")), "classifier-counts")
    out: list[dict[bytes, tuple[int, int]]] = [{}, {}]
    for r in summed.where(F.length("feature") == 0).collect():
        out[r.side][b""] = (r.n, r.good)
    for side, view in enumerate((model.text, model.metadata)):
        total, good = out[side].get(b"", (0, 0))
        if not 0 < good < total:
            continue
        rate = good / total
        own = summed.where((F.col("side") == side) & (F.length("feature") > 0))
        spread = F.sqrt(F.col("n") * (rate * (1 - rate)) * (1 - F.col("n") / (total + 1)))
        z = F.abs(F.col("good") - F.col("n") * rate) / F.greatest(spread, F.lit(1e-9))
        most = own.where((F.col("n") >= MIN_DOCS) & (z >= view.min_z)).orderBy(F.desc(z), "feature").limit(2 * view.bound)
        fitted = own.sparkSession.createDataFrame([(f,) for f in view.weights], "feature binary")
        for r in (*most.collect(), *own.join(F.broadcast(fitted), "feature", "left_semi").collect()):
            out[side][bytes(r.feature)] = (r.n, r.good)
    return out


def fit(docs: DataFrame, labels: DataFrame, columns: Sequence[str], labelled: int = LABELLED) -> Model:
    """Fit on a bounded labelled sample in one task and on counts of all other documents; ``labels`` has ``_id`` (distinct) and ``_good``."""
    share = F.lit(max(1, -(-labels.count() // labelled)))
    chosen = labels.where(F.pmod(F.xxhash64("_id", F.lit(3)), share) == 0)
    sample = docs.join(F.broadcast(chosen), "_id").select("_id", *columns, "_good")  # about ``labelled`` narrow rows at most
    pool = docs.join(F.broadcast(chosen.select("_id")), "_id", "left_anti")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, source, lang, size = (batch[c].to_pylist() for c in columns)
            for at in range(0, len(text), 500):
                own = [sorted(text_features(t)) for t in text[at : at + 500]]
                meta = [sorted(metadata_features(*row)) for row in zip(source[at : at + 500], lang[at : at + 500], size[at : at + 500])]
                part = batch.slice(at, 500)
                yield pa.RecordBatch.from_arrays(
                    [part["_id"].cast(pa.string()), pa.array([_digest(f) for f in own], pa.binary()), pa.array(own, pa.list_(pa.binary())), pa.array(meta, pa.list_(pa.binary())), part["_good"]],
                    names=["id", "digest", "own", "other", "good"],
                )

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers: tuple[dict[bytes, int], dict[bytes, int]] = ({}, {})
        rows = []
        for batch in batches:  # numbers in place of features as soon as they are read
            sides = []
            for own, seen in zip((batch["own"], batch["other"]), numbers):
                coded = own.flatten().dictionary_encode()
                code = np.array([seen.setdefault(f, len(seen)) for f in coded.dictionary.to_pylist()], np.int32)
                sides.append(np.split(code[coded.indices.to_numpy(zero_copy_only=False)], np.cumsum(pc.list_value_length(own).to_numpy(zero_copy_only=False))[:-1]))
            rows += zip(batch["id"].to_pylist(), batch["digest"].to_pylist(), batch["good"].to_pylist(), *sides)
        rows.sort(key=lambda r: (r[0] or "", r[1]))
        kept, seen_before = [], set()
        for row in rows:
            if row[1:3] not in seen_before:  # one of each group of equal feature sets
                seen_before.add(row[1:3])
                kept.append(row)
        sides = []
        for side, names in zip((3, 4), numbers):
            parts = [row[side] for row in kept]
            starts = np.concatenate(([0], np.cumsum([len(p) for p in parts]))).astype(np.int64)
            sides.append(Rows(list(names), starts, np.concatenate(parts) if parts else np.zeros(0, np.int32)))
        yield pa.record_batch({"model": pa.array([pickle.dumps(fit_views(*sides, [row[2] for row in kept], pseudo))], pa.binary())})

    extracted = keep(sample.mapInArrow(features, "id string, digest binary, own array<binary>, other array<binary>, good boolean"), "classifier-sample").repartition(1)
    pseudo: Sequence[dict | None] = (None, None)
    model = pickle.loads(extracted.mapInArrow(learn, "model binary").first().model)
    for _ in range(ROUNDS if model.threshold else 0):
        pseudo = _pseudo_counts(pool, columns, model)
        model = pickle.loads(extracted.mapInArrow(learn, "model binary").first().model)
    return model


class Scorer:
    """Scores of texts, ``bound`` at a time: each different word is looked up once among the features that carry weight, in arrays."""

    def __init__(self, model: Model, bound: int = TEXTS_AT_ONCE):
        self.view, self.bound = model.text, bound
        self.numbers = {f: i for i, f in enumerate(self.view.weights)}
        self.weights = np.array([*self.view.weights.values(), 0.0])
        self.sets = {}
        for kind in (b"w:", b"p:", b"s:"):
            own = [f for f in self.numbers if f.startswith(kind)]
            self.sets[kind] = pa.array([f[2:] for f in own], pa.binary()), np.array([*(self.numbers[f] for f in own), -1], np.int64)

    def _look(self, kind: bytes, values: pa.Array) -> np.ndarray:
        names, numbers = self.sets[kind]
        return numbers[pc.fill_null(pc.index_in(values, value_set=names), -1).to_numpy(zero_copy_only=False)]

    def _weighted(self, words: pa.Array) -> np.ndarray:
        """Numbers of the features of ``_word_features`` that carry weight, a row for each kind and a column for each word; -1 for none."""
        raw, lower = words.cast(pa.binary()), pc.ascii_lower(words).cast(pa.binary())
        size = pc.binary_length(raw).to_numpy(zero_copy_only=False)
        prefixes = [np.where(size > n, self._look(b"p:", pc.binary_slice(lower, 0, n)), -1) for n in (4, 5)]
        return np.stack([self._look(b"w:", lower), *prefixes, self._look(b"s:", pc.binary_slice(raw, -2))])  # only two signs are in the last set

    def _texts(self, texts: pa.Array) -> np.ndarray:
        cut = pc.ascii_split_whitespace(texts)
        coded = cut.flatten().dictionary_encode()
        words, code = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)
        document = np.repeat(np.arange(len(texts)), np.diff(cut.offsets.to_numpy()))
        blank = pc.index(words, pa.scalar("", words.type)).as_py()
        if blank >= 0:  # white space at the ends of a text
            real = code != blank
            document, code = document[real], code[real]
        n_words = np.bincount(document, minlength=len(texts))
        pairs = np.sort(document * len(words) + code)
        pairs = pairs[np.concatenate(([True], pairs[1:] != pairs[:-1]))] if len(pairs) else pairs
        document, code = np.divmod(pairs, max(1, len(words)))
        n_distinct = np.bincount(document, minlength=len(texts))
        found = self._weighted(words)
        some = (found >= 0).any(axis=0)[code]
        document, features = document[some], found[:, code[some]]
        keys = [(document * len(self.weights) + features)[features >= 0]]
        for i, raw in enumerate(texts.cast(pa.binary()).to_pylist()):
            shape = shape_features(raw, int(n_words[i]), int(n_distinct[i]))
            keys.append(np.array([i * len(self.weights) + self.numbers[f] for f in shape if f in self.numbers], np.int64))
        document, feature = np.divmod(np.unique(np.concatenate(keys)), len(self.weights))
        return self.view.bias + np.bincount(document, weights=self.weights[feature], minlength=len(texts))

    def texts(self, texts: pa.Array) -> np.ndarray:
        """Raw scores; null texts are empty."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        return np.concatenate([self._texts(texts.slice(at, self.bound)) for at in range(0, max(1, len(texts)), self.bound)])


ADDED = ["text_score", "metadata_score", "quality_score", "kept"]


def classify(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    columns: Sequence[str] = ("text", "source", "lang", "n_chars"),
    labelled: int = LABELLED,
) -> DataFrame:
    """All rows and columns of ``docs`` with ``text_score, metadata_score, quality_score, kept``.

    ``labels`` has ``doc_id``, ``quality`` and ``toxic``; good is quality 1 and
    not toxic. A null quality is no label, a null toxic is 0, and contradicting labels
    of an id count as bad. Null metadata is a value of its own, a null
    text is empty. Without labels of both kinds every row is kept. An
    empty table gives an empty result; repeated rows are scored each; columns
    with the names that are added are replaced.
    """
    good = (F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0)
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    known = known.groupBy(F.col("doc_id").alias("_id")).agg(F.min(good).alias("_good"))
    plain = docs.drop(*ADDED)
    model = fit(plain.select(F.col(id_col).alias("_id"), *columns), known, columns, labelled)
    names = plain.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            source, lang, size = (batch[c].to_pylist() for c in columns[1:])
            p_text = _sigmoid(scorer.texts(batch[columns[0]]) * model.text.scale + model.text.shift)
            p_meta = model.metadata.probability([metadata_features(*row) for row in zip(source, lang, size)])
            p = model.combine(p_text, p_meta)
            added = [pa.array(p_text), pa.array(p_meta), pa.array(p), pa.array(p >= model.threshold)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*names, *ADDED])

    doubles = [T.StructField(n, T.DoubleType()) for n in ADDED[:3]]
    return plain.mapInArrow(run, T.StructType([*plain.schema.fields, *doubles, T.StructField(ADDED[3], T.BooleanType())]))
