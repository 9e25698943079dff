"""Quality scores by co-training two classifiers on separate views of a document.

View one is the text's content: hashed words, transitions between character
classes, repetition. View two is the page's metadata: source, language, length
and line layout. Both are logistic models. In each round either one labels all
unlabelled documents, and what it is sure of (by its calibrated probability)
trains the other one. Texts stay where they lie: a round is one pass that sums
the other model's gradient over the rows passed to it, per class, which is all
that comes back. A model then minimises its loss on the labelled rows together
with that of the passed rows, whose gradient is exact and whose curvature is
taken from the labelled rows. Each view's scores are calibrated on rows kept out
of training, and at last their log-odds add up over the prior. A view that knows
nothing calibrates to the prior and so neither passes labels on nor moves the result.

Only labelled rows are sampled (``LABELLED`` documents at most, those with the
smallest id hashes; labelled ones beyond them count as unlabelled); the exchange
and the scores read every whole text.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import share, shared, small_batches, written
from .words import Scanner, mix, pieces, space_table

LABELLED = 4000                 # labelled documents that the models are fitted on, at most
ROUNDS = 2                      # of the exchange, each a pass over all unlabelled documents
SURE = 0.97                     # calibrated confidence of a label that is passed on
EXCHANGE = 0.5                  # weight of the passed rows beside the labelled rows
PULL = 0.01                     # of a model to where the passed rows' gradient was taken
KEEP = 0.5                      # probability of good quality below which a document is rejected
SHORT = 12                      # words at which a text's content counts half: shorter texts say little
WORD_DIM, KINDS = 512, 16
TEXT_DIM = WORD_DIM + KINDS * KINDS + 5
SOURCE_DIM, LANG_DIM = 64, 16
META_DIM = SOURCE_DIM + LANG_DIM + 5


def _kinds() -> np.ndarray:
    """Character class of each byte."""
    t = np.full(256, 15, np.uint8)
    for k, chars in enumerate((b"aeiou", b"bcdfghjklmnpqrstvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t",
                               b"\n\r", b".", b",;:", b"!?", b"#$%&*@^~", b"|", b"'\"`", b"()[]{}<>", b"-_/\\+=")):
        t[list(chars)] = k
    t[128:] = 14
    return t


def text_view(column, scanner: Scanner, kinds: np.ndarray):
    """Yield (first row, features) per piece of an Arrow text column."""
    for lo, hi, offsets, data in pieces(column):
        n = hi - lo
        w = scanner.scan(offsets, data)
        count = np.diff(w.first)
        doc = np.repeat(np.arange(n), count)
        out = np.zeros((n, TEXT_DIM), np.float32)
        words = np.bincount(doc * WORD_DIM + (w.hash % np.uint64(WORD_DIM)).astype(np.int64), minlength=n * WORD_DIM)
        out[:, :WORD_DIM] = np.sqrt(words.reshape(n, WORD_DIM) / np.maximum(count, 1)[:, None])
        size = np.diff(offsets)
        kind = kinds[data].astype(np.int64)
        if len(data) > 1:
            owner = np.repeat(np.arange(n), size)
            pair = owner[:-1] * (KINDS * KINDS) + kind[:-1] * KINDS + kind[1:]
            steps = np.bincount(pair[owner[:-1] == owner[1:]], minlength=n * KINDS * KINDS)
            out[:, WORD_DIM:WORD_DIM + KINDS * KINDS] = np.sqrt(steps.reshape(n, -1) / np.maximum(size, 1)[:, None])
        order = np.lexsort((w.hash, doc))
        d, h = doc[order], w.hash[order]
        new = np.append(True, (d[1:] != d[:-1]) | (h[1:] != h[:-1])) if len(d) else np.zeros(0, bool)
        same = np.append(False, (doc[1:] == doc[:-1]) & (w.hash[1:] == w.hash[:-1])) if len(doc) else np.zeros(0, bool)
        length = (w.end - w.start).astype(np.float64)
        per = np.maximum(count, 1)
        mean = np.bincount(doc, length, n) / per
        extra = (np.bincount(d[new], minlength=n) / per, np.bincount(doc[same], minlength=n) / per, mean / 10,
                 np.sqrt(np.maximum(np.bincount(doc, length ** 2, n) / per - mean ** 2, 0)) / 10, np.log1p(count) / 10)
        for k, x in enumerate(extra):
            out[:, WORD_DIM + KINDS * KINDS + k] = x
        yield lo, out


def _one_hot(values: list, dim: int) -> np.ndarray:
    import zlib

    out = np.zeros((len(values), dim), np.float32)
    out[np.arange(len(values)), [zlib.crc32((v or "").encode()) % dim for v in values]] = 1
    return out


def meta_view(sources: list, langs: list, chars: list, lines: list) -> np.ndarray:
    chars = np.array([c or 0 for c in chars], np.float64)
    lines = np.maximum(np.array(lines, np.float64), 1)
    layout = np.stack([np.log1p(chars) / 10, np.log1p(lines) / 5, np.log1p(chars / lines) / 10,
                       (chars / lines < 60).astype(float), (lines == 1).astype(float)], 1)
    return np.concatenate([_one_hot(sources, SOURCE_DIM), _one_hot(langs, LANG_DIM), layout.astype(np.float32)], 1)


class Logistic:
    """A logistic model on standardised features, fitted by full gradient steps with momentum, then calibrated.

    ``short``: the last feature is log1p(words)/10, and a text of n words moves
    the log-odds by n/(n + short) of what its features say.
    """

    def __init__(self, short: int = 0):
        self.short = short

    def trust(self, x: np.ndarray) -> np.ndarray:
        if not self.short:
            return np.ones(len(x))
        n = np.expm1(x[:, -1].astype(np.float64) * 10)
        return n / (n + self.short)

    def standard(self, x: np.ndarray) -> np.ndarray:
        z = x - self.mean                       # one copy, in single precision
        z *= self.unit
        z *= self.trust(x).astype(np.float32)[:, None]
        return z

    def slope(self, x: np.ndarray, label: int) -> np.ndarray:
        """Rows, and the sums over them of the loss's derivatives by offset and weights, all rows being of one class."""
        if not len(x):
            return np.zeros(len(self.mean) + 2)
        z = self.standard(x)
        g = 1 / (1 + np.exp(-np.clip(z @ self.z_w + self.b, -30, 30))) - label
        return np.concatenate([[len(x), g.sum()], g.astype(np.float32) @ z])

    def fit(self, x: np.ndarray, y: np.ndarray, passed=None, weight: float = 1e-3, steps: int = 250) -> "Logistic":
        """The loss on labelled rows; from the second fit on also that on ``passed`` rows, given by their ``slope`` per class.

        A class of few passed rows counts by n/(n + labelled rows), so that a handful doesn't outweigh the labels.
        """
        if passed is None:
            self.mean, self.unit = x.mean(0), (1 / (x.std(0) + 0.02) / np.sqrt(x.shape[1])).astype(np.float32)
            self.z_w, self.b = np.zeros(x.shape[1], np.float32), float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)))
        drift = np.zeros(x.shape[1] + 1)
        for label, theirs in enumerate(passed if passed is not None else ()):
            mine = self.slope(x[y == label], label)
            if theirs[0] and mine[0]:
                drift += EXCHANGE * mine[0] / len(y) * theirs[0] / (theirs[0] + len(y)) * (theirs[1:] / theirs[0] - mine[1:] / mine[0])
        gain, pull = (1.0, 0.0) if passed is None else (1 + EXCHANGE, PULL)
        z, slow, quick = self.standard(x), drift[1:].astype(np.float32), drift[0]
        at_w, at_b = self.z_w, self.b
        w, b, vw, vb, rate = at_w, at_b, 0.0, 0.0, 2.0 / gain
        for _ in range(steps):
            g = (1 / (1 + np.exp(-np.clip(z @ w + b, -30, 30))) - y).astype(np.float32)
            vw = (0.9 * vw - rate * (gain * (z.T @ g) / len(y) + slow + weight * w + pull * (w - at_w))).astype(np.float32)
            vb = 0.9 * vb - rate * (gain * g.mean() + quick + pull * (b - at_b))
            w, b = w + vw, b + vb
        self.z_w, self.b, self.a, self.c = w, float(b), 1.0, 0.0
        self.w = (w * self.unit).astype(np.float32)
        self.middle = float(self.mean @ self.w)
        return self

    def raw(self, x: np.ndarray) -> np.ndarray:
        return (x @ self.w - self.middle) * self.trust(x) + self.b

    def calibrate(self, x: np.ndarray, y: np.ndarray, steps: int = 50) -> "Logistic":
        """Slope and offset of the log-odds by penalised Newton steps; slope 0 leaves the prior."""
        s = np.clip(self.raw(x), -30, 30)
        spread = s.std() + 1e-9
        f = np.stack([(s - s.mean()) / spread, np.ones(len(s))], 1)
        t = np.array([0.0, np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))])
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(f @ t, -30, 30)))
            grad = f.T @ (p - y) + np.array([0.5 * t[0], 0.0])
            hess = (f * (p * (1 - p))[:, None]).T @ f + np.diag([0.5, 1e-6])
            t = t - np.clip(np.linalg.solve(hess, grad), -2, 2)
        self.a = float(t[0] / spread)
        self.c = float(t[1] - t[0] * s.mean() / spread)
        return self

    def odds(self, x: np.ndarray) -> np.ndarray:
        """Calibrated log-odds of good quality."""
        return np.clip(self.a * np.clip(self.raw(x), -30, 30) + self.c, -12, 12)


class CoTrained:
    """Both views' models and the prior log-odds: ``learn``, then rounds of ``exchange`` and ``learn``."""

    def learn(self, text: np.ndarray, meta: np.ndarray, y: np.ndarray, passed=None, seed: int = 9) -> "CoTrained":
        """Fit both views to labelled rows, and to what :meth:`exchange` passed to them."""
        kept = np.random.default_rng(seed).random(len(y)) < 0.25        # for calibration only
        if kept.all():
            kept[:] = False
        self.prior = float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)))
        check = kept if kept.any() and 0 < y[kept].sum() < kept.sum() else np.ones(len(y), bool)
        if passed is None:
            self.text, self.meta = Logistic(SHORT), Logistic()
        for k, (model, x) in enumerate(((self.text, text), (self.meta, meta))):
            model.fit(x[~kept], y[~kept], passed and passed[k]).calibrate(x[check], y[check])
        return self

    def exchange(self, text: np.ndarray, meta: np.ndarray) -> list[np.ndarray]:
        """Per view, its gradient sums over the rows of each class that the other view is sure of."""
        limit, out = float(np.log(SURE / (1 - SURE))), []
        for model, x, other in ((self.text, text, self.meta.odds(meta)), (self.meta, meta, self.text.odds(text))):
            out.append(np.stack([model.slope(x[other <= -limit], 0), model.slope(x[other >= limit], 1)]))
        return out

    def fit(self, text: np.ndarray, meta: np.ndarray, y: np.ndarray, pool_text: np.ndarray, pool_meta: np.ndarray) -> "CoTrained":
        """All rounds over rows at hand."""
        self.learn(text, meta, y)
        for _ in range(ROUNDS):
            self.learn(text, meta, y, self.exchange(pool_text, pool_meta))
        return self

    def scores(self, text: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probabilities of good quality: both views, content alone, metadata alone."""
        a, b = self.text.odds(text), self.meta.odds(meta)
        return tuple(1 / (1 + np.exp(-x)) for x in (a + b - self.prior, a, b))


def _views(batch, scanner, kinds):
    text = np.concatenate([x for _, x in text_view(batch.column("text"), scanner, kinds)] or [np.zeros((0, TEXT_DIM), np.float32)])
    meta = meta_view(batch.column("source").to_pylist(), batch.column("lang").to_pylist(),
                     batch.column("n_chars").to_pylist(), batch.column("_lines").to_pylist())
    return text, meta


def _inputs(docs: DataFrame, *more) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1
    return docs.select(text.alias("text"), F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"),
                       F.col("n_chars").cast("double").alias("n_chars"), lines.cast("double").alias("_lines"), *more)


def fit_quality(docs: DataFrame, labels: DataFrame):
    """A CoTrained model from (doc_id, quality) labels, or None if they don't hold both classes.

    Labels with a null id or quality are not used; a document labelled more
    than once counts with its largest label.
    """
    spark = docs.sparkSession
    small_batches(spark)
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.max("quality").cast("int").alias("_y"))
    rank = F.xxhash64(F.lit("quality"), "doc_id")
    ids = docs.select("doc_id").where("doc_id IS NOT NULL").distinct()
    chosen = {r["doc_id"]: r["_y"] for r in ids.join(known, "doc_id").orderBy(rank).limit(LABELLED).collect()}
    if len(set(chosen.values())) < 2:
        return None

    def work(batches):
        scanner, kinds = Scanner(space_table()), _kinds()
        for batch in batches:
            text, meta = _views(batch, scanner, kinds)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([r.tobytes() for r in text], pa.binary()), pa.array([r.tobytes() for r in meta], pa.binary())],
                names=["doc_id", "t", "m"])

    picked = F.coalesce(F.col("doc_id").isin(list(chosen)), F.lit(False))
    # Rows of one id: the one with the smallest features, so the model doesn't depend on the partitioning.
    rows = (_inputs(docs.where(picked), F.col("doc_id").cast("long").alias("doc_id")).mapInArrow(work, "doc_id long, t binary, m binary")
            .groupBy("doc_id").agg(F.min(F.struct("t", "m")).alias("x")).select("doc_id", "x.t", "x.m"))
    rows = written(spark, rows, "labelled")
    model, passed = None, None
    for round_ in range(ROUNDS + 1):
        fitted = rows.repartition(1).sortWithinPartitions("doc_id").mapInArrow(_fit_task(chosen, model, passed), "model binary")
        model = pickle.loads(fitted.first()["model"])
        if round_ < ROUNDS:
            passed = _exchange(docs.where(~picked), model)
    return model


def _fit_task(chosen: dict, model: CoTrained | None, passed: list | None):
    """The labelled rows, LABELLED at most, in one task -> the model fitted once more: the driver's memory stays free of them."""
    def run(batches):
        ids, text, meta = [], [], []
        for batch in batches:
            ids += batch.column("doc_id").to_pylist()
            text += [np.frombuffer(r, np.float32) for r in batch.column("t").to_pylist()]
            meta += [np.frombuffer(r, np.float32) for r in batch.column("m").to_pylist()]
        y = np.array([chosen[i] for i in ids])
        fitted = (model or CoTrained()).learn(np.array(text), np.array(meta), y, passed)
        yield pa.RecordBatch.from_arrays([pa.array([cloudpickle.dumps(fitted)], pa.binary())], names=["model"])
    return run


def _exchange(docs: DataFrame, model: CoTrained) -> list[np.ndarray]:
    """``CoTrained.exchange`` over all rows: a task sums its rows, Spark sums the tasks; about 1,700 numbers come back."""
    fixed = share(docs.sparkSession, model)
    shapes = [(2, TEXT_DIM + 2), (2, META_DIM + 2)]
    first = [0, shapes[0][0] * shapes[0][1]]

    def work(batches):
        scanner, kinds, model = Scanner(space_table()), _kinds(), shared(fixed)
        total = [np.zeros(shape) for shape in shapes]
        for batch in batches:
            for mine, more in zip(total, model.exchange(*_views(batch, scanner, kinds))):
                mine += more
        flat = np.concatenate([t.ravel() for t in total])
        at = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(flat[at], pa.float64())], names=["at", "value"])

    flat = np.zeros(sum(a * b for a, b in shapes))
    for r in _inputs(docs).mapInArrow(work, "at int, value double").groupBy("at").agg(F.sum("value").alias("value")).collect():
        flat[r["at"]] = r["value"]
    fixed.unpersist()
    return [flat[start:start + a * b].reshape(a, b) for start, (a, b) in zip(first, shapes)]


def score_quality(docs: DataFrame, model) -> DataFrame:
    """``docs`` plus quality_score, text_score, meta_score (double) and keep (boolean).

    Scores come from whole texts; null text is empty, null metadata is its own
    category; equal rows score alike; without a model every score is null and
    every row is kept. Columns named like an added column are replaced.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import BooleanType, DoubleType, StructField, StructType

    docs = docs.drop("quality_score", "text_score", "meta_score", "keep")
    if model is None:
        none = F.lit(None).cast("double")
        return docs.select("*", none.alias("quality_score"), none.alias("text_score"), none.alias("meta_score"), F.lit(True).alias("keep"))
    spark = docs.sparkSession
    small_batches(spark)
    fixed = share(spark, model)
    schema = StructType([StructField("_row", docs.schema)] + [StructField(n, DoubleType()) for n in ("quality_score", "text_score", "meta_score")]
                        + [StructField("keep", BooleanType())])
    arrow = to_arrow_schema(schema)

    def work(batches):
        scanner, kinds, model = Scanner(space_table()), _kinds(), shared(fixed)
        for batch in batches:
            both, text, meta = model.scores(*_views(batch, scanner, kinds))
            row = batch.column("_row")
            yield pa.RecordBatch.from_arrays(
                [row.cast(arrow.field(0).type) if row.type != arrow.field(0).type else row,
                 pa.array(both, pa.float64()), pa.array(text, pa.float64()), pa.array(meta, pa.float64()), pa.array(both >= KEEP)], schema=arrow)

    rows = _inputs(docs, F.struct(*docs.columns).alias("_row")).mapInArrow(work, schema)
    return rows.select("_row.*", "quality_score", "text_score", "meta_score", "keep")
