"""A quality classifier from trusted positives and unlabelled text: non-negative unbiased risk."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from tillstream.llm.batches import byte_class, mix, slices, spaced_words, text_bytes
from tillstream.llm.language import held_out

ACCEPT = 0.7  # documents with this score or more are good
SAMPLE = 5_000  # positives, and as many unlabelled texts, that the classifier is fitted on, about
HIDDEN, STEPS, RATE, DECAY, SEED = 24, 400, 0.02, 1e-4, 5
# Classes of bytes: letters, marks and so on. Their shares and the shares of their successions describe a text.
CLASSES = [
    byte_class((0x61, 0x7A)), byte_class((0x41, 0x5A)), byte_class((0x30, 0x39)), byte_class((0x80, 0xFF)), byte_class((0x20, 0x20)),
    byte_class((0x09, 0x0D)), byte_class((0x2E, 0x2E), (0x2C, 0x2C), (0x3B, 0x3B), (0x3A, 0x3A)), byte_class((0x21, 0x21), (0x3F, 0x3F)),
    byte_class((0x22, 0x22), (0x27, 0x29), (0x2D, 0x2D)),
]
N_CLASSES = len(CLASSES) + 1  # the last: all other bytes
N_FEATURES = 1 + N_CLASSES * (N_CLASSES + 1) + 8


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of the rows' values."""
    ahead = np.concatenate(([0.0], np.cumsum(values, dtype=np.float64)))
    return ahead[bounds[1:]] - ahead[bounds[:-1]]


def _repeated(hashes: np.ndarray, weights: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """For each row the weight of hashes that stand in the row a second time or later."""
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    tagged = hashes ^ mix(row)
    order = np.argsort(tagged, kind="stable")
    again = np.zeros(len(hashes))
    again[order[1:]] = tagged[order[1:]] == tagged[order[:-1]]
    return _sums(again * weights, bounds)


class Features:
    """Numbers that describe the style of a text: no word of it counts for itself, so they hold for any language."""

    def __init__(self):
        self.kind = np.full(256, N_CLASSES - 1, np.uint8)
        for i, members in enumerate(CLASSES):
            self.kind[members] = i
        self.words = spaced_words()
        self.lines = type(self.words)(~byte_class((0x0A, 0x0A), (0x0D, 0x0D)))

    def of(self, raw: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        n_rows, kinds = len(bounds) - 1, N_CLASSES
        size = np.diff(bounds)
        kind = self.kind[raw]
        codes = kind[:-1] * np.uint8(kinds) + kind[1:]  # below 100: a byte for each pair of neighbours
        single, double = np.zeros((n_rows, kinds)), np.zeros((n_rows, kinds * kinds))
        for i, (a, b) in enumerate(zip(bounds.tolist(), bounds[1:].tolist(), strict=False)):
            single[i] = np.bincount(kind[a:b], minlength=kinds)
            double[i] = np.bincount(codes[a : max(a, b - 1)], minlength=kinds * kinds)
        single /= np.maximum(size, 1)[:, None]
        double /= np.maximum(size - 1, 1)[:, None]
        starts, ends, firsts = self.words.find(raw, bounds)
        hashes, count = self.words.hashes(raw, starts, ends), np.diff(firsts)
        many = np.maximum(count, 1)
        follows = np.zeros(len(hashes))
        follows[1:] = hashes[1:] == hashes[:-1]
        follows[firsts[:-1][count > 0]] = 0
        length = (ends - starts).astype(np.float64)
        first = kind[starts]
        lone = (length == 1) & (first > 3)
        l_starts, l_ends, l_firsts = self.lines.find(raw, bounds)
        l_hashes = self.lines.hashes(raw, l_starts, l_ends)
        mean = _sums(length, firsts) / many
        extra = np.stack(
            [
                np.log1p(count), mean, np.sqrt(np.maximum(_sums(length * length, firsts) / many - mean * mean, 0)),
                _sums(follows, firsts) / many, _repeated(hashes, np.ones(len(hashes)), firsts) / many, _sums(lone, firsts) / many,
                _sums(first == 1, firsts) / many,
                _repeated(l_hashes, (l_ends - l_starts).astype(np.float64), l_firsts) / np.maximum(size, 1),
            ],
            axis=1,
        )
        return np.concatenate([np.log1p(size)[:, None], np.sqrt(single), np.sqrt(double), extra], axis=1)


class Classifier:
    """A network with one hidden layer, fitted by non-negative positive-unlabelled risk with the logistic loss."""

    def __init__(self, positive: np.ndarray, unlabelled: np.ndarray, prior: float):
        both = np.concatenate([positive, unlabelled])
        self.middle = both.mean(0) if len(both) else np.zeros(N_FEATURES)
        self.scale = 1 / (both.std(0) + 0.01) if len(both) else np.ones(N_FEATURES)
        self.prior = prior
        draw = np.random.default_rng(SEED)
        self.w = [draw.normal(0, N_FEATURES**-0.5, (N_FEATURES, HIDDEN)), np.zeros(HIDDEN), draw.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]
        if len(positive) and len(unlabelled):
            self._fit(self._scaled(positive), self._scaled(unlabelled))

    def _scaled(self, x):
        return np.clip((x - self.middle) * self.scale, -8, 8)

    def _forward(self, x):
        hidden = np.tanh(x @ self.w[0] + self.w[1])
        return hidden, hidden @ self.w[2] + self.w[3][0]

    def _back(self, x, hidden, slope):
        inner = np.outer(slope, self.w[2]) * (1 - hidden * hidden)
        return [x.T @ inner, inner.sum(0), hidden.T @ slope, np.asarray([slope.sum()])]

    def _fit(self, p, u):
        moment, square = [np.zeros_like(w) for w in self.w], [np.zeros_like(w) for w in self.w]
        for step in range(1, STEPS + 1):
            hp, gp = self._forward(p)
            hu, gu = self._forward(u)
            sp, su = 1 / (1 + np.exp(-gp)), 1 / (1 + np.exp(-gu))
            as_negative = np.logaddexp(0, gu).mean() - self.prior * np.logaddexp(0, gp).mean()
            # Positives taken as positive, and the negatives' share of the unlabelled taken as negative; where the latter's
            # estimate has fallen below zero, it is raised instead.
            of_u, of_p = su / len(u), -self.prior * sp / len(p)
            if as_negative >= 0:
                slope_p, slope_u = self.prior * (sp - 1) / len(p) + of_p, of_u
            else:
                slope_p, slope_u = -of_p, -of_u
            grads = [a + b for a, b in zip(self._back(p, hp, slope_p), self._back(u, hu, slope_u), strict=True)]
            for i, grad in enumerate(grads):
                grad = grad + DECAY * self.w[i]
                moment[i] = 0.9 * moment[i] + 0.1 * grad
                square[i] = 0.999 * square[i] + 0.001 * grad * grad
                self.w[i] = self.w[i] - RATE * (moment[i] / (1 - 0.9**step)) / (np.sqrt(square[i] / (1 - 0.999**step)) + 1e-8)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self._forward(self._scaled(x))[1], -50, 50)))


def features(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns and the texts' features; a null text counts as empty."""
    from pyspark.sql.types import ArrayType, FloatType

    schema = docs.select(*keep).schema.add("features", ArrayType(FloatType()))

    def run(batches):
        make = Features()
        for whole in batches:
            for batch in slices(whole, "__text"):
                x = make.of(*text_bytes(batch.column("__text"))).astype(np.float32)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, N_FEATURES), pa.int32()), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], lists], names=schema.names)

    return docs.select(*keep, docs[text].alias("__text")).mapInArrow(run, schema)


def fit(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> Classifier:
    """A classifier from ``labels`` (doc_id, quality) and ``docs`` (doc_id, text), without any held-out row.

    Trusted positives are the documents all of whose labels are 1; unlabelled ones have no label. About ``size`` of each
    are chosen by a hash of their id, and only their features come to the driver. The class prior is the share of positives
    among the labelled documents. Without positives or without unlabelled texts every score is that of an unfitted network.
    """
    marked = (
        labels.where(~held_out(F.col("doc_id")) & F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id").agg(F.min("quality").alias("quality"))
    )
    n = marked.agg(F.sum((F.col("quality") == 1).cast("long")).alias("good"), F.count("*").alias("all")).first()
    good, prior = n["good"] or 0, (n["good"] or 0) / max(n["all"], 1)
    draw = lambda share: F.pmod(F.xxhash64(F.lit("quality"), "doc_id"), F.lit(1_000_000)) < 1_000_000 * min(1.0, share)
    ids = marked.where((F.col("quality") == 1) & draw(size / max(good, 1))).select("doc_id", F.lit(True).alias("positive"))
    rest = max(docs.count() - n["all"], 1)
    known = labels.where(F.col("quality").isNotNull()).select("doc_id").distinct()
    others = docs.select("doc_id").where(~held_out(F.col("doc_id")) & draw(size / rest)).join(known, "doc_id", "left_anti")
    chosen = ids.union(others.distinct().withColumn("positive", F.lit(False)))
    texts = docs.select("doc_id", "text").where(~held_out(F.col("doc_id")))
    # ``chosen`` has about 2 * size ids: a bound of its own, not one of the input's.
    sample = features(texts.join(F.broadcast(chosen), "doc_id"), keep=("doc_id", "positive")).orderBy("doc_id").toPandas()
    rows = np.stack(sample["features"].to_numpy()) if len(sample) else np.zeros((0, N_FEATURES))
    positive = sample["positive"].to_numpy(bool)
    return Classifier(rows[positive].astype(float), rows[~positive].astype(float), prior)


def score(docs: DataFrame, model: Classifier, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Adds ``score``, the estimated probability of label 1 for each whole text, to the ``keep`` columns.

    Equal texts have equal scores; null counts as empty.
    """
    schema = docs.select(*keep).schema.add("score", DoubleType())
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        make = Features()
        for whole in batches:
            for batch in slices(whole, "__text"):
                result = shared.value.score(make.of(*text_bytes(batch.column("__text"))))
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(result, pa.float64())], names=schema.names)

    return docs.select(*keep, docs[text].alias("__text")).mapInArrow(run, schema)
