"""Quality scores by naive Bayes support vectors: n-gram indicators, scaled by class log-count ratios, in a linear hinge-loss model."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from xxhash import xxh64_intdigest

from voxtally.llm.common import bounded_sample
from voxtally.llm.shingles import mix

#: Buckets that n-grams are hashed into.
BUCKETS = 1 << 18
#: Labelled rows that the model is fitted on, at most (about).
FIT_ROWS = 8_000
SMOOTH = 1.0
COST = 0.1
EPOCHS = 30

_SHAPE = bytes(
    ord("A") if 65 <= i <= 90 else ord("a") if 97 <= i <= 122 or i >= 128 else ord("0") if 48 <= i <= 57 else i for i in range(256))
_RUN = re.compile(rb"(a)a+|(A)A+|(0)0+|([^aA0\s])\4+")
_BREAK = re.compile(rb"\s+")


def _ngrams(tokens: np.ndarray, most: int, salt: int) -> list[np.ndarray]:
    """Buckets of all n-grams up to `most` tokens."""
    out, gram = [], np.zeros(len(tokens), np.uint64)
    for n in range(1, most + 1):
        if len(tokens) < n:
            break
        gram = gram[: len(tokens) - n + 1] * np.uint64(0x9E3779B97F4A7C15) + tokens[n - 1 :]
        out.append((mix(gram + np.uint64(salt * 16 + n)) >> np.uint64(64 - 18)).astype(np.int32))
    return out


class Features:
    """n-gram indicators of a text, as sorted buckets.

    Three token sequences: the words in lower case (n-grams up to 2); their shapes, in which runs of
    small letters, capitals, digits or one sign shrink to one character (up to 3); and how often the
    word occurred among the last 8 words before (up to 2), which shows repetition.
    """

    def __init__(self) -> None:
        self._shapes: dict[bytes, int] = {}

    def _shape_id(self, token: bytes) -> int:
        known = self._shapes.get(token)
        if known is None:
            if len(self._shapes) > 100_000:
                self._shapes.clear()
            known = self._shapes[token] = xxh64_intdigest(token)
        return known

    def of(self, text: str | None) -> np.ndarray:
        raw = (text or "").encode("utf-8", "surrogatepass")
        words = raw.lower().split()
        n = len(words)
        if not n:
            return np.empty(0, np.int32)
        hashed = np.fromiter(map(xxh64_intdigest, words), np.uint64, n)
        shaped = _RUN.sub(rb"\1\2\3\4", raw.translate(_SHAPE)).split()
        shapes = np.fromiter(map(self._shape_id, shaped), np.uint64, len(shaped))
        again = np.zeros(n, np.uint64)
        for back in range(1, min(8, n - 1) + 1):
            again[back:] += hashed[back:] == hashed[:-back]
        return np.unique(np.concatenate(_ngrams(hashed, 2, 1) + _ngrams(shapes, 3, 2) + _ngrams(again, 2, 3)))


def log_count_ratios(features: list[np.ndarray], labels: np.ndarray, smooth: float = SMOOTH) -> np.ndarray:
    """ln of the smoothed share of each indicator in class 1 over that in class 0."""
    sums = [np.full(BUCKETS, smooth), np.full(BUCKETS, smooth)]
    for x, y in zip(features, labels):
        sums[int(y)][x] += 1
    return np.log(sums[1] / sums[1].sum()) - np.log(sums[0] / sums[0].sum())


def dual_coordinate_descent(
    features: list[np.ndarray], labels: np.ndarray, ratios: np.ndarray, cost: np.ndarray, epochs: int = EPOCHS, seed: int = 7,
) -> tuple[np.ndarray, float]:
    """Weights and bias of the L2-regularised hinge loss; one dual variable per row, in [0, its cost].

    Rows are unit vectors of ratios. A row is visited in random order, its variable moved to the
    optimum with all others fixed, and the weights follow; variables stuck at a bound leave the pass.
    """
    values = [ratios[x] / max(float(np.sqrt((ratios[x] ** 2).sum())), 1e-9) for x in features]
    sign = np.where(labels > 0, 1.0, -1.0)
    alpha, weights, bias = np.zeros(len(features)), np.zeros(BUCKETS), 0.0
    square = np.array([float((v * v).sum()) + 1.0 for v in values])
    draw = np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in draw.permutation(len(features)):
            x, v = features[i], values[i]
            gradient = sign[i] * (float(weights[x] @ v) + bias) - 1
            new = min(max(alpha[i] - gradient / square[i], 0.0), cost[i])
            step = (new - alpha[i]) * sign[i]
            if step:
                weights[x] += step * v
                bias += step
                moved = max(moved, abs(step))
                alpha[i] = new
        if moved < 1e-3:
            break
    return weights, bias


@dataclass
class QualityModel:
    weights: np.ndarray  # on indicators, ratios included
    ratios: np.ndarray
    bias: float
    slope: float
    offset: float


def _calibrate(margins: np.ndarray, labels: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Logistic slope and offset by Newton steps on class-balanced margins, so 0.5 lies between the classes."""
    weight = np.where(labels > 0, 0.5 / max(labels.sum(), 1), 0.5 / max((1 - labels).sum(), 1))
    target = np.where(labels > 0, 0.98, 0.02)
    a, b = 1.0, 0.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -30, 30)))
        g, h = weight * (p - target), weight * p * (1 - p)
        ga, gb = (g * margins).sum() + 1e-3 * (a - 1), g.sum()
        haa, hab, hbb = (h * margins**2).sum() + 1e-3, (h * margins).sum(), h.sum() + 1e-6
        det = haa * hbb - hab * hab
        a, b = a - (hbb * ga - hab * gb) / det, b - (haa * gb - hab * ga) / det
        a = min(max(a, 0.1), 50.0)
    return a, b


def train(features: list[np.ndarray], labels: np.ndarray, cost: float = COST) -> QualityModel:
    """Fit on rows in memory. Classes weigh alike; with one class or none every text scores 0.5 or that class."""
    labels = np.asarray(labels, dtype=np.int64)
    ratios = log_count_ratios(features, labels)
    counts = np.bincount(labels, minlength=2)
    if counts.min() == 0:
        sure = 0.0 if counts.sum() == 0 else 2.0 if counts[1] else -2.0
        return QualityModel(np.zeros(BUCKETS), ratios, 0.0, 0.0, sure)
    costs = cost * len(labels) / (2.0 * counts[labels])
    # Margins of rows that a model has not seen, by three folds, for the calibration.
    unseen, fold = np.zeros(len(labels)), np.arange(len(labels)) % 3
    for f in range(3):
        inside = [features[i] for i in np.flatnonzero(fold != f)]
        part = log_count_ratios(inside, labels[fold != f])
        w, b = dual_coordinate_descent(inside, labels[fold != f], part, costs[fold != f])
        for i in np.flatnonzero(fold == f):
            unseen[i] = _margin(features[i], part, w, b)
    slope, offset = _calibrate(unseen, labels)
    weights, bias = dual_coordinate_descent(features, labels, ratios, costs)
    return QualityModel(weights, ratios, bias, slope, offset)


def _margin(x: np.ndarray, ratios: np.ndarray, weights: np.ndarray, bias: float) -> float:
    r = ratios[x]
    norm = float(np.sqrt((r * r).sum()))
    return (float(weights[x] @ r) / norm if norm else 0.0) + bias


def score_one(x: np.ndarray, model: QualityModel) -> float:
    z = model.slope * _margin(x, model.ratios, model.weights, model.bias) + model.offset
    return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    features = Features()
    for batch in batches:
        found = [features.of(t.as_py()) for t in batch.column(0)]
        yield pa.record_batch([batch.column(1), pa.array(found, pa.list_(pa.int32()))], ["label", "grams"])


def _fitter(cost: float):
    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, labels = [], []
        for batch in batches:
            labels += batch.column(0).to_pylist()
            features += [np.asarray(g.values) for g in batch.column(1)]
        # The order of arrival is not fixed; the model is.
        order = sorted(range(len(labels)), key=lambda i: (labels[i], features[i].tobytes()))
        mixed = np.random.default_rng(11).permutation(order).astype(np.int64)
        m = train([features[i] for i in mixed], np.array([labels[i] for i in mixed]), cost)
        yield pa.record_batch(
            [pa.array([m.weights.tolist()]), pa.array([m.ratios.tolist()]), pa.array([m.bias]), pa.array([m.slope]), pa.array([m.offset])],
            ["weights", "ratios", "bias", "slope", "bound"])

    return fit


def fit_quality(
    docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
    fit_rows: int = FIT_ROWS, cost: float = COST,
) -> QualityModel:
    """Fit on about `fit_rows` labelled rows at most, chosen by a hash of the id.

    Labels other than 0 and 1 and null ids are left out. The chosen ids are few, so they are
    broadcast to pick their texts; n-grams are taken on all executors and the fit runs in one task
    on that bounded sample.
    """
    wanted = labels.where(F.col(label).isin(0, 1)).select(F.col(doc_id).alias("_id"), F.col(label).cast("bigint").alias("_label"))
    sample = bounded_sample(wanted, "_id", fit_rows)
    rows = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")).join(F.broadcast(sample), "_id")
    grams = rows.select("_text", "_label").mapInArrow(_extract, "label bigint, grams array<int>")
    fitted = grams.repartition(1).mapInArrow(
        _fitter(cost), "weights array<double>, ratios array<double>, bias double, slope double, bound double")
    row = fitted.toArrow()
    if row.num_rows == 0:
        return train([], np.empty(0, np.int64), cost)
    value = lambda name: row.column(name)[0]
    return QualityModel(
        np.asarray(value("weights").values), np.asarray(value("ratios").values), value("bias").as_py(), value("slope").as_py(), value("bound").as_py())


def score_quality(docs: DataFrame, model: QualityModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, score, predicted) per row: the score lies in 0 to 1, higher means class 1 is likelier.

    Only the text is read. Null and empty texts have no indicators and get the score of the bias
    alone; equal texts get equal scores.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, known = Features(), shared.value
        for batch in batches:
            scores = [score_one(features.of(t.as_py()), known) for t in batch.column(1)]
            yield pa.record_batch(
                [batch.column(0), pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32())],
                ["id", "score", "predicted"])

    return (docs.select(F.col(doc_id).cast("bigint").alias("id"), F.col(text).alias("text"))
                .mapInArrow(score, "id bigint, score double, predicted int").withColumnRenamed("id", doc_id))
