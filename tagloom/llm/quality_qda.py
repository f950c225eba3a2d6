"""Quality classifier: regularised quadratic discriminant over document statistics.

Each document becomes a vector of transformed statistics of its whole text. For
either class the mean and a covariance shrunk towards the pooled diagonal are
estimated from a bounded sample; the Cholesky factor of each covariance is kept,
and a score is the logistic of the difference of log densities (Mahalanobis
terms and log determinants) plus the log of the class ratio.

Edge cases: null and empty texts have the statistics of an empty text and get a
score as any other; if the sample lacks a class, the score is 1 or 0 for the
class it has, and 0.5 if it is empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, mapped

#: Characters that prose hardly has.
SYMBOLS = "#*$%&|<>{}[]\\^~=+_@"
LOWER, UPPER, DIGIT, SPACE, BREAK, SYMBOL, STOP, LOUD, OTHER = range(9)
FEATURES = 12

_table: list[np.ndarray] = []


def classes() -> np.ndarray:
    """Character class of each code point."""
    if not _table:
        t = np.full(0x110000, OTHER, np.uint8)
        for c in range(0x110000):
            x = chr(c)
            if x.isalpha():
                t[c] = UPPER if x.isupper() else LOWER
            elif x.isdigit():
                t[c] = DIGIT
            elif x.isspace():
                t[c] = BREAK if x == "\n" else SPACE
        for x in SYMBOLS:
            t[ord(x)] = SYMBOL
        for x in ".,;:'-":
            t[ord(x)] = STOP
        for x in "!?":
            t[ord(x)] = LOUD
        _table.append(t)
    return _table[0]


def statistics(text: str) -> list[float]:
    """Transformed statistics of one text; shares under a square root, counts under a logarithm."""
    kinds = classes()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    n = np.bincount(kinds, minlength=9).astype(float)
    words = text.split()
    lines = [x for x in text.split("\n") if x.strip()]
    chars = max(1.0, n.sum() - n[SPACE] - n[BREAK])
    count = max(1, len(words))
    share = lambda x, of=chars: float(x / of) ** 0.5
    distinct = len(set(words))
    again = sum(a == b for a, b in zip(words, words[1:], strict=False))
    # Long texts repeat words by themselves: compare with a power law.
    variety = np.log((distinct + 1) / (count + 1) ** 0.75)
    return [
        float(np.log1p(len(words))), float(np.log1p(chars / count)), share(n[SYMBOL]), share(n[UPPER]), share(n[DIGIT]), share(n[LOUD]),
        share(n[STOP]), share(n[OTHER]), float(variety), share(again, count), share(len(lines) - len(set(lines)), max(1, len(lines))), share(sum(len(w) == 1 and not w.isalnum() for w in words), count),
    ]


@dataclass
class Model:
    mean: list[np.ndarray]
    #: Cholesky factors of the covariances, and half their log determinants.
    factor: list[np.ndarray]
    half_logdet: list[float]
    log_prior: float
    #: The score of everything, if there was nothing to compare.
    constant: float | None = None

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 for each row."""
        if self.constant is not None:
            return np.full(len(x), self.constant)
        density = []
        for mean, factor, half in zip(self.mean, self.factor, self.half_logdet, strict=True):
            z = np.linalg.solve(factor, (x - mean).T)
            density.append(-0.5 * (z * z).sum(0) - half)
        return 1 / (1 + np.exp(-np.clip(density[1] - density[0] + self.log_prior, -40, 40)))


def fit_arrays(x: np.ndarray, y: np.ndarray, shrink: float = 0.15) -> Model:
    if not len(y) or y.min() == y.max():
        return Model([], [], [], 0.0, 0.5 if not len(y) else float(y[0]))
    pooled = np.diag(sum(((x[y == k] - x[y == k].mean(0)) ** 2).sum(0) for k in (0, 1)) / len(y)) + 1e-4 * np.eye(x.shape[1])
    mean, factor, half = [], [], []
    for k in (0, 1):
        own = x[y == k]
        mean.append(own.mean(0))
        centred = own - mean[-1]
        weight = max(shrink, 1 / (1 + len(own) / x.shape[1]))  # few rows lean on the pooled diagonal
        cov = (1 - weight) * centred.T @ centred / len(own) + weight * pooled
        factor.append(np.linalg.cholesky(cov))
        half.append(float(np.log(np.diag(factor[-1])).sum()))
    return Model(mean, factor, half, float(np.log(y.mean() / (1 - y.mean()))))


def _vectors(texts: list[str | None]) -> np.ndarray:
    return np.array([statistics(t or "") for t in texts], float).reshape(-1, FEATURES)


def fit(sample: DataFrame, shrink: float = 0.15) -> Model:
    """The model of a bounded sample (id, text, label); only its statistics reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _vectors(b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(list(x), pa.list_(pa.float64()))], ["id", "label", "x"])

    rows = sorted(sample.select("id", "text", "label").transform(mapped, run, "id long, label int, x array<double>").collect(), key=lambda r: (r.id, r.x))
    return fit_arrays(np.array([r.x for r in rows], float).reshape(-1, FEATURES), np.array([r.label for r in rows], int), shrink)


def scores(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, score, predicted of every document."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).to_pylist()
            s = np.concatenate([sent.value.scores(_vectors(texts[i:j])) for i, j in chunks(texts)] or [np.empty(0)])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s, pa.float64()), pa.array((s >= 0.5).astype(np.int32), pa.int32())], ["doc_id", "score", "predicted"])

    return docs.select(F.col(key).cast("long"), F.col(text).cast("string")).transform(mapped, run, "doc_id long, score double, predicted int")
