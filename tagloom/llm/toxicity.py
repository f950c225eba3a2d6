"""Toxicity: a weighted lexicon matched by Aho-Corasick on folded text.

Folding lower-cases, takes accents off, and maps homoglyphs of other scripts
and digits or signs that stand for letters to plain letters. The lexicon is
learnt from a bounded sample: words, and beginnings of words (for compounds),
that labelled texts have far more often if toxic. Of
matches at the beginning of one word the heaviest counts; matches within an
exception phrase don't count. The sum of weights, its density per word and the
heaviest weight are combined by a logistic function, fitted on the same sample.

Edge cases: null and empty texts match nothing and get the score of that;
without labels of both kinds there are no terms, so all texts get that score.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mapped

#: Phrases in which a term is harmless, look-alike letters and signs.
EXCEPTIONS = ("trash can", "trash bin", "trash bag", "class clown", "clown fish", "stupid question", "no such thing as a stupid", "sore loser")
LOOKALIKES = "аaеeоoрpсcуyхxіiѕsјjԁdһhοoαaιiνvρpτtυuкkмmтtвbнhөo"
SIGNS = "0o1i3e4a5s7t8b@a$s"


def _fold_table() -> dict[int, str]:
    table: dict[int, str] = {}
    for c in range(0xC0, 0x250):
        base = unicodedata.normalize("NFKD", chr(c))[0].lower()
        if base.isascii() and base.isalpha():
            table[c] = base
    for c in range(0xFF21, 0xFF5B):  # full width
        base = unicodedata.normalize("NFKC", chr(c)).lower()
        if base.isascii() and base.isalpha():
            table[c] = base
    table |= {c: "" for c in (*range(0x300, 0x370), 0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF)}  # marks and invisible characters
    return table | {ord(a): b for a, b in zip(LOOKALIKES[::2], LOOKALIKES[1::2], strict=True)} | {ord(a): b for a, b in zip(SIGNS[::2], SIGNS[1::2], strict=True)}


FOLD = _fold_table()


def fold(text: str | None) -> str:
    return (text or "").lower().translate(FOLD)


def words(folded: str) -> list[str]:
    """Words of folded text, without what isn't a letter at either end."""
    return [w for x in folded.split() if (w := x.strip(" .,;:!?\"'()[]{}<>*#%&|-_/\\~^+=`"))]


@dataclass(frozen=True)
class Spec:
    #: Lengths of the beginnings of words that may become terms.
    stems: tuple[int, ...] = (4, 5, 6, 7)
    #: Toxic documents of the sample that must have a term; least log odds; most learnt terms.
    least_support: int = 4
    least_weight: float = 2.5
    max_terms: int = 5_000


@dataclass
class Model:
    #: Term to weight; a trailing * marks the beginning of a word.
    terms: dict[str, float]
    #: Intercept and weights of log(1 + sum), log(1 + 100 * sum / words) and the heaviest weight.
    logistic: tuple[float, ...] = (-3.0, 2.0, 1.0, 0.0)


class Matcher:
    def __init__(self, model: Model):
        self.model, self.machine = model, ahocorasick.Automaton()
        merged: dict[str, list[float]] = {}
        for term, weight in model.terms.items():
            merged.setdefault(term.rstrip("*"), [0.0, 0.0])[term.endswith("*")] = weight
        for phrase in EXCEPTIONS:
            merged.setdefault(phrase, [0.0, 0.0])
        for term, (whole, stem) in merged.items():
            self.machine.add_word(term, (len(term), whole, stem, term in EXCEPTIONS))
        self.machine.make_automaton()

    def sums(self, text: str | None) -> tuple[float, int, float]:
        """Sum of weights, number of words, heaviest weight."""
        t = fold(text)
        found: dict[int, float] = {}
        spared: list[tuple[int, int]] = []
        for end, (n, whole, stem, exception) in self.machine.iter(t):
            start = end - n + 1
            if start and t[start - 1].isalpha():
                continue
            closed = end + 1 == len(t) or not t[end + 1].isalpha()
            if exception:
                if closed:
                    spared.append((start, end))
            elif (weight := max(whole, stem) if closed else stem) > found.get(start, 0.0):
                found[start] = weight
        for a, b in spared:
            for s in [s for s in found if a <= s <= b]:
                del found[s]
        return sum(found.values()), len(t.split()), max(found.values(), default=0.0)

    def features(self, texts: list[str | None]) -> np.ndarray:
        sums = np.array([self.sums(t) for t in texts], float).reshape(-1, 3)
        return np.stack((np.ones(len(sums)), np.log1p(sums[:, 0]), np.log1p(100 * sums[:, 0] / np.maximum(1, sums[:, 1])), sums[:, 2]), 1)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.features(texts) @ np.array(self.model.logistic), -40, 40)))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 50) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the first column is the intercept."""
    w = np.zeros(x.shape[1])
    penalty = ridge * np.eye(x.shape[1])
    penalty[0, 0] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def terms_of(text: str | None, spec: Spec) -> set[str]:
    """What of a text may become a term: its words, and their beginnings marked with *."""
    own = {w for w in words(fold(text)) if 3 <= len(w) <= 40}
    return own | {w[:k] + "*" for w in own for k in spec.stems if len(w) > k}


def _terms(sample: DataFrame, spec: Spec) -> DataFrame:
    """(term, toxic, clean): documents of either kind with each term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            terms, labels = [], []
            for text, label in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                terms += (own := terms_of(text, spec))
                labels += [label] * len(own)
                if len(terms) > 50_000:
                    yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), pa.array(labels, pa.int32())], ["term", "label"])
                    terms, labels = [], []
            yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), pa.array(labels, pa.int32())], ["term", "label"])

    each = sample.select("text", "label").transform(mapped, run, "term string, label int")
    return each.groupBy("term").agg(F.sum("label").cast("double").alias("toxic"), F.sum(1 - F.col("label")).cast("double").alias("clean"))


def fit(sample: DataFrame, spec: Spec = Spec()) -> Model:
    """The model of a bounded sample (id, text, label). At most ``max_terms`` terms, and three numbers of each document, reach the driver."""
    sizes = {r.label: r["count"] for r in sample.groupBy("label").count().collect()}
    terms: dict[str, float] = {}
    if len(sizes) < 2:
        return Model(terms)
    weight = F.log((F.col("toxic") + 0.5) / (sizes[1] + 1)) - F.log((F.col("clean") + 0.5) / (sizes[0] + 1))
    # The bound that chance alone would hardly pass: what toxic documents have beyond clean ones.
    ranked = _terms(sample, spec).filter(F.col("toxic") >= spec.least_support).withColumn("weight", weight).filter(F.col("weight") >= spec.least_weight)
    for r in ranked.orderBy(F.desc("weight"), F.desc("toxic"), "term").limit(spec.max_terms).collect():
        terms[r.term] = round(r.weight, 4)
    model = Model(terms)
    sent = sample.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(sent.value)
        for b in batches:
            x = matcher.features(b.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(x[:, 1]), pa.array(x[:, 2]), pa.array(x[:, 3]), b.column(1)], ["a", "b", "c", "label"])

    rows = sorted((r.a, r.b, r.c, r.label) for r in sample.select("text", "label").transform(mapped, run, "a double, b double, c double, label int").collect())
    data = np.array(rows, float)
    model.logistic = tuple(logistic(np.column_stack((np.ones(len(data)), data[:, :3])), data[:, 3]).tolist())
    return model


def scores(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, score, predicted of every document."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(sent.value)
        for b in batches:
            s = matcher.scores(b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s, pa.float64()), pa.array((s >= 0.5).astype(np.int32), pa.int32())], ["doc_id", "score", "predicted"])

    return docs.select(F.col(key).cast("long"), F.col(text).cast("string")).transform(mapped, run, "doc_id long, score double, predicted int")
