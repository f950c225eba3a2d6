"""Language identification by cross-parsing.

For each language a suffix automaton of some labelled text is laid out as a
dense table. A text is cut greedily into the longest phrases that occur in the
language's text; phrases * log2(training length) / characters estimates the
cross entropy, and the language with the least wins. Very many stretches of
text walk their automata in step, one array operation per character; stretches
are ``stretch`` characters long, whole texts are parsed.

Training text is a bounded sample: for each language, parts from all over the
documents with the smallest hash in each of ``pieces`` buckets, up to
``train_chars`` characters together (less where the tables of many languages
would be larger than ``table_bytes``).

Each language has an alphabet of its own, its ``alphabet`` commonest letters;
its rarer letters share one symbol there, and a letter that its sample lacks
ends a phrase, so scripts don't take symbols from each other.

Edge cases: text that is null or has no letter is "und" with score 0, as is all
text when nothing was learnt; ties go to the smaller name; with one language
alone the score is 1.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, mapped


@dataclass(frozen=True)
class Spec:
    pieces: int = 48
    piece_chars: int = 4_000
    train_chars: int = 24_000
    #: Letters of a language that have a symbol each.
    alphabet: int = 100
    stretch: int = 512
    #: Stretches that a text longer than its share is sampled in.
    parts: int = 8
    #: Bytes of all tables together; many languages get shorter training texts.
    table_bytes: int = 120_000_000


_classes: list[np.ndarray] = []


def letters() -> np.ndarray:
    """Lower-cased code point of each letter, 0 for any other character."""
    if not _classes:
        table = np.zeros(0x110000, np.int32)
        for c in range(0x110000):
            x = chr(c)
            if x.isalpha():
                low = x.lower()
                table[c] = ord(low) if len(low) == 1 else c
        _classes.append(table)
    return _classes[0]


def folded(text: str) -> np.ndarray:
    """Lower-cased letters; each run of other characters is one 0."""
    points = letters()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    gap = points == 0
    return points[np.concatenate(([True], ~(gap[1:] & gap[:-1])))] if len(points) else points


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the automaton of all substrings; state 0 is the start."""
    step: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in symbols:
        new = len(step)
        step.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = new
            p = link[p]
        if p >= 0:
            q = step[p][c]
            if length[p] + 1 == length[q]:
                link[new] = q
            else:
                twin = len(step)
                step.append(dict(step[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and step[p].get(c) == q:
                    step[p][c] = twin
                    p = link[p]
                link[q] = link[new] = twin
        last = new
    return step


def spread(points: np.ndarray, n: int, parts: int) -> list[np.ndarray]:
    """About n of the points, as stretches evenly placed over them; all as one if there are no more."""
    if len(points) <= n:
        return [points]
    size = -(-n // parts)
    return [points[i : i + size] for i in np.linspace(0, len(points) - size, parts).astype(int).tolist()]


@dataclass
class Model:
    names: list[str]
    #: Sorted lower-case letters of all languages with symbols 1 and up; 0 is a gap, then comes any other letter, then padding.
    alphabet: np.ndarray
    tables: list[np.ndarray] = field(default_factory=list)
    sizes: list[int] = field(default_factory=list)
    stretch: int = 512
    #: For each language, the column of its table for each symbol.
    columns: list[np.ndarray] = field(default_factory=list)

    def symbols(self, points: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.alphabet, points), max(0, len(self.alphabet) - 1))
        known = self.alphabet[at] == points if len(self.alphabet) else np.zeros(len(points), bool)
        return np.where(points == 0, 0, np.where(known, at + 1, len(self.alphabet) + 1))

    def symbol_table(self) -> np.ndarray:
        """Symbol of each lower-case code point."""
        table = np.full(0x110000, len(self.alphabet) + 1, np.int32)
        table[0] = 0
        table[self.alphabet] = np.arange(1, len(self.alphabet) + 1)
        return table

    def learn(self, name: str, symbols: np.ndarray, letters: int = 100) -> None:
        """States are numbered by the place of their row. A missing transition holds the complement of where the next phrase goes on.

        Columns: gap, the commonest symbols, rarer ones together, those that the text lacks, padding.
        """
        last = len(self.alphabet) + 2
        counts = np.bincount(symbols, minlength=last)[1:last]
        ranked = np.argsort(-counts, kind="stable")
        own = np.sort(ranked[: min(letters, int((counts > 0).sum()))]) + 1
        width = len(own) + 4
        column = np.full(last + 1, width - 2, np.int32)
        column[1:last][counts > 0] = width - 3
        column[own] = np.arange(1, len(own) + 1)
        column[0], column[last] = 0, width - 1
        step = suffix_automaton(column[symbols].tolist())
        first = np.full(width, -1, np.int32)
        for c, s in step[0].items():
            first[c] = ~(s * width)
        table = np.tile(first, (len(step), 1))
        for s, out in enumerate(step):
            for c, t in out.items():
                table[s, c] = t * width
        table[:, width - 1] = np.arange(len(step)) * width
        self.names.append(name)
        self.tables.append(table.ravel())
        self.sizes.append(len(symbols))
        self.columns.append(column)

    def phrases(self, columns: np.ndarray) -> np.ndarray:
        """Phrases in each column of symbols (padded below), a row for each language."""
        out = np.empty((len(self.names), columns.shape[1]), np.int64)
        for i, (table, column) in enumerate(zip(self.tables, self.columns, strict=True)):
            state = np.zeros(columns.shape[1], np.int32)
            count = np.ones(columns.shape[1], np.int32)
            for row in columns:
                state += column.take(row)
                state = table.take(state)
                sign = state >> 31
                count -= sign
                state ^= sign
            out[i] = count
        return out


def fit(docs: DataFrame, spec: Spec = Spec(), key: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    """The model of docs(doc_id, text, lang); rows without language or text don't count."""
    rows = docs.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t"), F.col(lang).cast("string").alias("l")).filter("t is not null and l is not null")
    n, size = F.length("t"), spec.piece_chars // spec.parts
    # Long texts travel as evenly placed parts.
    places = F.transform(F.sequence(F.lit(0), F.lit(spec.parts - 1)), lambda i: F.substring("t", (1 + F.floor(i * (n - size) / max(1, spec.parts - 1))).cast("int"), F.lit(size)))
    sampled = F.when(n <= spec.piece_chars, F.array("t")).otherwise(places)
    ranked = rows.select("l", F.pmod(F.xxhash64("k", F.lit(1)), F.lit(spec.pieces)).alias("bucket"), F.struct(F.xxhash64("k"), F.xxhash64("t")).alias("h"), sampled.alias("t"))
    picked = ranked.groupBy("l", "bucket").agg(F.min_by("t", "h").alias("t"), F.min("h").alias("h")).collect()  # at most ``pieces`` rows of a language
    by_lang: dict[str, list] = {}
    for r in sorted(picked, key=lambda r: (r.l, r.bucket)):
        by_lang.setdefault(r.l, []).append([folded(t) for t in r.t])
    every = [p for docs in by_lang.values() for parts in docs for p in parts]
    model = Model([], np.unique(np.concatenate([p[p > 0] for p in every])).astype(np.int64) if every else np.empty(0, np.int64), stretch=spec.stretch)
    width = min(spec.alphabet, len(model.alphabet)) + 4
    chars = min(spec.train_chars, max(500, spec.table_bytes // (8 * width * max(1, len(by_lang)))))
    for name, texts in sorted(by_lang.items()):
        per = chars // len(texts) + 1
        # A text's share comes from all of its parts alike.
        kept = [q for parts in texts for p in parts for q in spread(p, -(-per // len(parts)), 1 if len(parts) > 1 else spec.parts)]
        symbols = np.concatenate([np.append(model.symbols(p), 0) for p in kept])
        if (symbols > 0).any():
            model.learn(name, symbols, spec.alphabet)
    return model


class Identifier:
    def __init__(self, model: Model):
        self.model = model
        self.table = model.symbol_table()[letters()]  # straight from a character to its symbol

    def of(self, texts: list[str | None]) -> Iterator[tuple[str, float]]:
        for start, end in chunks(texts):
            yield from self._of(texts[start:end])

    def _of(self, texts: list[str | None]) -> list[tuple[str, float]]:
        m, n = self.model, self.model.stretch
        found, owner, sizes = [], [], []
        out: list[tuple[str, float]] = [("und", 0.0)] * len(texts)
        for i, t in enumerate(texts):
            s = self.table[np.frombuffer((t or "").encode("utf-32-le", "surrogatepass"), np.uint32)]
            if not s.any():
                continue
            gap = s == 0
            s = s[np.concatenate(([True], ~(gap[1:] & gap[:-1])))]
            owner.append(i)
            sizes.append(len(s))
            found.append(np.append(s, np.full(-len(s) % n, len(m.alphabet) + 2, np.int32)))
        if not found or not m.names:
            return out
        rows = np.concatenate(found).reshape(-1, n)
        many = m.phrases(np.ascontiguousarray(rows.T))
        ends = np.cumsum([len(x) // n for x in found])
        total = np.add.reduceat(many, np.concatenate(([0], ends[:-1])), axis=1)
        bits = total * np.log2(np.array(m.sizes))[:, None] / np.array(sizes)
        order = np.argsort(bits, axis=0, kind="stable")
        for j, i in enumerate(owner):
            best = order[0, j]
            score = 1.0 - bits[best, j] / bits[order[1, j], j] if len(m.names) > 1 else 1.0
            out[i] = (m.names[best], float(score))
        return out


def predictions(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, lang_pred, score of every document."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        identify = Identifier(sent.value)
        for b in batches:
            made = list(identify.of(b.column(1).to_pylist()))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x[0] for x in made], pa.string()), pa.array([x[1] for x in made], pa.float64())], ["doc_id", "lang_pred", "score"])

    return docs.select(F.col(key).cast("long"), F.col(text).cast("string")).transform(mapped, run, "doc_id long, lang_pred string, score double")
