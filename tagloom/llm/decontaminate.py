"""Benchmark decontamination by question templates.

Tokens are canonicalised: numbers, units and names become typed placeholders,
other words lose case and outer punctuation; formulas are cut at their operators,
so that spaces in them make no difference. A capitalised word within a sentence is a
name. One that begins a sentence may be, so there are two typed forms: in one it
is a plain word, in the other a name, unless it is among the words that open questions and
sentences. Windows of eight canonical tokens of the benchmark are the
build side of a hash join with those of the documents. Whether a word is a name
depends on its capitals, so windows are joined by their plain tokens as well,
which have no placeholders and no case: copies in capitals, in title case, in
lower case or within a sentence are found by these. Hits of either kind that
lie on one alignment of document and item are one match. The original values in the
placeholders must correspond along a match: numbers may change, but the same
number in the same way (new values may be equal); values are compared without case. So verbatim
and re-parameterised copies are found, and look-alike templates with unrelated
values are not. A copy whose case and values both changed is found as far as its
names are still capitalised alike.

A document is contaminated by an item if a consistent match has a run of
``min_run`` tokens (the whole item if it is shorter), or consistent windows
make up half of the item's.

The build side is sent to the tasks, as sorted arrays, in blocks of a bounded
number of windows; a larger benchmark takes several passes.

Edge cases: null or empty texts match nothing; an item shorter than a window is
one window of its length; an item of one or two tokens says nothing within a
longer text, so it contaminates the documents that hold nothing else; repeated
rows each give their result; an item shorter than a window has no second typed
form; windows in which most tokens are placeholders have no typed
form (they would fit anything), so they count where they are copied literally.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mapped

from .hashing import windows

#: Units and number words.
UNITS = """kg mg km cm mm ml kb mb gb tb hz khz mhz ghz kw kwh mph kmh lb lbs oz ft inch inches meter meters metre metres
kilometer kilometers kilometre kilometres gram grams kilogram kilograms liter liters litre litres mile miles foot feet yard yards
pound pounds ounce ounces second seconds minute minutes hour hours day days week weeks month months year years
dollar dollars euro euros cent cents percent degree degrees watt watts volt volts""".split()
NUMBER_WORDS = """zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen
eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion""".split()
OPENERS = """a about after all although an and another any are as at because before both but by calculate can compute consider
could despite determine did do does during each either estimate evaluate every explain express few find first for from
give given has have he her here hers him his how however i if imagine in into is it its later let list many more most
much my name neither next no none not now of on once only or other our over per please prove select several she show
simplify since so solve some still such suppose than that the their them then there these they this those through
to today together under until use was we were what when where whether which while who whom whose why will with would
write yesterday yet you your""".split()
#: Where a formula is cut: at operators, at a minus or slash next to a digit or before a letter that stands alone.
OPERATOR = re.compile(r"[=+*<>^\u00d7\u00f7\u2212]+|(?<=\d)[-/](?=\w)|(?<=\w)[-/](?=\d)|(?<=\b\w)-(?=\w\b)")
NUMBER = re.compile(r"[+-]?\d[\d.,/:]*[^\W\d_]{0,3}")
UNITS, NUMBER_WORDS, OPENERS = map(frozenset, (UNITS, NUMBER_WORDS, OPENERS))
PLACEHOLDERS = ("\0number", "\0unit", "\0name")
NAME_HASH = xxhash.xxh3_64_intdigest(PLACEHOLDERS[2])
ENDS = (".", "!", "?", ":")
#: Tokens that a worker keeps.
CACHE_TOKENS = 300_000


@dataclass(frozen=True)
class Spec:
    window: int = 8
    #: Placeholders that a window may have.
    max_slots: int = 4
    min_run: int = 13
    #: Items with fewer tokens have no typed form; with fewer than ``min_inside`` they count only as the whole text of a document.
    min_typed: int = 4
    min_inside: int = 3
    share: float = 0.5
    #: Benchmark windows sent to the tasks at a time.
    block_windows: int = 1_000_000


def strip(token: str) -> str:
    """The token from its first to its last letter or digit."""
    if token.isalnum():
        return token
    i, j = 0, len(token)
    while i < j and not token[i].isalnum():
        i += 1
    while j > i and not token[j - 1].isalnum():
        j -= 1
    return token[i:j]


def cut(raw: str) -> list[str]:
    """A token's parts between operators; a token without, or an address, is one part."""
    if raw.isalpha() or "://" in raw or "@" in raw:
        return [raw]
    return [part for part in OPERATOR.split(raw) if part] or [raw]


class Canon:
    """Canonical tokens of a text, with a bounded cache by raw token."""

    def __init__(self):
        self._reset()

    def _reset(self) -> None:
        self.index: dict[str, int] = {}
        # By token: hash at the beginning of a sentence, elsewhere and without placeholders, placeholder at either place (bits),
        # sentence end, nothing left, whether it may be a name at the beginning of a sentence, whether it is several tokens.
        self.facts = [np.zeros(CACHE_TOKENS // 8, kind) for kind in (np.uint64, np.uint64, np.uint64, np.int8, bool, bool, bool, bool)]
        self.new: list[tuple] = []

    def _learn(self, raw: str) -> int:
        core = strip(raw)
        low = core.casefold()
        word = core.isalpha()
        plain = PLACEHOLDERS[0] if not word and NUMBER.fullmatch(core) or low in NUMBER_WORDS else PLACEHOLDERS[1] if low in UNITS else low
        named = plain is low and core[:1].isupper()
        h = xxhash.xxh3_64_intdigest(plain)
        self.new.append((h, NAME_HASH if named else h, h if plain is low else xxhash.xxh3_64_intdigest(low), 2 * named if plain is low else 3, raw.endswith(ENDS), not core, named and low not in OPENERS, not word and len(cut(raw)) > 1))
        i = self.index[raw] = len(self.index)
        return i

    def _ids(self, raw: list[str]) -> np.ndarray:
        get = self.index.get
        ids = np.array([i if (i := get(t)) is not None else self._learn(t) for t in raw], np.int64)
        if self.new:
            end = len(self.index)
            while end > len(self.facts[0]):
                self.facts = [np.concatenate((x, np.zeros_like(x))) for x in self.facts]
            for own, values in zip(self.facts, zip(*self.new, strict=True), strict=True):
                own[end - len(self.new) : end] = values
            self.new.clear()
        return ids

    def tokens(self, text: str | None) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """Hashes of the canonical tokens, whether each is a placeholder, and the raw tokens."""
        return self.forms(text)[:3]

    def forms(self, text: str | None) -> tuple[np.ndarray, np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
        """As ``tokens``, with the hashes of the plain tokens, and hashes and placeholders of the second typed form."""
        raw = (text or "").split()
        if len(self.index) > CACHE_TOKENS:
            self._reset()
        at = self._ids(raw)
        several = self.facts[7][at]
        if several.any():
            raw = [part for t, many in zip(raw, several.tolist(), strict=True) for part in (cut(t) if many else (t,))]
            at = self._ids(raw)
        first, inner, plain, slot, ends, empty, named, _ = self.facts
        if empty[at].any():
            kept = ~empty[at]
            raw = [t for t, k in zip(raw, kept.tolist(), strict=True) if k]
            at = at[kept]
        begins = np.ones(len(at), bool)
        begins[1:] = ends[at[:-1]]
        plainly = begins & ~named[at]
        first, inner, slot = first[at], inner[at], slot[at]
        one, two = (np.where(where, first, inner) for where in (begins, plainly))
        return one, np.where(begins, slot & 1, slot >> 1).astype(bool), raw, plain[at], two, np.where(plainly, slot & 1, slot >> 1).astype(bool)


class Probe:
    """The windows of a block of items, as sorted arrays that whole documents are looked up in. Built once, on the driver."""

    def __init__(self, items: list[tuple[int, str | None]], spec: Spec):
        canon, self.spec, self.items, self.seen = Canon(), spec, items, {}
        # Typed and plain windows share a table: without placeholders they are the same, with them no hash is both. With each goes whether it is plain.
        found: dict[int, list[tuple[np.ndarray, ...]]] = defaultdict(list)
        for n, (_, text) in enumerate(items):
            tokens, slots, _, plain, other, more = canon.forms(text)
            if not len(tokens):
                continue
            w = min(spec.window, len(tokens))
            literal = windows(plain, w)
            first = np.zeros(len(literal), np.uint64)
            for form, places in ((tokens, slots), (other, more)) if w == spec.window else ((tokens, slots),) if w >= spec.min_typed else ():
                whole = windows(form, w)
                q, h = self.usable(whole, places, w)
                typed = (h != literal[q]) & (h != first[q])
                first = whole
                found[w].append((h[typed], np.full(int(typed.sum()), n), q[typed], np.zeros(int(typed.sum()), bool)))
            found[w].append((literal, np.full(len(literal), n), np.arange(len(literal)), np.ones(len(literal), bool)))
        self.tables = {}
        for w, parts in found.items():
            keys, n, q, is_plain = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.argsort(keys, kind="stable")
            shift = 64 - min(24, max(16, int(16 * len(keys)).bit_length()))
            bits = np.zeros(1 << (64 - shift), bool)
            bits[(keys >> np.uint64(shift)).astype(np.int64)] = True
            self.tables[w] = (np.uint64(shift), bits, keys[order], n[order].astype(np.int32), q[order].astype(np.int32), is_plain[order])

    def usable(self, hashes: np.ndarray, slots: np.ndarray, w: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts and hashes of windows with few enough placeholders."""
        sums = np.concatenate(([0], np.cumsum(slots)))
        ok = np.flatnonzero(sums[w:] - sums[:-w] <= min(self.spec.max_slots, w // 2)) if len(hashes) else np.empty(0, np.int64)
        return ok, hashes[ok]

    def item(self, n: int, canon: Canon) -> tuple[int, np.ndarray, list[str], int, np.ndarray]:
        """Number of tokens, placeholders, raw tokens, window and placeholders of either form of an item that was met."""
        if n not in self.seen:
            if len(self.seen) > 2_000:
                self.seen.clear()
            _, slots, raw, _, _, more = canon.forms(self.items[n][1])
            self.seen[n] = (len(raw), slots, raw, min(self.spec.window, len(raw)), more)
        return self.seen[n]

    def matches(self, canon: Canon, text: str | None) -> list[tuple[int, int, float, int]]:
        """(item, consistent windows, their share of the item's, changed slots) for each item that contaminates the text."""
        tokens, slots, raw, plain, other, more = canon.forms(text)
        forms = [tokens] + [plain] * bool(slots.any()) + [other] * bool((more != slots).any())
        lines: dict[tuple[int, int], tuple[set[int], set[int]]] = defaultdict(lambda: (set(), set()))
        for w, (shift, bits, keys, ns, qs, is_plain) in self.tables.items():
            if w < self.spec.min_inside and w != len(tokens):
                continue
            for form in forms if w == self.spec.window else forms[: 1 + bool(slots.any())]:
                h = windows(form, w)
                at = np.flatnonzero(bits[(h >> shift).astype(np.int64)])
                low, high = np.searchsorted(keys, h[at], "left"), np.searchsorted(keys, h[at], "right")
                for k in np.flatnonzero(low < high).tolist():
                    for j in range(low[k], high[k]):
                        lines[int(ns[j]), int(at[k]) - int(qs[j])][int(is_plain[j])].add(int(qs[j]))
        # The typed hits beside the plain ones, and by themselves: plain hits come first, and values of theirs can rule out typed ones.
        good: dict[tuple[int, bool], tuple[set[int], int, int]] = {}
        for (n, shift), (typed, literal) in lines.items():
            facts = self.item(n, canon)
            beside = self._consistent(facts, shift, sorted(typed), slots, raw, literal)
            alone = beside if len(beside[0]) == len(typed | literal) else self._consistent(facts, shift, sorted(typed | self._bare(facts, literal)), slots, raw)
            for way, (kept, changed) in ((True, beside), (False, alone)):
                if kept:
                    before = good.get((n, way), (set(), 0, 0))
                    good[n, way] = (before[0] | kept, max(before[1], self._run(kept, facts[3])), max(before[2], changed))
        out: dict[int, tuple[int, int, float, int]] = {}
        for (n, _), (kept, run, changed) in good.items():
            size, _, _, w, _ = self.item(n, canon)
            share = len(kept) / (size - w + 1)
            if (run >= min(self.spec.min_run, size) or share >= self.spec.share) and (n not in out or out[n][1] < len(kept)):
                out[n] = (self.items[n][0], len(kept), share, changed)
        return list(out.values())

    @staticmethod
    def _bare(facts: tuple, starts: set[int]) -> set[int]:
        """Those of an item's windows that have no placeholders."""
        _, slots, _, w, _ = facts
        return {q for q in starts if not slots[q : q + w].any()}

    @staticmethod
    def _consistent(facts: tuple, shift: int, starts: list[int], slots: np.ndarray, raw: list[str], literal: set[int] | frozenset[int] = frozenset()) -> tuple[set[int], int]:
        """Windows along an alignment whose placeholders correspond: each value of the item stands for one value of the text. And how many values differ.

        Each value of the item is bound to what most of its places in these windows hold (the first of equals), so one
        chance pair rules out its own windows alone. Literal windows all count, and their values stand for themselves.
        """
        _, _, its_raw, w, its_slots = facts
        places = sorted({i for q in starts if q not in literal for i in range(q, q + w) if its_slots[i]})
        pairs = {i: (strip(its_raw[i]).casefold(), strip(raw[i + shift]).casefold()) for i in places}
        bound: dict[str, str] = {}
        for (a, b), _ in Counter(pairs.values()).most_common():
            bound.setdefault(a, b)
        for a in {strip(its_raw[i]).casefold() for q in literal for i in range(q, q + w) if its_slots[i]}:
            bound[a] = a
        kept, changed = set(literal), set()
        for q in starts:
            own = [pairs[i] for i in range(q, q + w) if i in pairs] if q not in literal else []
            if all(bound[a] == b for a, b in own):
                kept.add(q)
                changed.update(a for a, b in own if a != b)
        return kept, len(changed)

    @staticmethod
    def _run(starts: set[int], w: int) -> int:
        """Tokens in the longest run of overlapping windows, each one further than the last."""
        best = run = 0
        for q in sorted(starts):
            run = run + 1 if q - 1 in starts else 1
            best = max(best, run)
        return best + w - 1


def blocks(benchmark: DataFrame, spec: Spec, key: str, text: str) -> Iterator[list[tuple[int, str | None]]]:
    """The items, in blocks with a bounded number of windows each (about, by a hash of the id)."""
    words = F.greatest(F.size(F.split(F.coalesce(F.col(text), F.lit("")), r"\s+")), F.lit(1))
    total = benchmark.agg(F.sum(words)).first()[0] or 0
    n = -(-total // spec.block_windows)
    for b in range(n):
        rows = benchmark.filter(F.pmod(F.xxhash64(key, text), F.lit(n)) == b).select(F.col(key).cast("long"), F.col(text).cast("string")).collect()
        yield sorted(((r[0], r[1]) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))


def contaminations(docs: DataFrame, benchmark: DataFrame, spec: Spec = Spec(), key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """doc_id, item_id, n_windows, share, changed_slots of every contaminated document and item."""
    schema = "doc_id long, item_id long, n_windows long, share double, changed_slots long"
    picked = docs.select(F.col(key).cast("long"), F.col(text).cast("string"))
    out = None
    for items in blocks(benchmark, spec, item, item_text):
        sent = docs.sparkSession.sparkContext.broadcast(Probe(items, spec))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            probe, canon = sent.value, Canon()
            for b in batches:
                rows = [(doc, *m) for doc, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) for m in probe.matches(canon, t)]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.float64() if i == 3 else pa.int64()) for i in range(5)], ["doc_id", "item_id", "n_windows", "share", "changed_slots"])

        found = picked.transform(mapped, run, schema)
        out = found if out is None else out.union(found)
    return out if out is not None else docs.sparkSession.createDataFrame([], schema)


def clean(docs: DataFrame, benchmark: DataFrame, spec: Spec = Spec(), text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """The documents that no item contaminates, with all their columns."""
    at = docs.columns.index(text)
    for items in blocks(benchmark, spec, item, item_text):
        sent = docs.sparkSession.sparkContext.broadcast(Probe(items, spec))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            probe, canon = sent.value, Canon()
            for b in batches:
                yield b.filter(pa.array([not probe.matches(canon, t) for t in b.column(at).to_pylist()], pa.bool_()))

        docs = docs.transform(mapped, run, docs.schema)
    return docs
