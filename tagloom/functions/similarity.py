"""Text similarity: n-gram overlap (ROUGE-1, -2), longest common subsequence (ROUGE-L) and edit distance.

Tokens are runs of a-z and 0-9 of the lower-cased text. All are Arrow functions: multisets
of n-grams and stemming (Porter, 1980; words of more than three letters) are linear in the
number of words; subsequences and edit distances take a few operations on a bit set of the
shorter text for each word or character of the longer.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from .kinds import struct

WORD = re.compile(r"[a-z0-9]+")


def distance(a: str, b: str) -> int:
    """Edit distance (insert, delete, replace) with one bit for each place of the shorter text, in big integers.

    Hyyro's form of Myers' algorithm (1999): a column of the table is two bit sets, the places where it goes up and where it
    goes down; a character of the longer text takes the next column in a few operations on whole columns.
    """
    if len(a) > len(b):
        a, b = b, a
    at, most = 0, len(a)
    while at < most and a[at] == b[at]:  # what both begin or end with costs nothing
        at += 1
    end = 0
    while end < most - at and a[-1 - end] == b[-1 - end]:
        end += 1
    a, b = a[at : len(a) - end], b[at : len(b) - end]
    if not a:
        return len(b)
    full, top = (1 << len(a)) - 1, 1 << (len(a) - 1)
    codes = np.frombuffer(a.encode("utf-32-le", "surrogatepass"), np.uint32)
    places = {chr(c): int.from_bytes(np.packbits(codes == c, bitorder="little").tobytes(), "little") for c in np.unique(codes)}
    up, down, score = full, 0, len(a)
    for c in b:
        same = places.get(c, 0)
        zero = same | down
        level = ((same & up) + up ^ up) | same
        right_up = down | ~(level | up) & full
        right_down = up & level
        if right_up & top:
            score += 1
        elif right_down & top:
            score -= 1
        right_up = right_up << 1 | 1
        up = (right_down << 1 | ~(zero | right_up)) & full
        down = right_up & zero & full
    return score


@F.pandas_udf(struct("distance long, similarity double"))
def edits(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    """Edit distance and 1 - distance / longer length (1 if both are empty) of two texts; null counts as empty."""
    for p, r in batches:
        pairs = [(a or "", b or "") for a, b in zip(p, r, strict=True)]
        far = [distance(a, b) for a, b in pairs]
        yield pd.DataFrame({"distance": far, "similarity": [1 - d / max(len(a), len(b), 1) for d, (a, b) in zip(far, pairs, strict=True)]})


VOWELS = "aeiou"


def _vowel(w: str, i: int) -> bool:
    return w[i] in VOWELS or w[i] == "y" and i > 0 and not _vowel(w, i - 1)


def _measure(w: str) -> int:
    """How many times a run of vowels is followed by a consonant."""
    kinds = [_vowel(w, i) for i in range(len(w))]
    return sum(a and not b for a, b in zip(kinds, kinds[1:], strict=False))


def _ends_short(w: str) -> bool:
    """Consonant, vowel, consonant other than w, x, y at the end."""
    n = len(w)
    return n >= 3 and not _vowel(w, n - 1) and _vowel(w, n - 2) and not _vowel(w, n - 3) and w[-1] not in "wxy"


#: Suffix rules of steps 2 and 3, suffixes of step 4.
STEP2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize", "abli": "able", "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous",
    "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al", "iveness": "ive", "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble",
}
STEP3 = {"icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": ""}
STEP4 = "al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous ive ize".split()


def stem(w: str) -> str:
    """Porter's stem of a lower-case word."""
    if len(w) < 3:
        return w
    if w.endswith(("sses", "ies")):
        w = w[:-2]
    elif w.endswith("s") and not w.endswith("ss"):
        w = w[:-1]
    cut = None
    if w.endswith("eed"):
        w = w[:-1] if _measure(w[:-3]) > 0 else w
    elif w.endswith("ed"):
        cut = w[:-2]
    elif w.endswith("ing"):
        cut = w[:-3]
    if cut is not None and any(_vowel(cut, i) for i in range(len(cut))):
        w = cut
        if w.endswith(("at", "bl", "iz")):
            w += "e"
        elif len(w) > 1 and w[-1] == w[-2] and not _vowel(w, len(w) - 1) and w[-1] not in "lsz":
            w = w[:-1]
        elif _measure(w) == 1 and _ends_short(w):
            w += "e"
    if w.endswith("y") and any(_vowel(w, i) for i in range(len(w) - 1)):
        w = w[:-1] + "i"
    for rules in (STEP2, STEP3):
        for suffix in sorted(rules, key=len, reverse=True):
            if w.endswith(suffix):
                if _measure(w[: -len(suffix)]) > 0:
                    w = w[: -len(suffix)] + rules[suffix]
                break
    for suffix in sorted(STEP4, key=len, reverse=True):
        if w.endswith(suffix):
            base = w[: -len(suffix)]
            if _measure(base) > 1 and (suffix != "ion" or base[-1:] in ("s", "t")):
                w = base
            break
    if w.endswith("e"):
        base = w[:-1]
        if _measure(base) > 1 or _measure(base) == 1 and not _ends_short(base):
            w = base
    return w[:-1] if w.endswith("ll") and _measure(w) > 1 else w


def stemmed(text: str | None) -> list[str]:
    return [stem(w) if len(w) > 3 else w for w in WORD.findall((text or "").lower())]


def f1(both: int, p: int, r: int) -> float:
    return 2 * both / (p + r) if both else 0.0


def grams_f1(p: list[str], r: list[str], n: int) -> float:
    a, b = (Counter(tuple(x[i : i + n]) for i in range(len(x) - n + 1)) for x in (p, r))
    return f1(sum((a & b).values()), sum(a.values()), sum(b.values()))


def lcs(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence, with one bit for each place of the shorter list."""
    if len(a) > len(b):
        a, b = b, a
    places: dict[str, int] = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << i
    full = state = (1 << len(a)) - 1
    for x in b:
        hit = state & places.get(x, 0)
        state = (state + hit | state - hit) & full
    return len(a) - state.bit_count()


def rouge(prediction: str | None, reference: str | None) -> tuple[float, float, float]:
    """Stemmed ROUGE-1, ROUGE-2 and ROUGE-L F1."""
    p, r = stemmed(prediction), stemmed(reference)
    return grams_f1(p, r, 1), grams_f1(p, r, 2), f1(lcs(p, r), len(p), len(r))


@F.pandas_udf(struct("rouge1 double, rouge2 double"))
def overlap_scores(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    """F1 of the multisets of words and of word pairs, without stemming: (prediction, reference)."""
    for p, r in batches:
        words = [[WORD.findall((t or "").lower()) for t in x] for x in (p, r)]
        yield pd.DataFrame([(grams_f1(a, b, 1), grams_f1(a, b, 2)) for a, b in zip(*words, strict=True)], columns=["rouge1", "rouge2"])


@F.pandas_udf(struct("rouge1 double, rouge2 double, rougeL double"))
def rouge_scores(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    """Column form of ``rouge`` (prediction, reference)."""
    for p, r in batches:
        yield pd.DataFrame([rouge(a, b) for a, b in zip(p, r, strict=True)], columns=["rouge1", "rouge2", "rougeL"])
