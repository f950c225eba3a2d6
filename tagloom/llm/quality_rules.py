"""Quality rules in DataFrame functions alone.

Base rules look at one text: too few words, or too many words in repeated
five-word windows. The verdict on the rest is a log-likelihood ratio between
two multinomials over hashed n-grams: the trusted documents (those that pass
much stricter rules) against the raw corpus, all documents of it. N-grams are
single words and pairs of neighbouring word shapes (runs of lower-case letters,
capitals and digits each count as one character). The ratio is divided by the
number of n-grams and held against one fixed threshold.

Counting takes one pass with map-side sums into a fixed number of buckets;
scoring is a projection. Texts are never shuffled.

Edge cases: a null or empty text has no words, so base_failed is true; without
any trusted document all ratios are 0 and the base rules decide alone.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES

#: Buckets of words and of shape pairs.
WORD_BUCKETS, SHAPE_BUCKETS = 1 << 14, 1 << 12
WINDOW = 5


@dataclass(frozen=True)
class Rules:
    min_words: int = 10
    repeat_percent: int = 20
    #: Expected target count below which a bucket says little.
    shrink: float = 30.0
    #: Least ratio per n-gram (natural logarithm) of a kept document.
    threshold: float = -0.25
    #: A trusted document has so many words at least, and so many symbols and runs of capitals in a hundred characters or words at most.
    trusted_words: int = 30
    trusted_symbol_percent: int = 1
    trusted_capital_percent: int = 10


def bound(value: Column, body) -> Column:
    """body(value), with value computed once."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


def hashes_of(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def windows_of(hashes: Column) -> Column:
    """Hashes of five words, from those of the words. The last four hash what is left, each another number of words, so they equal none."""
    return F.transform(hashes, lambda x, i: F.xxhash64(x, *[F.get(hashes, i + k) for k in range(1, WINDOW)]))


def repeats_in(hashes: Column) -> Column:
    """How many words lie in windows whose hash occurs twice or more."""

    def covered(hashes: Column) -> Column:
        ranked = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        twice = lambda s: F.filter(s, lambda x, k: ((k > 0) & (F.get(s, k - 1)["h"] == x["h"])) | (F.get(s, k + 1)["h"] == x["h"]))
        places = lambda s: F.sort_array(F.transform(twice(s), lambda x: x["i"]))
        steps = lambda p: F.aggregate(F.transform(p, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - x, F.lit(WINDOW)))), F.lit(0), lambda a, x: a + x)
        return bound(ranked, lambda s: bound(places(s), steps))

    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(covered(hashes))


def repeat_words(words: Column) -> Column:
    """How many words lie in a five-word window that occurs twice or more in the text (windows compared by 64-bit hashes)."""
    return F.when(F.size(words) < WINDOW, F.lit(0)).otherwise(bound(bound(hashes_of(words), windows_of), repeats_in))


def dup_lines(text: Column) -> Column:
    lines = F.array_remove(F.split(F.coalesce(text, F.lit("")), "\n"), "")
    worded = lambda x: F.filter(x, lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    repeated = lambda x: F.size(x) - F.size(F.array_distinct(x))
    # Most texts have no two equal lines at all: these are not looked at one by one.
    return bound(lines, lambda x: F.when(repeated(x) == 0, F.lit(0)).otherwise(bound(worded(x), repeated)))


def symbols_of(text: Column) -> Column:
    return F.length(F.regexp_replace(F.coalesce(text, F.lit("")), r"[^#*$%&|<>]+", ""))


def shapes_of(text: Column) -> Column:
    shaped = F.coalesce(text, F.lit(""))
    for pattern, mark in ((r"\p{Ll}+", "a"), (r"\p{Lu}+", "A"), (r"\p{N}+", "0")):
        shaped = F.regexp_replace(shaped, pattern, mark)
    return words_of(shaped)


def with_next(shapes: Column, body) -> Column:
    """body(hash) for each pair of neighbouring shapes, the last with an empty one; an empty text has none."""
    return F.transform(shapes, lambda x, i: body(F.xxhash64(x, F.coalesce(F.get(shapes, i + 1), F.lit("")))))


def bucket_numbers(hashes: Column, shapes: Column) -> Column:
    # The numbers of buckets are powers of two, so their low bits are the remainder.
    single = F.transform(hashes, lambda h: h.bitwiseAND(WORD_BUCKETS - 1))
    return F.concat(single, with_next(shapes, lambda h: h.bitwiseAND(SHAPE_BUCKETS - 1) + F.lit(WORD_BUCKETS)))


def buckets_of(text: Column, words: Column) -> Column:
    """Bucket numbers of a text's n-grams: each word, and each pair of neighbouring shapes."""
    return bound(shapes_of(text), lambda s: bucket_numbers(hashes_of(words), s))


def trusted(text: Column, words: Column, rules: Rules) -> Column:
    n = F.size(words)
    return (
        (n >= rules.trusted_words)
        & (100 * symbols_of(text) <= rules.trusted_symbol_percent * F.length(text))
        & (100 * F.regexp_count(text, F.lit(r"\p{Lu}{2,}")) <= rules.trusted_capital_percent * n)
        & (dup_lines(text) == 0)
    )


def fit(docs: DataFrame, rules: Rules = Rules(), text: str = "text") -> list[float]:
    """Weight of each bucket: log of its count among trusted documents over the count expected from the raw corpus."""
    worded = docs.select(F.col(text).cast("string").alias("t")).select("t", words_of(F.col("t")).alias("w"), shapes_of(F.col("t")).alias("s"))
    flagged = worded.select(F.coalesce(trusted(F.col("t"), F.col("w"), rules), F.lit(False)).cast("long").alias("good"), bucket_numbers(hashes_of(F.col("w")), F.col("s")).alias("buckets"))
    # A step of its own: else the flag is computed for every n-gram. Outer: else a filter on the array's size computes it twice.
    grams = flagged.select("good", F.explode_outer("buckets").alias("bucket")).filter("bucket is not null")
    counts = grams.groupBy("bucket").agg(F.count(F.lit(1)).alias("raw"), F.sum("good").alias("target")).collect()  # at most as many rows as buckets
    weights = [0.0] * (WORD_BUCKETS + SHAPE_BUCKETS)
    raw, target = sum(r.raw for r in counts), sum(r.target for r in counts)
    for r in counts:
        if target:
            expected = r.raw * target / raw
            weights[r.bucket] = round(math.log((r.target + rules.shrink) / (expected + rules.shrink)), 6)
    return weights


def mean_weight(hashes: Column, shapes: Column, weights: list[float]) -> Column:
    """Mean weight of the buckets of words with these hashes and of these shapes; 0 without any."""
    of = lambda part: F.split(F.lit(",".join(f"{w:.6f}" for w in part)), ",").cast("array<double>")  # noqa: E731  # folded to one constant
    word, shape = of(weights[:WORD_BUCKETS]), of(weights[WORD_BUCKETS:])
    singles = F.aggregate(hashes, F.lit(0.0), lambda a, h: a + word[h.bitwiseAND(WORD_BUCKETS - 1)])
    pairs = with_next(shapes, lambda h: shape[h.bitwiseAND(SHAPE_BUCKETS - 1)])
    n = F.size(hashes) + F.size(shapes)
    return F.when(n == 0, F.lit(0.0)).otherwise(F.aggregate(pairs, singles, lambda a, x: a + x) / n)


def ratio(text: Column, words: Column, weights: list[float]) -> Column:
    """Log-likelihood ratio per n-gram; 0 without n-grams."""
    return bound(shapes_of(text), lambda s: bound(hashes_of(words), lambda h: mean_weight(h, s, weights)))


def judged(docs: DataFrame, weights: list[float], rules: Rules = Rules(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, the base counts, base_failed, llr and kept of every document."""
    t, w, h, s, five = (F.col(c) for c in ("t", "w", "h", "s", "five"))
    base = docs.select(F.col(key).alias("k"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t")).select("k", "t", words_of(t).alias("w"))
    # Steps of their own: what several columns take is computed once, and array functions outside of lambdas run as compiled code.
    hashed = base.select("k", "t", "w", hashes_of(w).alias("h"), shapes_of(t).alias("s"))
    counted = hashed.select("*", windows_of(h).alias("five")).select(
        F.col("k").alias(key),
        F.size(w).cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        symbols_of(t).cast("long").alias("n_symbols"),
        dup_lines(t).cast("long").alias("n_dup_lines"),
        repeats_in(five).cast("long").alias("n_repeat_words"),
        mean_weight(h, s, weights).alias("llr"),
    )
    failed = (F.col("n_words") < rules.min_words) | (100 * F.col("n_repeat_words") > rules.repeat_percent * F.col("n_words"))
    return counted.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= rules.threshold))


def keep(docs: DataFrame, rules: Rules = Rules(), text: str = "text") -> DataFrame:
    """The documents that the rules keep, with all their columns."""
    weights = fit(docs, rules, text)
    value = F.coalesce(F.col(text).cast("string"), F.lit(""))

    def verdict(w: Column) -> Column:
        n = F.size(w)
        return F.when((n < rules.min_words) | (100 * repeat_words(w) > rules.repeat_percent * n), F.lit(False)).otherwise(ratio(value, w, weights) >= rules.threshold)

    return docs.filter(bound(words_of(value), verdict))
