import math
import re
from collections import Counter

import regex
import xxhash

from tagloom.llm import quality_rules as q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(t):
    t = t or ""
    w = WORD.findall(t)
    seen, dup = set(), 0
    for x in t.split("\n"):
        if WORD.search(x):
            dup += x in seen
            seen.add(x)
    c = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {j for i in range(len(w) - 4) if c[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(covered)


TEXTS = [None, "", " \n\t ", "one", "a b c d e a b c d e", "x " * 40, "a b c\x0bd\x0ce\rf", "l1 a\nl1 a\n\n\nl1 a \n l1 a", "a b c d e f a b c d e g a b c d e", "# $ % & | < > *", "é 日本 😀 x y z é 日本 😀 x y z", "w " * 5000]
GOOD = ["The quick brown fox jumps over the lazy dog number %d while another animal looks at the sky and thinks about supper tonight, or so they say in the old story of the village" % i for i in range(40)]
BAD = ["buy*** now### cheap$$$ pills%%% at### once&&& and%%% win$$$ big*** money### today&&& ok%%% " + str(i) for i in range(12)] + ["| ".join(f"cell{i}x{j} " for j in range(30)) for i in range(8)]


def test_counts_are_the_brute_forces(spark):
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(TEXTS)] + [(3, "one", "again")], "doc_id long, text string, w string")
    out = q.judged(df, q.fit(df)).collect()
    assert len(out) == len(TEXTS) + 1
    for r in out:
        n = brute(TEXTS[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == n, TEXTS[r.doc_id]
        assert r.base_failed == (n[0] < 10 or 100 * n[4] > 20 * n[0])
        assert not (r.base_failed and r.kept)


def test_verdict_keeps_prose_and_drops_junk(spark):
    texts = GOOD + BAD
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    kept = {r.doc_id for r in q.judged(df, q.fit(df)).collect() if r.kept}
    assert kept == set(range(len(GOOD)))
    assert {r.doc_id for r in q.keep(df).collect()} == kept
    assert q.fit(df) == q.fit(df.coalesce(1))


def test_ratio_is_the_brute_forces(spark):
    df = spark.createDataFrame(list(enumerate(GOOD + BAD)), "doc_id long, text string")
    weights = q.fit(df)
    from pyspark.sql import functions as F

    w = q.words_of(F.col("text"))
    for r in df.select(q.buckets_of(F.col("text"), w).alias("b"), q.ratio(F.col("text"), w, weights).alias("r")).collect():
        assert abs(sum(weights[b] for b in r.b) / len(r.b) - r.r) < 1e-6


def signed(h):
    return h - (1 << 64) if h >> 63 else h


def brute_buckets(t):
    """By definition: a bucket for each word, and one for each pair of neighbouring shapes."""
    shaped = regex.sub(r"\p{N}+", "0", regex.sub(r"\p{Lu}+", "A", regex.sub(r"\p{Ll}+", "a", t)))
    shapes = [x.encode() for x in WORD.findall(shaped)]
    single = [signed(xxhash.xxh64_intdigest(w.encode(), 42)) % q.WORD_BUCKETS for w in WORD.findall(t)]
    pair = lambda a, b: signed(xxhash.xxh64_intdigest(b, xxhash.xxh64_intdigest(a, 42))) % q.SHAPE_BUCKETS + q.WORD_BUCKETS
    return single + [pair(a, b) for a, b in zip(shapes, [*shapes[1:], b""], strict=False)]


def test_weights_and_verdicts_are_recomputed(spark):
    rules = q.Rules()
    texts = [*TEXTS, *GOOD, *BAD, "\n".join([GOOD[0]] * 2), GOOD[1].upper(), GOOD[2] + " AB CD EF GH", "# " + GOOD[3], "Ünïcode wörter " * 3 + GOOD[4], "x1 Y22 zzz"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    raw, target = Counter(), Counter()
    for t in texts:
        t = t or ""
        n, _, symbols, dup, _ = brute(t)
        good = n >= rules.trusted_words and 100 * symbols <= rules.trusted_symbol_percent * len(t) and 100 * len(regex.findall(r"\p{Lu}{2,}", t)) <= rules.trusted_capital_percent * n and not dup
        for b in brute_buckets(t):
            raw[b] += 1
            target[b] += good
    share = sum(target.values()) / sum(raw.values())
    assert 0 < share < 1
    weights = q.fit(df, rules)
    want = {b: math.log((target[b] + rules.shrink) / (raw[b] * share + rules.shrink)) for b in raw}
    assert all(abs(weights[b] - w) < 1e-5 for b, w in want.items()) and all(w == 0 for b, w in enumerate(weights) if b not in want)
    for r in q.judged(df, weights, rules).collect():
        buckets = brute_buckets(texts[r.doc_id] or "")
        llr = sum(want[b] for b in buckets) / len(buckets) if buckets else 0.0
        assert abs(r.llr - llr) < 1e-4 and (r.kept == (not r.base_failed and llr >= rules.threshold) or abs(llr - rules.threshold) < 1e-4), texts[r.doc_id]


def test_empty_table_and_no_python(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert q.keep(empty).count() == 0
    plan = q.judged(empty, q.fit(empty))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_words_are_hashed_once_and_sorted_without_a_comparing_lambda(spark):
    df = spark.createDataFrame(list(enumerate(GOOD)), "doc_id long, text string")
    plan = q.judged(df, q.fit(df))._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"xxhash64\(lambda \w+#\d+, 42\)", plan)) == 1
    assert "lambda left" not in plan


def test_blank_and_repeated_lines(spark):
    texts = ["a\n\n\nb", " \n \na\n\t\n\t", "a\na\n\na", "a \na\n a", "\n\n", "a\n \nb\n \na"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert all(r.n == brute(texts[r.doc_id])[3] for r in df.select("doc_id", q.dup_lines(df.text).alias("n")).collect())
