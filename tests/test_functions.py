import json
import random
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tagloom.functions import rendering
from tagloom.functions import similarity as s
from tagloom.functions import text as t
from tagloom.functions import tokens


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x"))).first()[0]


def test_words(spark):
    for text, n in (("", 0), ("  ", 0), (" a b\nc ", 3), ("x", 1)):
        assert one(spark, text, t.word_count) == n


def test_marker_and_prompt(spark):
    assert one(spark, "do\n\nHTML:\n<p>\n\nask", t.after_marker) == "<p>\n\nask"
    assert one(spark, "nothing", t.after_marker) is None
    assert one(spark, "<p>\n\nask", lambda x: t.without_prompt(x, F.lit("ask"))) == "<p>"


def test_think_tags(spark):
    for text, want in ((" plain ", "plain"), ("a<think>b", "a"), ("<think>x</think> y ", "y"), ("<think>x</think>y</think>z", "y"), ("</think>q", "</think>q")):
        assert one(spark, text, t.answer_of) == want


def test_small_ones(spark):
    assert one(spark, "2024-01-02T03:04:05.678Z", t.safe_timestamp) == "2024-01-02T03-04-05"
    assert one(spark, "HTTP://u:p@Ex.Org:80/a?b", t.host) == "ex.org" and one(spark, "nothing", t.host) is None
    assert one(spark, ["a", "", "b"], t.without_blanks, "array<string>") == ["a", "b"]
    assert one(spark, 0, lambda x: t.percent_less(x, F.lit(1)), "long") is None
    assert [one(spark, x, t.complete) for x in ("TODO", "", None, "x", '["TODO"]')] == [False, False, False, True, True]
    assert one(spark, '{"a": "TODO"}', t.has_open_todo)
    assert one(spark, "abcdef", lambda x: t.preview(x, 3)) == "abc..." and one(spark, "abc", lambda x: t.preview(x, 3)) == "abc"
    assert [one(spark, x, lambda c: t.half_even(c, 1), "double") for x in (0.25, 2.45, 0.35, -0.25, None)] == [0.2, 2.4, 0.4, -0.2, None]
    assert [one(spark, x, lambda c: t.holds(c, '"a"')) for x in ('{"a"}', "a", None)] == [True, False, False]
    assert [one(spark, x, lambda x: t.saveable(F.lit("<p>"), x, F.lit("event"))) for x in ("{}", "{")] == [True, False]


def test_tokens(spark):
    assert one(spark, "Hello wonderful 42!", tokens.approximate) == 1 + 2 + 2 + 1
    assert one(spark, [("user", "a b"), ("assistant", "c")], tokens.of_chat, "array<struct<role: string, content: string>>") == 3 + 10


def test_overlap_is_the_multisets(spark):
    rng = random.Random(1)
    rows = [(" ".join(rng.choice("a b c dd".split()) for _ in range(rng.randint(0, 12))), " ".join(rng.choice("a b c dd".split()) for _ in range(rng.randint(0, 12)))) for _ in range(60)] + [(None, "a"), ("A-b", "b a")]
    for row in spark.createDataFrame(rows, "p string, r string").withColumn("f", s.overlap_scores("p", "r")).collect():
        for n, got in ((1, row.f.rouge1), (2, row.f.rouge2)):
            p, r = ([tuple(x[i : i + n]) for i in range(len(x) - n + 1)] for x in ((row.p or "").lower().replace("-", " ").split(), row.r.split()))
            both = sum(min(p.count(g), r.count(g)) for g in set(p))
            assert abs(got - (2 * both / (len(p) + len(r)) if both else 0)) < 1e-12


def test_ranks(spark):
    vocabulary = pytest.importorskip("public_tokenizers").path("byte_bpe_50k.tiktoken")
    ranks = tokens.Ranks(vocabulary)
    want = {x: len(ranks.encode(x)) for x in ("Hello wonderful 42!", "", "é😀")}
    assert want["Hello wonderful 42!"] in range(3, 12) and want[""] == 0
    assert all(one(spark, x, ranks) == n for x, n in want.items()) and one(spark, None, ranks) is None
    other = tokens.Ranks(vocabulary, r"\S|\s")  # the same file with another pattern, in the same workers
    assert one(spark, "Hello wonderful 42!", other) == len("Hello wonderful 42!")
    assert all(one(spark, x, ranks) == n for x, n in want.items())
    chat = [("user", "Hello wonderful 42!"), ("assistant", "é😀"), ("assistant", None)]
    assert one(spark, chat, lambda m: tokens.of_chat(m, ranks), "array<struct<role: string, content: string>>") == sum(want.values()) + 3 * tokens.PER_MESSAGE


def test_both_approximations_agree(spark):
    for x in ("Hello wonderful 42!", "", " \n\t\x0b", "a\u00a0b\u3000c", "ÀÉ日本語ไทย हिन्दी ①½ ﬁ", "x" * 50 + "12345" + "!?"):
        assert one(spark, x, tokens.approximate) == tokens.approximate_count(x)


def test_rendering(spark):
    raw = '{"b":[1,{"c":null}],"a":"\\u00e9",  "d": 1.50, "e": []}'
    assert one(spark, raw, rendering.pretty_json) == json.dumps(json.loads(raw), ensure_ascii=False, indent=2)
    assert one(spark, raw, rendering.compact_json) == '{"b": [1, {"c": null}], "a": "é", "d": 1.5, "e": []}'
    assert one(spark, None, rendering.pretty_json) is None


def test_lcs():
    rng = random.Random(2)
    for _ in range(300):
        a, b = ([rng.choice("abc") for _ in range(rng.randint(0, 9))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for k, y in enumerate(b):
                table[i + 1][k + 1] = table[i][k] + 1 if x == y else max(table[i][k + 1], table[i + 1][k])
        assert s.lcs(a, b) == table[-1][-1]


def test_stems():
    for word, stem in {"caresses": "caress", "ponies": "poni", "cats": "cat", "agreed": "agre", "plastered": "plaster", "motoring": "motor", "hopping": "hop", "hoping": "hope", "falling": "fall", "filing": "file", "happy": "happi", "sky": "sky", "relational": "relat", "conditional": "condit", "triplicate": "triplic", "hopeful": "hope", "revival": "reviv", "adoption": "adopt", "probate": "probat", "rate": "rate", "controll": "control", "roll": "roll"}.items():
        assert s.stem(word) == stem, word


def test_distance_is_the_tables():
    rng = random.Random(3)
    for _ in range(600):
        alphabet = rng.choice(["ab", "abc", "aé😀x", "abcdefghij"])
        a, b = ("".join(rng.choice(alphabet) for _ in range(rng.randint(0, rng.choice([5, 30, 150])))) for _ in range(2))
        if rng.random() < 0.3:
            b = a[: len(a) // 2] + b[:5] + a[len(a) // 2 :]
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            before, row = row, [i]
            for k, y in enumerate(b, 1):
                row.append(min(before[k] + 1, row[-1] + 1, before[k - 1] + (x != y)))
        assert s.distance(a, b) == s.distance(b, a) == row[-1]


def test_long_texts_are_cheap():
    rng = random.Random(4)
    a, b = ("".join(rng.choice("abcdefgh ") for _ in range(30_000)) for _ in range(2))
    start = time.process_time()
    assert 0 < s.distance(a, b) < 30_000
    assert time.process_time() - start < 2
    assert s.distance(a, a[:10_000] + "x" + a[10_001:]) <= 1 and s.distance(a, "") == 30_000


def test_metric_identities(spark):
    df = spark.createDataFrame([("héllo wörld 😀", "héllo wörld 😀"), ("", None), ("", "x"), ("kitten", "sitting")], "p string, r string")
    p, r = F.col("p"), F.col("r")
    got = df.select(s.edits(p, r).alias("d"), s.edits(r, p).alias("e"), s.rouge_scores(p, r).alias("s")).collect()
    assert [x.d for x in got] == [x.e for x in got] and [x.d.distance for x in got] == [0, 0, 1, 3]
    assert [round(x.d.similarity, 4) for x in got] == [1, 1, 0, round(1 - 3 / 7, 4)]
    assert got[0].s.rougeL == 1 and got[1].s.rouge1 == 0
    assert Counter(s.stemmed("Running runs ran")) == Counter(["run", "run", "ran"])
