import hashlib
import random
import re

import pytest

from tagloom.llm import substring_dedup as s

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(docs, length):
    words = [(d, WORD.findall(t or "")) for d, t in docs]
    least = {}
    for d, w in words:
        for i in range(len(w) - length + 1):
            k = tuple(w[i : i + length])
            least[k] = min(least.get(k, d), d)
    out = []
    for d, w in words:
        off = {j for i in range(len(w) - length + 1) if least[tuple(w[i : i + length])] < d for j in range(i, i + length)}
        out.append((d, len(w), len(off), hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in off).encode()).hexdigest()))
    return sorted(out)


def corpus(seed, length):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)] + ["a", "b"]
    passages = [[rng.choice(words) for _ in range(rng.randint(length - 2, 2 * length))] for _ in range(5)] + [["a"] * (length + 5), ["a", "b"] * length]
    docs = []
    for _ in range(40):
        parts = [rng.choice(passages) if rng.random() < 0.5 else [rng.choice(words) for _ in range(rng.randint(0, length))] for _ in range(rng.randint(0, 6))]
        docs.append(rng.choice((" ", "\n", "\t ")).join(w for p in parts for w in p))
    docs += [docs[3], docs[3], "", None, "a " * 4 * length, "b " + "a " * 3 * length, "a b " * 2 * length]
    ids = list(range(len(docs)))
    rng.shuffle(ids)
    return list(zip(ids, docs, strict=True))


@pytest.mark.parametrize(("seed", "spec"), [(1, s.Spec()), (2, s.Spec(length=10)), (3, s.Spec(length=10, first=3)), (4, s.Spec(length=2)), (5, s.Spec(first=6)), (6, s.Spec(length=7, first=1)), (7, s.Spec(length=130))])
def test_digests_are_the_brute_forces(spark, seed, spec):
    docs = corpus(seed, spec.length)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    assert sorted(tuple(r) for r in s.digests(df, spec).collect()) == brute(docs, spec.length)


def test_edge_cases(spark):
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(1, long, 1, "x"), (1, long, 2, "y"), (2, long + "\nnew  words ", 3, "z"), (3, long, 4, None), (None, long, 5, "n")]
    df = spark.createDataFrame(rows, "doc_id long, text string, start int, marks string")
    got = sorted((r.doc_id or 0, r.n_words, r.n_removed) for r in s.digests(df).collect())
    assert got == [(0, 60, 0), (1, 60, 0), (1, 60, 0), (2, 62, 60), (3, 60, 60)]
    out = s.without_repeats(df)
    assert out.columns == df.columns
    assert sorted((r.doc_id or 0, r.text, r.start) for r in out.collect()) == [(0, long, 5), (1, long, 1), (1, long, 2), (2, "new  words ", 3)]
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert s.digests(empty).count() == 0 and s.without_repeats(empty).count() == 0


def test_rows_that_share_an_id_are_told_apart(spark):
    say = lambda k, n: " ".join(f"{k}{i}" for i in range(n))
    a, b, c = say("a", 80), say("b", 80), say("c", 90)
    docs = [(1, a), (2, a), (2, b), (3, f"{say('x', 7)} {b} {say('y', 3)}"), (3, c), (3, c), (4, f"{c} {a} {say('z', 60)}"), (4, say("z", 60)), (5, f"{say('z', 55)} {say('c', 60)}")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    assert sorted(tuple(r) for r in s.digests(df).collect()) == brute(docs, 50)
    kept = {(r.doc_id, r.text) for r in s.without_repeats(df).collect()}
    assert {(1, a), (2, b), (3, c), (4, say("z", 60))} <= kept and (2, a) not in kept


def test_one_word_over_and_over(spark):
    docs = [(i, "a " * (200 + i % 50)) for i in range(300)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    assert sorted(tuple(r) for r in s.digests(df).collect()) == brute(docs, 50)
    store = df.selectExpr("doc_id as rid", "doc_id as doc", "text", "array(array(%d), array(%d)) as known" % tuple(int(s.windows(s.WordHasher().of("a " * 50), k).view("int64")[0]) for k in (13, 26)))
    rows = s._runs(store, s.Spec()).collect()  # one row for each document, not for each window
    assert len(rows) == 300 and all(len(r.starts) == 200 + r.doc % 50 - 49 for r in rows)


def test_levels_double():
    assert s.levels(s.Spec()) == [13, 26] and s.levels(s.Spec(length=100, first=6)) == [6, 12, 24, 48, 96] and s.levels(s.Spec(length=4, first=9)) == [4]


def test_no_candidate_ends_the_loop(spark):
    df = spark.createDataFrame([(i, " ".join(f"{i}w{k}" for k in range(70))) for i in range(5)], "doc_id long, text string")
    assert [(r.n_words, r.n_removed) for r in s.digests(df).collect()] == [(70, 0)] * 5


def test_hashes_tell_words_apart_wherever_they_lie(monkeypatch):
    from tagloom.llm import hashing

    rng = random.Random(5)
    plain = ["a", "aa", "b", "ab", "ba", "\x00", "\x00\x00", "é", "日本", "\xa0", "\x85", "x" * 64, "x" * 65, "x" * 300, "A", "Z"] + ["".join(rng.choices("ab", k=rng.randint(1, 12))) for _ in range(3000)]
    # Two words of 2,048 letters whose polynomials of any base agree modulo 2**64.
    odd = "".join("ab"[bin(i).count("1") % 2] for i in range(2048))
    plain += [odd, odd.translate({97: "b", 98: "a"})]
    text = "".join(rng.choice([" ", "\n", "\t ", "\x0b", "\x0c\r"]) + w for w in plain)
    for block in (1 << 18, 100):  # words longer than a block stand alone
        monkeypatch.setattr(hashing, "BLOCK", block)
        for t in (text, text + " ", text.strip()):
            hashes = hashing.WordHasher().of(t).tolist()
            assert len(hashes) == len(plain) and len(set(zip(plain, hashes, strict=True))) == len(set(plain)) == len(set(hashes))
            assert hashes[:50] == [hashing.WordHasher().of(w)[0] for w in plain[:50]]
        assert hashing.WordHasher().of("Ab É", lower=True).tolist() == hashing.WordHasher().of("ab É").tolist()
        assert not len(hashing.WordHasher().of(None)) and not len(hashing.WordHasher().of(" \n "))
    assert not isinstance(hashing.WordHasher(), dict)  # no table of words to keep and look up
