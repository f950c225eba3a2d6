import hashlib
import random
import re

import pytest

from tagloom.llm import fill_in_middle as fim

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
ODD = ["", " ", "\n\t ", "a", " a", "a ", "a  b", " x　y", "日本 語\x0b\x0c", "😀 é́ \x85z", "<P> a b", "<S", "a <M> b", "<<P", "P> S> M>", "x" * 5000, "ab " * 70_000, " " * 100_000 + "z", "\x1c\x1d a\x00b"]


def naive(doc, text):
    text = text or ""
    units = UNIT.findall(text)
    n = len(units)
    hexed = hashlib.sha256(f"42:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(hexed[i : i + 8], 16) for i in (0, 8, 16, 24)]
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return n, "plain", None, None, text
    i, j = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:i]), "".join(units[i:j]), "".join(units[j:])
    return (n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}") if h[3] % 100 < 80 else (n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


def test_bits_are_the_patterns():
    rng = random.Random(1)
    for text in ODD + ["".join(rng.choice("ab \n\té😀 ") for _ in range(rng.randint(0, 60))) for _ in range(500)]:
        raw, at, ends = text.encode(), 0, []
        for u in UNIT.findall(text):
            ends.append(at := at + len(u.encode()))
        bits = fim.unit_ends(raw)
        assert bits.bit_count() == len(ends)
        for k in {1, 2, len(ends) // 2, len(ends)} & set(range(1, len(ends) + 1)):
            assert fim.select(bits, k) + 1 == ends[k - 1]


@pytest.mark.parametrize("k", [1, 2, 63, 64, 65, 1000])
def test_select(k):
    rng = random.Random(k)
    places = sorted(rng.sample(range(100_000), 1000))
    assert fim.select(sum(1 << p for p in places), k) == places[k - 1]


def test_query_is_the_naive_one(spark):
    rng = random.Random(2)
    texts = ODD + [None] + ["".join(rng.choice("ab \n\té😀<P>") for _ in range(rng.randint(0, 60))) for _ in range(300)]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(None, "a b c", None), (7, "again a row", ""), (7, "again a row", ""), (2**62, "large id here", "")]
    out = fim.digests(spark.createDataFrame(rows, "doc_id long, text string, output string")).collect()
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = []
    for doc, text, _ in rows:
        *numbers, output = naive(doc, text)
        want.append((doc, *numbers, sha(output), sha(text or "")))
    assert sorted(map(repr, map(tuple, out))) == sorted(map(repr, want))
    assert {r.form for r in out} == {"plain", "psm", "spm"}
    assert fim.digests(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_other_sentinels_and_shares(spark):
    df = spark.createDataFrame([(str(i), f"one two three {i}") for i in range(50)], "name string, body string")
    marks = ("<|a|>", "<|b|>", "<|c|>")
    out = fim.transformed(df, key="name", text="body", percent=100, spm_percent=0, sentinels=marks)
    back = out.select("name", "form", "output", fim.restored(out["output"], out["form"], marks).alias("back")).collect()
    assert all(r.form == "psm" and r.back == f"one two three {r.name}" and r.output.startswith("<|a|>") for r in back)
    with pytest.raises(ValueError):
        fim.transformed(df, key="name", text="body", sentinels=("a", "a", "b"))
