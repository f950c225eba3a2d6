import hashlib
import random
from collections import Counter, defaultdict

import pytest

P = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")

from tagloom.llm import token_alignment as ta  # noqa: E402

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
ODD = [None, "", " ", "a", "▁x", "ﬁ Å", "<|endoftext|> <s> </s> <unk> <0x41>", "\x00a", "é́ 😀엉", "a  \n\n b\t", "日本語のテキスト", "don't I'll 's", "x" * 3000, " " * 300 + "y", "the the the", "the the the", "퟿ z"]


def naive(rows):
    a_lib = tokenizers.Tokenizer.from_file(A)
    a_lib.encode_special_tokens = True
    b_lib = sentencepiece.SentencePieceProcessor(model_file=B)
    letters = ta.byte_letters()
    docs = []
    for doc, text in rows:
        a = b = links = groups = []
        if text:
            e = a_lib.encode(" " + text, add_special_tokens=False)
            ids = b_lib.encode(text)
            bytes_a = [bytes(letters[c] for c in t) for t in e.tokens]
            pieces = [b_lib.id_to_piece(i) for i in ids]
            bytes_b = [bytes([int(p[3:5], 16)]) if b_lib.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(ids, pieces)]
            raw = (" " + text).encode()
            if b"".join(bytes_a) == raw and b"".join(bytes_b) == raw:
                a, b = e.ids, ids
                spans = []
                for tokens in (bytes_a, bytes_b):
                    at, own = 0, []
                    for t in tokens:
                        own.append((at, at := at + len(t)))
                    spans.append(own)
                lo = 0
                links = []
                for i, (s, t) in enumerate(spans[0]):
                    while spans[1][lo][1] <= s:
                        lo += 1
                    j = lo
                    while j < len(spans[1]) and spans[1][j][0] < t:
                        links.append((a[i], b[j]))
                        j += 1
                common = sorted({t for _, t in spans[0]} & {t for _, t in spans[1]})
                starts = [0, *common[:-1]]
                groups = [([a[i] for i, (x, y) in enumerate(spans[0]) if s <= x and y <= t], [b[i] for i, (x, y) in enumerate(spans[1]) if s <= x and y <= t]) for s, t in zip(starts, common)]
        docs.append((doc, a, b, groups, links))
    held = Counter(p for *_, links in docs for p in set(links))
    most = defaultdict(int)
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    for doc, a, b, groups, links in docs:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        yield doc, len(a), len(b), len(groups), len(links), sum(held[p] == most[p[0]] for p in links), sum(held[p] for p in links), hashlib.sha256(text.encode()).hexdigest() if text else ""


@pytest.mark.parametrize("run", [1_000_000, 8])
def test_query_is_the_naive_one(spark, monkeypatch, run):
    rng = random.Random(1)
    words = ["the", "internationalisation", "naïve", "42", "foo_bar", "😀", "\n", "co-operate", "Zürich", "  ", "xkcdq", "don't"]
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "the null id"), (3, "the repeated id")] + [(100 + i, " ".join(rng.choices(words, k=rng.randint(1, 25)))) for i in range(120)]
    monkeypatch.setattr(ta, "ALIGN_CHARS", 300)
    df = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, n_a string").repartition(5)
    out = [tuple(r) for r in ta.alignments(df, A, B, run=run).collect()]
    assert sorted(map(repr, out)) == sorted(map(repr, naive(rows)))
    assert ta.alignments(df.limit(0), A, B).count() == 0


def test_postings_of_an_id_may_come_in_many_parts(spark):
    """Half of all postings belong to one id, which is split into many parts; the counts stay whole."""
    rows = [(i, " the" * (1 + i % 3)) for i in range(400)] + [(1000 + i, "and so on") for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(40)
    out = [tuple(r) for r in ta.alignments(df, A, B, run=20).collect()]
    assert sorted(map(repr, out)) == sorted(map(repr, naive(rows)))


def test_the_fast_library_gives_the_ids_of_the_file():
    model = ta.ByteLevel(A)
    assert model.fast is not None
    lib = tokenizers.Tokenizer.from_file(A)
    lib.encode_special_tokens = True
    rng = random.Random(3)
    texts = [t for t in ODD if t] + ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(0xA0, 0x3000), rng.randrange(0x1F300, 0x1F700)])) for _ in range(200)) for _ in range(300)] + ["a" + " " * 20_000 + "b"]
    assert model.encode(texts) == [lib.encode(t, add_special_tokens=False).ids for t in texts]


def test_without_the_fast_library(monkeypatch):
    model = ta.ByteLevel(A)
    fast = model.encode(["some text, 12"])
    model.fast = None
    assert model.encode(["some text, 12"]) == fast


def test_groups_of():
    groups = ta.groups_of("naïve the", A, B)
    assert groups and all(a and b for a, b in groups)
    assert ta.groups_of("", A, B) == []
