import hashlib
import random

import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")

from tagloom.llm import sentencepiece_bpe as bpe  # noqa: E402

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", "  a  b ", "a\nb", "\n", "\t\tx", "▁x", "▁" * 40, "ﬁ Å", "<s>hi</s>", "\x00a", "é́", "퟿😀", "a  ", "x" * 5000, "ab" * 3000 + " " * 50, " " * 3000, "<unk> <0x41>", "⁇ ⁇", "日本語のテキスト"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_ids_and_text_are_the_librarys(library):
    m = bpe.model(PATH)
    rng = random.Random(1)
    for text in ODD + ["".join(rng.choice("ab \n\t▁thé€😀엉inger.,\r") for _ in range(rng.randint(0, 80))) for _ in range(500)]:
        ids = library.encode(text)
        assert m.encode(text) == ids
        assert m.decode(ids) == library.decode(ids)


def test_long_words(library):
    m = bpe.model(PATH)
    rng = random.Random(2)
    words = ["internationalisation" * 500, "a" * 30_000, "ab" * 9000 + "b" * 77, "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(20_000)), "".join(rng.choice("aé日😀t") for _ in range(9000)), "ththththe" * 2000]
    words += ["".join(rng.choice(a) for _ in range(rng.randint(1, 400))) for a in ("ab", "the", "aeinst", "ing", "0123456789", "-=", "eE") for _ in range(150)]
    assert m.encode_words(words) == [library.encode(w)[1:] if library.encode(w)[0] == library.piece_to_id("▁") else m.encode_words([w])[0] for w in words]
    for w in words:
        assert m.encode(w) == library.encode(w)


def test_long_words_take_few_rounds(monkeypatch):
    m = bpe.model(PATH)
    rounds = []
    real = m._together
    monkeypatch.setattr(m, "_together", lambda *x: rounds.append(1) or real(*x))
    m.merge_rounds(["▁" + "internationalisation" * 5000])
    assert len(rounds) < 60


def test_cache_may_overflow(library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 5)
    texts = [f"word{i} and more {i}" for i in range(50)]
    assert [ids for ids, _ in bpe.Codec(PATH).both_ways(texts)] == [",".join(map(str, library.encode(t))) for t in texts]


def test_digests(spark, library):
    rows = [(1, "a b", "x"), (2, None, "y"), (3, "", None), (3, "", None), (None, "é 😀", "z")] + [(10 + i, t, "") for i, t in enumerate(ODD)]
    out = bpe.digests(spark.createDataFrame(rows, "doc_id long, text string, n_tokens string"), PATH).collect()
    assert len(out) == len(rows)
    want = {}
    for doc, t, _ in rows:
        ids = library.encode(t or "")
        want[doc] = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest())
    assert all(want[r.doc_id] == (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in out)
    assert bpe.digests(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0


def test_encode_column_keeps_columns_and_refuses_clashes(spark, library):
    df = spark.createDataFrame([(1, "a b", 5)], "doc_id long, text string, n int")
    r = bpe.encode_column(df, PATH, decoded="back").first()
    assert (r.n, list(r.token_ids), r.back) == (5, library.encode("a b"), "a b")
    with pytest.raises(ValueError):
        bpe.encode_column(df, PATH, ids="n")
