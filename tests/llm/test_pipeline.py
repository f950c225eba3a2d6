import hashlib
import random
import re

import corpus_pipeline
import pytest
import sentencepiece
from pyspark.sql import functions as F

from tagloom.llm import queries
from tagloom.llm.common import table

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DATA = "/root/testdata/sf0.001"


def brute(docs, items, kept_by_rules):
    """The pipeline in plain Python; the quality verdicts are taken as given, they have tests of their own."""
    docs = {d: t for d, t in docs if d in kept_by_rules}
    sets = {}
    for d, t in docs.items():
        w = [x.encode().lower() for x in WORD.findall(t)]
        sets[d] = frozenset(tuple(w[i : i + 4]) for i in range(max(1, len(w) - 3)))
    up = {d: d for d in docs}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(docs)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            n = len(sets[a] & sets[b])
            if 100 * n >= 85 * (len(sets[a]) + len(sets[b]) - n):
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    docs = {d: docs[d] for d in ids if root(d) == d}
    first = {}
    for d in sorted(docs):
        w = WORD.findall(docs[d])
        for i in range(len(w) - 49):
            first.setdefault(tuple(w[i : i + 50]), d)
    cut = {}
    for d, t in docs.items():
        found = list(WORD.finditer(t))
        w = [m[0] for m in found]
        off = {j for i in range(len(w) - 49) if first[tuple(w[i : i + 50])] < d for j in range(i, i + 50)}
        if len(off) < len(w) or not off:
            ends = [m.start() for m in found[1:]] + [len(t)]
            cut[d] = t[: found[0].start()] + "".join(t[m.start() : e] for i, (m, e) in enumerate(zip(found, ends, strict=True)) if i not in off)
    squeeze = lambda t: " ".join(re.findall(r"\w+", t.lower()))
    return {d: t for d, t in cut.items() if not any(squeeze(i) in squeeze(t) for i in items)}


def test_pipeline_is_the_brute_forces(spark, tmp_path):
    rng = random.Random(7)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(900)]
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items, passage = [say(20) for _ in range(4)], say(70)
    docs = []
    for k in range(90):
        t = [say(rng.randint(12, 90))]
        if k % 5 == 0:
            t.append(passage)
        if k % 11 == 0:
            t.insert(rng.randint(0, 1), items[k % 4])
        docs.append("\n".join(t))
    docs += [docs[3], docs[3] + " more", "x " * 60, " ".join(w.upper() + "!!" for w in say(60).split()), passage, None, "", "few words"]
    order = list(range(len(docs)))
    rng.shuffle(order)
    rows = list(zip(order, docs, strict=True))
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([(d, t, None, "s", len(t or "")) for d, t in rows], schema).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    stages, docs_now = dict(corpus_pipeline.STAGES), table(spark, str(tmp_path), "documents")
    kept = {r.doc_id for r in stages["quality rules"](spark, docs_now, str(tmp_path)).collect()}
    assert len(kept) >= 90
    want = brute([(d, t or "") for d, t in rows], items, kept)
    assert 20 < len(want) < len(kept) - 10
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    sp = sentencepiece.SentencePieceProcessor(model_file=queries.piece_model())
    assert {r.doc_id: (r.n_tokens, r.decoded_sha256) for r in got} == {d: (len(sp.encode(t)), hashlib.sha256(t.encode()).hexdigest()) for d, t in want.items()}


@pytest.mark.parametrize("k", range(len(corpus_pipeline.STAGES)))
def test_stages_take_odd_tables(spark, k):
    text = "some plain words that make up a whole line of text which nobody has written before today " * 2
    schema = "doc_id long, text string, lang string, source string, n_chars long, node string, marks int, w array<int>"
    rows = [(1, text, None, None, None, "x", 1, [1]), (1, text, None, None, None, "x", 1, [1]), (None, text, "en", "s", 5, None, None, None), (2, None, "en", "s", 0, "y", 2, []), (3, "", "en", "s", 0, "y", 2, []), (4, "word " * 30_000, "en", "s", 5, "z", 0, [])]
    name, stage = corpus_pipeline.STAGES[k]
    for r in (rows, []):
        df = spark.createDataFrame(r, schema)
        out = stage(spark, df, DATA)
        assert k == len(corpus_pipeline.STAGES) - 1 or out.columns == df.columns
        assert out.count() <= len(r)


@pytest.mark.parametrize("k", range(len(corpus_pipeline.STAGES)))
def test_stages_are_right_on_odd_rows(spark, k):
    """Null and empty texts, null ids, repeated rows, long texts, copies, a benchmark item, extra columns: each stage against what it must keep."""
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(3, 8))) for _ in range(5000)]
    plain = "The small house by the river was sold last year to a family from the north , and they have since planted apple trees , roses and a long hedge along the road so that nobody can see them eat breakfast on warm mornings when most of their neighbours are already at work in the city"
    long, item = " ".join(rng.choice(words) for _ in range(30_000)), table(spark, DATA, "benchmark").orderBy("item_id").first().text
    texts = [(1, plain), (1, plain), (None, plain), (7, f"{plain} again"), (2, None), (3, ""), (4, "word " * 30_000), (5, long), (6, f"x {long} y"), (8, f"{' '.join(words[:40])} {item} {' '.join(words[40:80])}")]
    docs = spark.createDataFrame([(d, t, "en", "s", t if t is None else len(t), "x", 1, [1]) for d, t in texts], "doc_id long, text string, lang string, source string, n_chars long, node string, marks int, w array<int>")
    name, stage = corpus_pipeline.STAGES[k]
    out = stage(spark, docs, DATA)
    if name.startswith("Sentence"):
        library = sentencepiece.SentencePieceProcessor(model_file=queries.piece_model())
        sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
        want = [(d, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids))) for d, t in texts for ids in [library.encode(t or "")]]
        assert sorted(map(repr, map(tuple, out.collect()))) == sorted(map(repr, want))
        return
    without = lambda *gone: [x for x in texts if x[0] not in gone]
    want = {
        "quality rules": without(2, 3, 4),  # no words, or one said over and over
        "n-gram Jaccard join": [x for i, x in enumerate(texts) if i != 1 and x[0] not in (6, 7)],  # a null id is linked with nothing
        "substring dedup": without(6, 7) + [(6, "x y"), (7, "again")],  # a null id is no smaller id
        "benchmark decontamination": without(8),
    }[name]
    got = [(r.doc_id, r.text, r.n_chars, r.node) for r in out.collect()]
    assert sorted(map(repr, got)) == sorted(repr((d, t, t if t is None else len(t), "x")) for d, t in want)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_queries_cover_their_tables(spark, name):
    out = queries.QUERIES[name](spark, DATA)
    n = out.count()
    if name.startswith("op5"):
        assert out.filter(F.col("doc_id").isNull()).isEmpty()
    elif name.startswith("op13"):
        assert n == 5 * table(spark, DATA, "embeddings").filter(F.col("vec_id") % 50 == 0).count()
    elif name.startswith("op2"):
        assert n == table(spark, DATA, "conversations").select("conv_id").distinct().count() + 1
    else:
        assert n == table(spark, DATA, "pages" if name.startswith("op7") else "documents").count()
