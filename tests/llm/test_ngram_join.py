import random
import re

import numpy as np
import pytest

from tagloom.llm import ngram_join as j
from tagloom.llm.components import Forest, components

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def shingle_set(t):
    w = WORD.findall((t or "").encode().lower())
    return frozenset(tuple(w[i : i + 4]) for i in range(len(w) - 3)) if len(w) >= 4 else frozenset([tuple(w)] if w else [])


def brute(docs):
    sets = {d: shingle_set(t) for d, t in docs}
    up = {d: d for d in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            n = len(sets[a] & sets[b])
            if n and 100 * n >= 85 * (len(sets[a]) + len(sets[b]) - n):
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), root(d)) for d in ids}


def corpus(seed, groups=14, copies=8):
    """Chains of near copies with one to many changed words, a passage that all share, and short texts."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(4000)]
    passage = [rng.choice(vocabulary) for _ in range(25)]
    docs = []
    for _ in range(groups):
        words = [rng.choice(vocabulary) for _ in range(rng.choice((6, 12, 30, 60, 150, 400)))]
        at = rng.randrange(len(words) + 1)
        words[at:at] = passage if rng.random() < 0.5 else []
        for _ in range(copies):
            docs.append(" ".join(words).title() if rng.random() < 0.2 else " ".join(words))
            words = list(words)
            for _ in range(rng.choice((0, 1, 1, 2, 3, len(words) // 20))):
                kind, at = rng.randrange(3), rng.randrange(len(words))
                words[at : at + (kind != 0)] = [] if kind == 1 else [rng.choice(vocabulary)]
    docs += ["", " \t", "one", "One", "one two three", "one two three", "a b c d", "a b c d e", "É x y z", "é x y z", None]
    rng.shuffle(docs)
    return list(enumerate(docs))


@pytest.mark.parametrize(("seed", "spec"), [(1, j.JoinSpec()), (2, j.JoinSpec(block_elements=300, pivots=1, buffer=500)), (3, j.JoinSpec(block_elements=150, pivots=0, leaf=2, fan=2)), (4, j.JoinSpec(cell=3)), (5, j.JoinSpec(cell=1)), (6, j.JoinSpec(cell=5, block_elements=500))])
def test_components_are_the_brute_forces(spark, seed, spec):
    docs = corpus(seed)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in j.linked_documents(df, spec).collect()}
    assert got == brute(docs)


def test_edge_cases(spark):
    rows = [(5, "a b c d e", 1), (5, "a b c d e", 1), (7, "a b c d e", 2), (None, "a b c d e", 3), (9, None, 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, doc int").withColumnRenamed("doc", "node")
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id) for r in j.linked_documents(df).collect())
    assert got[0][:2] == (0, 2) and got[1:] == [(5, 2, 5), (5, 2, 5), (7, 2, 5), (9, 0, 9)]
    kept = j.one_of_each(df)
    assert kept.columns == df.columns and sorted((r.doc_id or 0) for r in kept.collect()) == [0, 5, 9]
    assert j.linked_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_signatures_meet_for_every_linked_pair():
    bands, rng = j.Bands(j.JoinSpec()), np.random.default_rng(1)
    for _ in range(400):
        n = int(rng.choice([6, 7, 9, 15, 40, 100, 300, 1500]))
        pool = np.unique(rng.integers(0, 2**64, 2 * n + 10, dtype=np.uint64))
        rng.shuffle(pool)
        drop, add = (int(rng.integers(0, n // 6 + 2)) for _ in range(2))
        a, b = np.sort(pool[:n]), np.sort(np.concatenate((pool[drop:n], pool[n : n + add])))
        both = len(np.intersect1d(a, b))
        if 100 * both >= 85 * (len(a) + len(b) - both):
            (x, slack), (y, other) = bands.signatures(a), bands.signatures(b)
            met = len(np.intersect1d(x, y))
            assert met > max(slack, other, 0), (len(a), len(b), both)  # even if as many groups as the slack are passed over


def test_tree_misses_no_link():
    rng, spec = np.random.default_rng(2), j.JoinSpec(leaf=2, fan=2)
    base = [np.unique(rng.integers(0, 2**64, 60, dtype=np.uint64)) for _ in range(5)]
    sets = [np.sort(rng.choice(b, int(len(b) * rng.uniform(0.85, 1)), replace=False)) for b in base for _ in range(12)]
    tree = j.CountTree(np.array([j.counts(s, 64) for s in sets]), np.array([len(s) for s in sets]), spec)
    for i, a in enumerate(sets):
        near = set(tree.near(i).tolist())
        for k, b in enumerate(sets):
            both = len(np.intersect1d(a, b))
            assert 100 * both < 85 * (len(a) + len(b) - both) or k in near


def test_components(spark):
    links = [(i, i + 1) for i in range(200)] + [(1000, 1001), (1002, 1001), (5, 5)]
    rng = random.Random(3)
    rng.shuffle(links)
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long").repartition(7)).collect()}
    assert got == {i: 0 for i in range(201)} | {1000: 1000, 1001: 1000, 1002: 1000}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_one_id_with_different_texts(spark):
    from tagloom.llm import ngram_join

    texts = ["one text about boats and lakes and rivers", "another text of bread and salt and butter"]
    rows = [(5, texts[0]), (5, texts[1]), (5, texts[0]), (6, texts[0]), (7, "some third text that stands quite alone here")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted((r.doc_id, r.text) for r in ngram_join.one_of_each(df).collect())
    assert got == sorted([(5, texts[0]), (5, texts[1]), rows[-1]])


@pytest.mark.parametrize("kind", ["path", "star", "random", "tree", "none"])
def test_components_are_union_finds(spark, kind):
    rng = random.Random(kind)
    n = 400
    links = {
        "path": [(i, i + 1) for i in range(n)],
        "star": [(7, i) for i in range(n)] + [(n + i, 2 * n) for i in range(50)],
        "random": [(rng.randrange(n), rng.randrange(n)) for _ in range(n // 2)],
        "tree": [(i, i // 2) for i in range(1, n)] + [(-5, -5), (-9, -2)],
        "none": [],
    }[kind]
    rng.shuffle(links)
    forest = Forest()
    for a, b in links:
        forest.join(a, b)
    nodes = {x for a, b in links if a != b for x in (a, b)}
    df = spark.createDataFrame(links, "a long, b long").repartition(7)
    assert {(r.node, r.root) for r in components(df).collect()} == {(x, forest.root(x)) for x in nodes}
