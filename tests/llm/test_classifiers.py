import random

import numpy as np
from pyspark.sql import functions as F

from tagloom.llm import labelled, language_id, quality_qda, toxicity
from tagloom.llm.common import crc_mod

LANGS = {
    "en": "the quick brown fox jumps over a lazy dog while people walk through the town and talk about weather or work with their friends".split(),
    "de": "der schnelle braune fuchs springt über den faulen hund während leute durch die stadt gehen und über das wetter oder die arbeit reden".split(),
    "fr": "le rapide renard brun saute par dessus le chien paresseux pendant que les gens marchent dans la ville et parlent du temps avec leurs amis".split(),
}


def test_automaton_knows_exactly_the_substrings():
    s = [1, 2, 1, 1, 2, 3, 1, 2]
    step = language_id.suffix_automaton(s)
    subs = {tuple(s[i:k]) for i in range(len(s)) for k in range(i, len(s) + 1)}
    rng = random.Random(1)
    for _ in range(2000):
        t = tuple(rng.randint(1, 3) for _ in range(rng.randint(0, 5)))
        state = 0
        for c in t:
            state = step[state].get(c) if state is not None else None
        assert (state is not None) == (t in subs)


def test_phrases_are_the_greedy_parses():
    rng = random.Random(2)
    m = language_id.Model([], np.array([97, 98, 99]), stretch=16)
    train = [rng.randint(0, 3) for _ in range(60)]
    m.learn("x", np.array(train))
    text = "".join(map(chr, train))
    for _ in range(300):
        t = [rng.randint(0, 4) for _ in range(16)]
        count, phrase = 1, ""
        for c in t:
            if phrase + chr(c) in text:
                phrase += chr(c)
            else:
                count += 1
                phrase = chr(c) if chr(c) in text else ""
        assert m.phrases(np.array(t, np.int32)[:, None])[0, 0] == count


def test_language_predictions(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice(LANGS[k]) for _ in range(rng.randint(8, 60))).title(), k) for i, k in enumerate(list(LANGS) * 80)]
    extra = [(900, None, "en"), (901, "123 --- 😀", "en"), (902, "", None), (903, "the people walk and talk " * 3000, None), (904, "日本語", "ja"), (1, rows[1][1], "de")]
    df = spark.createDataFrame(rows + extra, "doc_id long, text string, lang string").repartition(3)
    model = language_id.fit(df.filter(crc_mod(F.col("doc_id"), 4) != 2))
    got = {r.doc_id: r for r in language_id.predictions(df, model).collect()}
    assert sum(got[i].lang_pred == k for i, _, k in rows) >= 0.99 * len(rows)
    assert [got[i].lang_pred for i in (900, 901, 902, 903)] == ["und", "und", "und", "en"] and got[900].score == 0
    assert all(0 <= r.score <= 1 for r in got.values())
    empty = language_id.fit(spark.createDataFrame([], df.schema))
    assert {r.lang_pred for r in language_id.predictions(df, empty).collect()} == {"und"}


def test_training_texts_are_sampled_throughout(spark):
    # Each text starts with a long passage of French; only what follows tells.
    rng = random.Random(6)
    say = lambda k, n: " ".join(rng.choice(LANGS[k]) for _ in range(n))
    rows = [(i, f"{say('fr', 1200)} {say(k, 9000)}", k) for i, k in enumerate(["en", "de"] * 9)]
    model = language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    tests = [(i, say(k, 40), k) for i, k in enumerate(["en", "de"] * 40)]
    got = language_id.predictions(spark.createDataFrame(tests, "doc_id long, text string, lang string"), model).collect()
    assert sum(r.lang_pred == tests[r.doc_id][2] for r in got) >= 0.99 * len(tests)
    # Half of the sample at least is what follows: French is not nearer than it.
    assert language_id.Identifier(model).of([say("en", 200)]).__next__()[1] > 0.3


def test_scripts_have_alphabets_of_their_own(spark):
    # 100 letters of a common script used to leave those of rarer scripts one symbol together.
    rng = random.Random(7)
    scripts = {"aa": (0x4E00, 120), "bb": (0x0621, 26), "cc": (0x0905, 30)}
    pick = lambda k: chr(scripts[k][0] + rng.randrange(scripts[k][1]))
    say = lambda k, n: " ".join(pick(k) + pick(k) + pick(k) for _ in range(n))
    rows = [(i, say(k, 800 if k == "aa" else 20), k) for i, k in enumerate(list(scripts) * 15)]
    model = language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    tests = [(i, say(k, 25), k) for i, k in enumerate(list(scripts) * 30)]
    got = {r.doc_id: r.lang_pred for r in language_id.predictions(spark.createDataFrame(tests, "doc_id long, text string, lang string"), model).collect()}
    assert sum(got[i] == k for i, _, k in tests) >= 0.97 * len(tests)


def test_discriminant_against_the_formula():
    rng = np.random.default_rng(4)
    x = np.concatenate((rng.normal(0, 1, (200, 3)), rng.normal(1, 2, (300, 3))))
    y = np.array([0] * 200 + [1] * 300)
    m = quality_qda.fit_arrays(x, y, 0.2)
    pooled = np.diag(sum(((x[y == k] - x[y == k].mean(0)) ** 2).sum(0) for k in (0, 1)) / 500) + 1e-4 * np.eye(3)
    logs = []
    for k in (0, 1):
        own = x[y == k]
        cov = 0.8 * np.cov(own.T, bias=True) + 0.2 * pooled
        diff = x - own.mean(0)
        logs.append(-0.5 * np.einsum("ij,jk,ik->i", diff, np.linalg.inv(cov), diff) - 0.5 * np.linalg.slogdet(cov)[1] + np.log((y == k).mean()))
    assert np.allclose(m.scores(x), 1 / (1 + np.exp(logs[0] - logs[1])))


def naive_statistics(text):
    """The twelve statistics by their definitions, character by character."""
    n = dict.fromkeys(("lower", "upper", "digit", "space", "symbol", "stop", "loud", "other"), 0)
    for c in text:
        kind = "symbol" if c in quality_qda.SYMBOLS else "stop" if c in ".,;:'-" else "loud" if c in "!?" else "space" if c.isspace() else "digit" if c.isdigit() else ("upper" if c.isupper() else "lower") if c.isalpha() else "other"
        n[kind] += 1
    words = text.split()
    count, chars = max(1, len(words)), max(1, len(text) - n["space"])
    lines = [x for x in text.split("\n") if x.strip()]
    again = sum(words[i] == words[i - 1] for i in range(1, len(words)))
    alone = sum(len(w) == 1 and not w.isalnum() for w in words)
    shares = [n["symbol"] / chars, n["upper"] / chars, n["digit"] / chars, n["loud"] / chars, n["stop"] / chars, n["other"] / chars]
    ends = [again / count, (len(lines) - len(set(lines))) / max(1, len(lines)), alone / count]
    return [np.log(1 + len(words)), np.log(1 + chars / count), *np.sqrt(shares), np.log((len(set(words)) + 1) / (count + 1) ** 0.75), *np.sqrt(ends)]


def test_statistics_are_the_naive_ones():
    rng = random.Random(12)
    parts = ["Word", "word", "the", "ÉCOLE", "straße", "日本", "½", "٣", "42", "#", "$$", "!", "?!", "|", "-", "a,b", "\n", "\n\n", "\t", "\u3000", "😀", "\x00", "line\n", "{x}"]
    for _ in range(500):
        text = "".join(rng.choice(parts) + rng.choice(("", " ", " ")) for _ in range(rng.randint(0, 40)))
        assert np.allclose(quality_qda.statistics(text), naive_statistics(text)), repr(text)


def _held_out(spark, operator, label, good, bad, mod):
    rng = random.Random(5)
    rows, marks = [], []
    for i in range(500):
        y = int(rng.random() < 0.5)
        rows.append((i, (good if y == 0 else bad)(rng), "clash"))
        marks.append((i, y if rng.random() > 0.02 else 1 - y, "clash"))
    df = spark.createDataFrame([*rows, (900, None, ""), (901, "", ""), (902, "word " * 20_000, ""), (None, "x", "")], "doc_id long, text string, label string").repartition(3)
    labels = spark.createDataFrame([*marks, (None, 1, ""), (3, None, "")], f"doc_id long, {label} int, text string")
    sample = labelled.sample(df, labels, label, crc_mod(F.col("id"), mod) != 1)
    got = {r.doc_id: r for r in operator.scores(df, operator.fit(sample)).collect()}
    assert len(got) == 504 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    truth = dict((a, b) for a, b, _ in marks)
    assert sum(got[i].predicted == truth[i] for i in range(500)) > 0.95 * 500
    nothing = operator.fit(labelled.sample(df, labels.limit(0), label))
    assert len({r.doc_id for r in operator.scores(df, nothing).collect()}) == 504
    assert operator.scores(spark.createDataFrame([], df.schema), nothing).count() == 0
    assert labelled.sample(df, labels, label, limit=7).count() == 7


def test_quality(spark):
    prose = lambda rng: " ".join(rng.choice(LANGS["en"]) for _ in range(rng.randint(20, 80))).capitalize() + "."
    junk = lambda rng: " ".join(rng.choice(LANGS["en"]).upper() + rng.choice(("!!", "###", "|", "$$$")) for _ in range(rng.randint(20, 80)))
    # labels here mark junk as 1
    _held_out(spark, quality_qda, "quality", prose, junk, 3)


def test_toxicity(spark):
    clean = lambda rng: " ".join(rng.choice(LANGS[rng.choice(list(LANGS))]) for _ in range(rng.randint(10, 60)))
    toxic = lambda rng: clean(rng) + " you " + rng.choice(("idiot", "grobianisch", "grobianhaft", "IDI0T", "vilain")) + " " + clean(rng)
    _held_out(spark, toxicity, "toxic", clean, toxic, 5)


def test_folding_and_exceptions():
    m = toxicity.Matcher(toxicity.Model({"idiot": 3.0, "trash": 3.0, "grob*": 2.0}))
    for t in ("an IDIOT!", "1d10t", "іdіоt", "ïdiöt", "ｉｄｉｏｔ", "i​diot"):
        assert m.sums(t)[0] == 3.0, t
    assert m.sums("idiotic idiots preidiot")[0] == 0
    assert m.sums("grob grobian groß")[0] == 4.0
    assert m.sums("put it in the trash can") == (0, 6, 0) and m.sums("trash, trash can")[0] == 3.0
    assert m.sums(None) == m.sums("") == (0, 0, 0)


def naive_sums(terms, text):
    """The matcher by definition: at each place of the folded text every term is tried."""
    t = toxicity.fold(text)
    spared = set()
    for phrase in toxicity.EXCEPTIONS:
        for i in range(len(t)):
            if t.startswith(phrase, i) and (i == 0 or not t[i - 1].isalpha()) and not t[i + len(phrase) : i + len(phrase) + 1].isalpha():
                spared |= set(range(i, i + len(phrase)))
    total, top = 0.0, 0.0
    for i in range(len(t)):
        if i and t[i - 1].isalpha() or i in spared:
            continue
        best = 0.0
        for term, weight in terms.items():
            core = term.rstrip("*")
            if t.startswith(core, i) and (term.endswith("*") or not t[i + len(core) : i + len(core) + 1].isalpha()):
                best = max(best, weight)
        total, top = total + best, max(top, best)
    return total, len(t.split()), top


def test_matcher_is_the_naive_one():
    rng = random.Random(8)
    terms = {"idiot": 3.0, "trash": 2.5, "clown": 2.75, "clow*": 1.5, "grob*": 2.0, "grobi*": 2.25, "ab": 1.0, "abc": 4.0, "a*": 0.5, "stupid": 3.5}
    m = toxicity.Matcher(toxicity.Model(terms))
    parts = [*"ab", "abc", "abcd", "clown", "clowns", "class clown", "clown fish", "1d10t", "ïdiot", "idiot", "trash", "trash can", "trash cans", "grobian", "grob", "stupid question", "stupid", "STUPID", " ", " ", " ", ",", "\n", "-", "é", "4", "😀"]
    hits = 0
    for _ in range(3000):
        text = "".join(rng.choice(parts) + rng.choice(("", " ", " ")) for _ in range(rng.randint(0, 12)))
        got, want = m.sums(text), naive_sums(terms, text)
        assert abs(got[0] - want[0]) < 1e-9 and got[1:] == want[1:], text
        hits += any(x in toxicity.fold(text) for x in toxicity.EXCEPTIONS)
    assert hits > 500


def test_toxic_terms_weights_and_scores_are_recomputed(spark):
    rng = random.Random(10)
    vocabulary = [w for k in LANGS for w in LANGS[k]]
    rows = []
    for i in range(300):
        y = int(rng.random() < 0.4)
        text = [rng.choice(vocabulary) for _ in range(rng.randint(3, 30))]
        if y:
            text.insert(rng.randint(0, len(text)), rng.choice(("1D10T", "grobianhaft", "grobianisch", "trash", "vilain!")))
        elif rng.random() < 0.2:
            text.append("trash can")
        rows.append((i, " ".join(text), y))
    spec = toxicity.Spec()
    model = toxicity.fit(spark.createDataFrame(rows, "id long, text string, label int").repartition(3), spec)
    sizes = [sum(y == k for _, _, y in rows) for k in (0, 1)]
    seen = {}
    for _, t, y in rows:
        own = {w.strip("!") for w in toxicity.fold(t).split()}
        own = {w for w in own if 3 <= len(w) <= 40}
        for w in own | {w[:k] + "*" for w in own for k in (4, 5, 6, 7) if len(w) > k}:
            seen.setdefault(w, [0, 0])[y] += 1
    want = {w: float(np.log((b + 0.5) / (sizes[1] + 1)) - np.log((a + 0.5) / (sizes[0] + 1))) for w, (a, b) in seen.items() if b >= spec.least_support}
    want = {w: x for w, x in want.items() if x >= spec.least_weight}
    assert model.terms.keys() == want.keys() and {"idiot", "grobian*"} <= want.keys() and all(abs(model.terms[w] - x) < 1e-4 for w, x in want.items())
    x = []
    for _, t, _ in rows:
        total, n, top = naive_sums(model.terms, t)
        x.append((1.0, np.log1p(total), np.log1p(100 * total / max(1, n)), top))
    x, y, w = np.array(x), np.array([r[2] for r in rows]), np.array(model.logistic)
    gradient = x.T @ (y - 1 / (1 + np.exp(-x @ w))) - np.array([1e-6, 1, 1, 1]) * w
    assert np.abs(gradient).max() < 1e-4  # the ridge optimum
    got = {r.doc_id: r.score for r in toxicity.scores(spark.createDataFrame(rows, "doc_id long, text string, label int"), model).collect()}
    assert all(abs(got[i] - 1 / (1 + np.exp(-x[i] @ w))) < 1e-9 for i in range(len(rows)))
