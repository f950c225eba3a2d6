import itertools
import random

from tagloom.llm import decontaminate as d

ITEM = "A train leaves Boston at 9 and travels 120 km in 3 hours, so what is its average speed in km per hour?"


def hits(text, items=((1, ITEM),), spec=d.Spec()):
    return {m[0] for m in d.Probe(list(items), spec).matches(d.Canon(), text)}


def test_verbatim_and_reparameterised():
    assert hits(f"Some words first. {ITEM} And words after.") == {1}
    assert hits(ITEM.upper()[:1] + ITEM[1:].replace("120", "250").replace(" 9 ", " 7 ").replace(" 3 ", " 5 ").replace("Boston", "Denver")) == {1}
    assert hits("\n".join(ITEM.replace(",", " ,").split())) == {1}


def test_slots_must_correspond():
    text = "the value 5 goes to box one side, then value 5 comes back to that box again and value 6 stays in place there"
    assert hits(text.replace("5", "8").replace("6", "9"), [(1, text)]) == {1}
    assert hits(text.replace("5", "8", 1), [(1, text)]) == set() or d.Probe([(1, text)], d.Spec()).matches(d.Canon(), text.replace("5", "8", 1))[0][2] < 1
    p = d.Probe([(1, text)], d.Spec())
    tokens, slots, raw = d.Canon().tokens(text.replace("5", "8", 1))
    kept, _ = p._consistent(p.item(0, d.Canon()), 0, list(range(len(tokens) - 7)), slots, raw)
    assert len(kept) < len(tokens) - 7


APPLES = "Alice has 5 apples. Alice eats 2 apples. How many are left?"


def test_names_that_begin_sentences():
    assert hits(APPLES.replace("Alice", "Bob").replace("5", "7").replace("2", "3"), [(1, APPLES)]) == {1}
    assert hits(f"Before it. {APPLES.replace('Alice', 'Bob')} After it.", [(1, APPLES)]) == {1}
    assert hits("First Bob has 5 apples. Then Bob eats 2 apples. How many are left?", [(1, APPLES)]) == hits("", [(1, APPLES)])  # other words
    # one name can't stand for two, and opening words are no names
    two = "Alice gives 5 pens to her friend. Berta gives 2 pens to her friend. Alice has 9 pens at the end of it."
    assert hits(two.replace("Alice", "Carol").replace("Berta", "Dora"), [(1, two)]) == {1}
    question = "What is the largest city of the country that France borders on?"
    assert hits("Paris is the capital of Spain", [(1, "What is the capital of France")]) == set()
    assert hits(question.replace("France", "Spain"), [(1, question)]) == {1}
    low = "the largest ship in the port of Hamburg carries 40 boats to the sea"
    assert hits("The largest ship in the port of Bremen carries 50 boats to the sea", [(1, low)]) == {1}


def test_formulas_with_and_without_spaces():
    item = "Solve the equation x+3=7 for x and then say what 2*x-1 is, if the answer is a whole number"
    for spaced in (item.replace("x+3=7", "x + 3 = 7"), item.replace("x+3=7", "x+ 3 =7").replace("2*x-1", "2 * x - 1"), item.replace("2*x-1", "2*x -1")):
        assert hits(spaced, [(1, item)]) == {1} and hits(item, [(1, spaced)]) == {1}
    assert hits(item.replace("x+3=7", "x + 5 = 9"), [(1, item)]) == {1}
    assert d.cut("https://a.b/c=d+e") == ["https://a.b/c=d+e"] and d.cut("well-known") == ["well-known"] and d.cut("=") == ["="]
    assert d.cut("2020-01-02") == ["2020", "01", "02"] and d.cut("3.5") == ["3.5"] and d.cut("a=b") == ["a", "b"]


def test_clean_texts_stay():
    assert hits("A train leaves the station and nobody knows when it will ever come back to the village.") == set()
    assert hits("1 2 3 4 5 6 7 8 9 10 11 12 13 14", [(1, "9 8 7 6 5 4 3 2 1 0 11 12 13 14")]) == set()
    assert hits(None) == hits("") == set()


def test_short_and_empty_items():
    short = [(1, "What is love?"), (2, None), (3, ""), (4, "Paris"), (5, "42 km"), (6, "is 5 here")]
    assert hits("x what is love y", short) == {1} and hits("WHAT IS LOVE", short) == {1}
    assert hits("they went to Paris by a 42 km road", short) == set()
    assert hits("PARIS!", short) == {4} and hits(" 42 Km.", short) == {5}
    assert hits("what is life", short) == hits("it is 6 here", short) == set() and hits("it is 5 here", short) == {6}
    assert hits("and what is true love then", [(1, "what is true love")]) == {1}


def brute(docs, items):
    """Token by token: an item's longest verbatim run (all tokens are plain lower-case words here)."""
    out = set()
    for doc, text in docs:
        w = (text or "").split()
        for item, it in items:
            v = it.split()
            need = min(13, len(v))
            grams = {tuple(v[i : i + need]) for i in range(len(v) - need + 1)}
            share = sum(tuple(v[i : i + 8]) in {tuple(w[k : k + 8]) for k in range(len(w) - 7)} for i in range(len(v) - 7)) / (len(v) - 7)
            if any(tuple(w[i : i + need]) in grams for i in range(len(w) - need + 1)) or share >= 0.5:
                out.add((doc, item))
    return out


def test_query_is_the_brute_forces(spark):
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(500)]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(9, 40)))) for i in range(30)]
    docs = []
    for k in range(120):
        text = [rng.choice(words) for _ in range(rng.randint(0, 80))]
        if rng.random() < 0.6:
            own = rng.choice(items)[1].split()
            start = rng.randint(0, len(own) // 2)
            text[len(text) // 2 : len(text) // 2] = own[start : start + rng.randint(5, 40)]
        docs.append((k, " ".join(text), "x"))
    df = spark.createDataFrame([*docs, (200, None, "x"), (200, None, "x")], "doc_id long, text string, item_id string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute([x[:2] for x in docs], items)
    assert 20 < len(want)
    for spec in (d.Spec(), d.Spec(block_windows=100)):
        assert {(r.doc_id, r.item_id) for r in d.contaminations(df, bench, spec).collect()} == want
    kept = d.clean(df, bench, d.Spec(block_windows=200))
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {x[0] for x in docs} - {x for x, _ in want} | {200}
    empty = spark.createDataFrame([], "item_id long, text string")
    assert d.contaminations(df, empty).count() == 0 and d.clean(df, empty).count() == df.count()
    assert d.contaminations(spark.createDataFrame([], df.schema), bench).count() == 0


def test_copies_in_another_case():
    upper, lower, title = ITEM.upper(), ITEM.lower(), ITEM.title()
    for copy in (upper, lower, title, f"and so {upper} he said", f"someone asked whether {title} or so", f"nobody knew that {lower} at all"):
        assert hits(copy) == {1}, copy
        assert d.Probe([(1, ITEM)], d.Spec()).matches(d.Canon(), copy)[0][3] == 0, copy
    short = "What is the true capital of my country"
    for copy in (f"they asked What is the true capital of my country and left", short.upper(), short.title(), short.lower()):
        assert hits(copy, [(1, short)]) == {1}, copy
    assert hits("STRASSE UND HAUS UND HOF AM SEE", [(1, "Straße und Haus und Hof am See")]) == {1}
    assert hits("THE BOAT LEAVES BOSTON AT 9 AND CARRIES 120 PEOPLE IN 3 ROWS, SO WHO IS IT") == set()


def test_plain_hits_take_nothing_from_typed_ones():
    words = "red box on the floor holds 5 balls and the blue box by the door holds 5 balls of wool and a green box holds 5 balls more"
    told = words.replace("5", "8", 2)  # the last value is the item's own
    got = d.Probe([(1, words)], d.Spec()).matches(d.Canon(), told)
    assert [m[0] for m in got] == [1] and got[0][3] == 1


def test_items_dense_in_placeholders():
    series = "1 1 2 3 5 8 13 21 34 55 89 144 233 377 610"
    sums = "12 plus 30 is 42 and 7 times 6 is 42 and 84 over 2 is 42 too"
    title = "Which River Flows Through The City Of Paris And Into The English Channel"
    shout = "WHICH RIVER FLOWS THROUGH PARIS AND ON TO THE CHANNEL AT LE HAVRE"
    short = "3 kg 5 kg"
    for item in (series, sums, title, shout, short):
        for copy in (f"so they said {item} and went home", item.upper(), item.lower()):
            assert hits(copy, [(1, item)]) == {1}, (item, copy)
            assert d.Probe([(1, item)], d.Spec()).matches(d.Canon(), copy)[0][2:] == (1.0, 0), copy
    # The limit stays for other values: numbers alone are no template.
    assert hits("2 2 4 6 10 16 26 42 68 110 178 288 466 754 1220", [(1, series)]) == set()
    assert hits("Some Lake Lies Beyond The Town Of Geneva And Under The Swiss Mountains", [(1, title)]) == set()


def test_dense_windows_keep_runs_whole():
    # A dense stretch within an item used to break the run, and its windows still counted in the share.
    item = "please sort these values into order for me 9 8 7 6 5 4 3 2 1 0 and then tell me which of them is least"
    assert d.Probe([(1, item)], d.Spec()).matches(d.Canon(), item)[0][1:3] == (len(item.split()) - 7, 1.0)


def test_new_values_may_be_equal_and_one_chance_pair_does_little():
    changed = ITEM.replace("120", "7").replace(" 9 ", " 7 ").replace(" 3 ", " 7 ")
    assert hits(changed) == {1}
    text = "box 5 on the left wall holds more than box 5 on the right wall and so we open box 5 first before we close box 5 again at noon"
    told = text.replace("5", "9", 1).replace(" 5", " 8")
    got = d.Probe([(1, text)], d.Spec()).matches(d.Canon(), told)
    assert [m[0] for m in got] == [1] and got[0][3] == 1


def naive(docs, items, spec):
    """By definition, token by token, on its own tokens: windows over typed and plain tokens at every alignment."""

    def parse(text):
        out, begins = [], True
        for raw in (text or "").split():
            core = raw.strip(".,!?:;()'")
            if not core:
                continue
            low = core.lower()
            kind = "#n" if low.replace(".", "").isdigit() else "#u" if low in ("km", "kg", "hours") else "#a" if core[0].isupper() and not begins else None
            out.append((kind or low, low, kind is not None))
            begins = raw[-1] in ".!?:"
        return out

    found = set()
    for doc, text in docs:
        t = parse(text)
        for item, it in items:
            v = parse(it)
            w = min(spec.window, len(v))
            best = 0
            for shift in range(-len(v) + 1, len(t)):
                at = [q for q in range(len(v) - w + 1) if 0 <= q + shift and q + shift + w <= len(t)]
                plain = [q for q in at if all(v[i][1] == t[i + shift][1] for i in range(q, q + w))]
                few = [q for q in at if sum(v[i][2] for i in range(q, q + w)) <= min(spec.max_slots, w // 2)]
                typed = [q for q in few if all(v[i][0] == t[i + shift][0] for i in range(q, q + w))]
                for starts, fixed in ((plain, plain), (sorted({*plain, *typed}), plain), (typed, [])):
                    votes = {}
                    for i in sorted({i for q in starts if q not in fixed for i in range(q, q + w) if v[i][2]}):
                        votes.setdefault(v[i][1], []).append(t[i + shift][1])
                    bind = {a: max(b, key=lambda x, b=b: (b.count(x), -b.index(x))) for a, b in votes.items()}
                    bind |= {v[i][1]: v[i][1] for q in fixed for i in range(q, q + w) if v[i][2]}
                    kept = [q for q in starts if q in fixed or all(bind[v[i][1]] == t[i + shift][1] for i in range(q, q + w) if v[i][2])]
                    run = max((len(list(g)) for _, g in itertools.groupby(enumerate(kept), lambda x: x[1] - x[0])), default=1 - w) + w - 1
                    best = max(best, run / min(spec.min_run, len(v)), len(kept) / (len(v) - w + 1) / spec.share)
            if best >= 1:
                found.add((doc, item))
    return found


def test_templates_are_the_naive_ones():
    rng = random.Random(9)
    words = "the train boat box from town to river holds takes and then after before how many of red blue green does it all".split()
    names = ["Boston", "Denver", "Anna", "Rome"]

    def say(n):
        return " ".join(rng.choice((*words, *words, str(rng.randint(1, 9)), "km", "kg", rng.choice(names))) + ("." if rng.random() < 0.05 else "") for _ in range(n))

    items = [(i, say(rng.randint(9, 30))) for i in range(25)]
    docs = []
    for k in range(250):
        own = rng.choice(items)[1].split()
        own = own[rng.randint(0, 3) : len(own) - rng.randint(0, 3)]
        way = k % 5
        swap = {str(i): str(rng.randint(1, 9)) for i in range(1, 10)} | {a: rng.choice(names) for a in names}
        if way == 1:
            own = [swap.get(x, x) for x in own]
        elif way == 2:
            own = [rng.choice(names) if x in names and rng.random() < 0.4 else str(rng.randint(1, 9)) if x.isdigit() and rng.random() < 0.5 else x for x in own]
        elif way == 3:
            own = [x.upper() if rng.random() < 0.5 else x for x in own]
        elif way == 4:
            own = [rng.choice(words) if rng.random() < 0.08 else x for x in own]
        docs.append((k, " ".join([say(rng.randint(0, 6)), *own, say(rng.randint(0, 6))])))
    probe, canon = d.Probe(items, d.Spec()), d.Canon()
    got = {(k, m[0]) for k, t in docs for m in probe.matches(canon, t)}
    want = naive(docs, items, d.Spec())
    assert got == want and 100 < len(want) < 250
