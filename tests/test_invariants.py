import random

import pytest

from tagloom.functions import mutate
from tagloom.functions.html_tree import parse, serialise
from tagloom.functions.invariants import differences

PAGE = '<!DOCTYPE html><html lang="en"><head><meta charset="utf-8"><title>T &amp; t</title><style>p{margin:0}</style></head><body><nav><ul><li><a href="/a" class="x y">a</a></li></ul></nav><!-- ad --><div class="ad">one</div><article><h1>Two</h1><p><b>three<br><p style="top:0">four\nfive</p></article></body></html>'


@pytest.mark.parametrize("profile", ["standard", "exploratory"])
def test_steps_explain_their_own_changes(profile):
    seen = set()
    for v in range(300):
        html, _, applied = mutate.vary(PAGE, 42, "b", v, profile)
        found = differences(PAGE, html, profile)
        assert found is not None and found - {"pretty"} == set(applied) - {"pretty"}
        seen |= found
    assert seen == {n for n, _ in mutate.GATES[profile]}


def edits():
    yield "text", lambda s: s.replace("four", "for")
    yield "text gone", lambda s: s.replace("one</div>", "</div>")
    yield "order", lambda s: s.replace('<div class="ad">one</div>', "").replace("</article>", '</article><div class="ad">one</div>')
    yield "name of a tag", lambda s: s.replace("<h1>", "<h2>").replace("</h1>", "</h2>")
    yield "tag gone", lambda s: s.replace("<h1>Two</h1>", "Two")
    yield "another tag", lambda s: s.replace("<h1>", "<i>!</i><h1>")
    yield "another wrapper", lambda s: s.replace("<article>", '<div class="else"><article>').replace("</article>", "</article></div>")
    yield "attribute", lambda s: s.replace('href="/a"', 'href="/b"')
    yield "attribute gone", lambda s: s.replace(' href="/a"', "")
    yield "another attribute", lambda s: s.replace("<h1", '<h1 onclick="x"')
    yield "class replaced", lambda s: s.replace('class="x y', 'class="auto-1234')
    yield "comment", lambda s: s.replace("<h1", "<!-- else --><h1")
    yield "comment gone", lambda s: s.replace("<!-- ad -->", "")
    yield "style sheet", lambda s: s.replace("</head>", "<style>b { color: red }</style></head>")
    yield "cut", lambda s: s[: len(s) // 2]


@pytest.mark.parametrize("name, change", list(edits()))
def test_other_changes_are_not_explained(name, change):
    rng = random.Random(name)
    plain = serialise(parse(PAGE))
    assert change(plain) != plain and differences(PAGE, change(plain)) is None
    for v in rng.sample(range(1000), 20):
        html, _, _ = mutate.vary(plain, 42, "b", v)
        if change(html) != html and name not in ("class replaced", "another wrapper"):
            assert differences(plain, change(html)) is None


def test_equal_pages_have_no_differences():
    for page in (PAGE, "", None, "<p>a", "x"):
        assert differences(page, page or "") == set()
    assert differences("<p>a</p><div>b</div>", "<p>a</p>\n<div>b</div>") == {"whitespace"}
