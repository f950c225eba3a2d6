"""The tree of a page against what the HTML standard prescribes, rule by rule."""

import random
import time

import pytest

from tagloom.functions import extract
from tagloom.functions.dom import Page
from tagloom.functions.html_tree import serialise


def body(html):
    return serialise(Page(html).body)


@pytest.mark.parametrize(
    "html, want",
    [
        # a paragraph ends at the next block, and an end tag without one makes an empty paragraph
        ("<p>a<p>b<div>c</div>d", "<p>a</p><p>b</p><div>c</div>d"),
        ("<p>a<h2>b</h2>c", "<p>a</p><h2>b</h2>c"),
        ("<div>a</p>b</div>", "<div>a<p></p>b</div>"),
        ("<p>a<span>b</p>c</span>d", "<p>a<span>b</span></p>cd"),
        ("<p><button><p>a</button>b", "<p><button><p>a</p></button>b</p>"),
        ("<article><p>a</article>b", "<article><p>a</p></article>b"),
        ("<p>a<hr>b", "<p>a</p><hr/>b"),
        ("<p>a<ul><li>b</ul>c", "<p>a</p><ul><li>b</li></ul>c"),
        # lists
        ("<ol><li>one<li>two<li>three</ol>", "<ol><li>one</li><li>two</li><li>three</li></ol>"),
        ("<ul><li>a<ul><li>b</ul>c<li>d</ul>", "<ul><li>a<ul><li>b</li></ul>c</li><li>d</li></ul>"),
        ("<ul><li><p>a<li><div>b<li>c</ul>", "<ul><li><p>a</p></li><li><div>b</div></li><li>c</li></ul>"),
        ("<dl><dt>a<dd>b<dt>c</dl>", "<dl><dt>a</dt><dd>b</dd><dt>c</dt></dl>"),
        # headings close each other, and each other's end tags close them
        ("<h1>a<h2>b</h1>c", "<h1>a</h1><h2>b</h2>c"),
        # formatting goes on in the next block, and is closed out of order by the adoption agency
        ("<p><b>x<br><p>y", "<p><b>x<br/></b></p><p><b>y</b></p>"),
        ("<b><i>a</b>b</i>c", "<b><i>a</i></b><i>b</i>c"),
        ("<b><p>x</b>y</p>", "<b></b><p><b>x</b>y</p>"),
        ("<b>1<i>2<p>3</b>4", "<b>1<i>2</i></b><i><p><b>3</b>4</p></i>"),
        ("<a><p>X<a>Y</a>Z</p></a>", "<a></a><p><a>X</a><a>Y</a>Z</p>"),
        ("<a href=1>x<a href=2>y", '<a href="1">x</a><a href="2">y</a>'),
        ("<font><p>hello<b>cruel</font>world", "<font></font><p><font>hello<b>cruel</b></font><b>world</b></p>"),
        ("<nobr>a<nobr>b", "<nobr>a</nobr><nobr>b</nobr>"),
        ("<p><b><b><b><b>x<p>y", "<p><b><b><b><b>x</b></b></b></b></p><p><b><b><b>y</b></b></b></p>"),
        ("<b><object>x</b>y</object>z", "<b><object>xy</object>z</b>"),
        # tables imply their parts, and put before themselves what they can't hold
        ("<table><tr><td>1<td>2<tr><td>3</table>z", "<table><tbody><tr><td>1</td><td>2</td></tr><tr><td>3</td></tr></tbody></table>z"),
        ("<table>foo<tr><td>x</table>", "foo<table><tbody><tr><td>x</td></tr></tbody></table>"),
        ("<table><a>1<p>2</a>3</p>", "<a>1</a><p><a>2</a>3</p><table></table>"),
        ("<table><caption>c<col><thead><th>h<tbody><td>d</table>", "<table><caption>c</caption><colgroup><col/></colgroup><thead><tr><th>h</th></tr></thead><tbody><tr><td>d</td></tr></tbody></table>"),
        ("<table><tr><td><b>1</td></tr></b></table>2", "<table><tbody><tr><td><b>1</b></td></tr></tbody></table>2"),
        ("<table><td><table><td>a</table>b</table>c", "<table><tbody><tr><td><table><tbody><tr><td>a</td></tr></tbody></table>b</td></tr></tbody></table>c"),
        ("<td>a</td>b", "ab"),
        ("<!doctype html><p><table><td>a</table>b", "<p></p><table><tbody><tr><td>a</td></tr></tbody></table>b"),
        ("<p><table><td>a</table>b", "<p><table><tbody><tr><td>a</td></tr></tbody></table>b</p>"),  # no doctype: quirks
        # choices
        ("<select><option>a<option>b<optgroup label=x><option>c</select>d", '<select><option>a</option><option>b</option><optgroup label="x"><option>c</option></optgroup></select>d'),
        ("<select><p>a</select>b", "<select>a</select>b"),
        ("<button>a<button>b", "<button>a</button><button>b</button>"),
        ("<form>a<form>b</form>c</form>", "<form>ab</form>c"),
        # text that holds no tags
        ("<textarea>\n<p>&amp;</textarea>b", "<textarea>&lt;p&gt;&amp;</textarea>b"),
        ("<pre>\na</pre>", "<pre>a</pre>"),
        # drawings end at HTML
        ("<svg><path d=1 /><circle></svg><p>x", '<svg><path d="1"></path><circle></circle></svg><p>x</p>'),
        ("<svg><g><p>x</svg>y", "<svg><g></g></svg><p>xy</p>"),
        ("<svg><foreignobject><p>x</p></foreignobject></svg>y", "<svg><foreignobject><p>x</p></foreignobject></svg>y"),
        # the rest
        ("</p>x", "x"),
        ("<body class=a><body class=b id=c>x</body>y", "xy"),
        ("x</br>y<image src=i>", 'x<br/>y<img src="i"/>'),
        ("<template><p>no</template><p>yes", "<p>yes</p>"),
        ("<p>a<template><p>no</template>b", "<p>a<template></template>b</p>"),
        ("<ruby>a<rt>b<rp>c</ruby>d", "<ruby>a<rt>b</rt><rp>c</rp></ruby>d"),
        ("", ""),
        (None, ""),
    ],
)
def test_tree(html, want):
    assert body(html) == want


def test_head_and_body():
    page = Page("<!DOCTYPE html><title>a <b> &amp;</title><meta charset=x> <script>'<p>'</script>\n<p>text")
    assert serialise(page.root.children[0]).startswith('<head><title>a &lt;b&gt; &amp;</title><meta charset="x"/><script>')
    assert serialise(page.body) == "<p>text</p>" and not page.quirks
    assert page.body.attrs == {} and Page("<body id=a>").body.attrs == {"id": "a"}


def test_the_first_of_equal_attributes_counts():
    assert extract.fields_of('<p itemprop="author" itemprop="x">Ann</p>', "recipe")["author"] == "Ann"


def test_any_text_makes_a_tree_that_holds_its_letters():
    rng = random.Random(1)
    names = "p div b i a li ul ol table tr td tbody h1 span svg select option button form br dl dd template pre nobr object caption".split()
    for _ in range(1500):
        html = "".join(rng.choice(["x", " ", f"<{rng.choice(names)}>", f"</{rng.choice(names)}>"]) for _ in range(rng.randint(1, 40)))
        page = Page(html)
        whole = "".join(page.root.texts(frozenset()))
        if "template" not in html:
            assert whole.count("x") == html.count("x")
        seen = set()
        for x in page.root.elements():
            assert id(x) not in seen and any(c is x for c in x.parent.children)
            seen.add(id(x))
        again = serialise(page.body)
        if not {"table", "a", "nobr", "form", "button", "p", "h1", "select", "template", "pre"} & {x.name for x in page.body.elements()}:
            assert body("<body>" + again) == again


@pytest.mark.parametrize("piece", ["<div>", "<b>", "<p><b>x", "<li>", "<table><tr><td>", "</div>", "<a>x", "<ul><li>", "<i></b>"])
def test_long_pages_take_linear_time(piece):
    start = time.process_time()
    Page(piece * 4000)
    assert time.process_time() - start < 8


@pytest.mark.parametrize(
    "html, kind, want",
    [
        ("<ol><li>one<li>two<li> </ol>", "recipe", {"ingredients": ["one", "two"], "instructions": ["one", "two", ""]}),
        ("<p>" + "d" * 30 + "<p>more", "recipe", {"description": "d" * 30}),
        ("<p>" + "😀" * 15, "person", {}),  # 30 units
        ("<p>" + "😀" * 15 + "!", "person", {"bio": "😀" * 15 + "!"}),
        ("<b class=AUTHOR>Ann</b>", "recipe", {"author": "Ann"}),  # no doctype: class names in any case
        ("<!doctype html><b class=AUTHOR>Ann</b>", "recipe", {}),
        ("<h1>﻿ a\xa0</h1>", "auth_required", {"message": "a"}),
        ("<title>404</title><p>5030 503", "error_page", {"error_code": 503, "description": "5030 503"}),
        ("<a href=//linkedin.com/in/x>", "person", {"linkedin": "https://linkedin.com/in/x"}),
        ("<base href=http://b.org/c/><a href=../linkedin.com>", "person", {"linkedin": "http://b.org/linkedin.com"}),
        ("<a href='https://[linkedin.com'>", "person", {"linkedin": "https://[linkedin.com"}),
        ("(555)\xa0123-4567", "person", {"phone": "(555)\xa0123-4567"}),
        ("<h2>A</h2><table><h3>B</h3><td class=plan-name>C</table>", "pricing_table", {"plans": [{"name": n, "price": "TODO", "features": ["TODO"]} for n in "ABC"]}),
    ],
)
def test_fields(html, kind, want):
    assert extract.fields_of(html, kind, "https://site.org/d/e") == want


def test_long_runs_without_an_at_sign_are_cheap():
    start = time.process_time()
    assert extract.fields_of("a" * 400_000 + " b@c.de", "person")["email"] == "b@c.de"
    assert extract.fields_of("a.b" * 100_000 + "@" + "c." * 100_000, "person") == {}
    assert time.process_time() - start < 5
