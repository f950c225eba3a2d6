import pytest

from tagloom.functions import extract, html_tree as h, mutate

PAGE = """<!DOCTYPE html><html><head><title> A &amp; B </title><style>p{x:"</b>"}</style></head><body id="b" class=""><div class="x y" style="a"><p>one<br>two<p>three <b>bold</div></i>
<script>var t = "</p>"; track(0);</script><!-- note --><svg><path d="m"/></svg><noscript><img src="i"></noscript><a href="/z"></a><div><img src="k"></div><nav><ul><li>n</li></ul></nav></body></html>"""


def test_profile():
    size, length, words, tags, div, span, cls, ids, style, depth = h.profile(PAGE)
    assert (size, tags, div, span, cls, ids, style) == (len(PAGE), len([1 for x in PAGE.split("<")[1:] if x[0].isalpha()]), 2, 0, 1, 1, 1)
    assert h.visible_text(h.parse(PAGE)) == "A & B one two three bold n" and words == 8 and length == 26
    assert depth == 6  # html body div p p b: an open p holds what follows it
    assert h.profile("") == (0,) * 10 == h.profile(None)
    assert h.profile("<p>x</p>")[-1] == 1


def test_overview_and_tags():
    assert h.overview(PAGE) == ("A & B", True, 2, 2, 1, 0)
    assert h.overview("plain") == (None, False, 0, 0, 0, 0)
    assert h.tag_names("<b><i></b><br/>") == ["b", "i", "br"]


def test_serialising_is_stable():
    once = h.serialise(h.parse(PAGE))
    assert h.serialise(h.parse(once)) == once
    assert "&amp;" in once and 'var t = "</p>"; track(0);' in once and '"</b>"' in once and "<!-- note -->" in once and "<!DOCTYPE html>" in once
    assert h.serialise(h.parse("<p>a<b>c</b></p>"), pretty=True) == "<p>\n a\n <b>\n  c\n </b>\n</p>\n"


def test_cleaning():
    minimal, moderate, aggressive = h.cleaned(PAGE)
    assert "<script" not in minimal and "<style>" not in minimal and "noscript" not in minimal and "<svg>" in minimal and 'class="x y"' in minimal
    assert "svg" not in moderate and "class" not in moderate and "style" not in moderate and 'id="b"' in moderate
    assert "nav" not in aggressive and "id=" not in aggressive and "<br" not in aggressive and "bold" in aggressive
    assert '<a href="/z">' not in aggressive and '<div></div>' in aggressive  # an image and a textless link go, what held them stays
    assert h.cleaned("") == ["", "", ""]


def test_deep_pages_do_not_recurse():
    deep = "<div>" * 5000 + "x"
    assert h.profile(deep)[-1] == 5000
    assert h.cleaned(deep)[2].count("<div>") == 5000


@pytest.mark.parametrize(
    ("html", "kind", "want"),
    [
        ("<h1></h1><h2>T</h2><ul><li>a</li><li> </li></ul><ol><li>s</li><li></li></ol><p>" + "d" * 21, "recipe", {"name": "T", "ingredients": ["a", "s"], "instructions": ["s", ""], "description": "d" * 21}),
        ("<p>" + "d" * 20 + "</p>" + "<li>loose", "recipe", {}),
        ("<p>" + "d" * 500, "recipe", {}),
        ("<p class=description>" + "d" * 499, "recipe", {"description": "d" * 499}),
        ("<ul>" + "<li>x</li>" * 29 + "</ul>", "recipe", {"ingredients": ["x"] * 29}),
        ("<ul>" + "<li>x</li>" * 30 + "</ul>", "recipe", {}),
        ('<b itemprop=author>A</b><i class="author">B</i>', "recipe", {"author": "A"}),
        ("<time datetime=2024>x</time><address>Hall, City</address>from $12.50 or $9", "event", {"datetime": "2024", "location": "Hall, City", "venue_name": "Hall", "price": "$12.50"}),
        ("<h2>A</h2><b class=tier-name>B</b>", "pricing_table", {"plans": [{"name": n, "price": "TODO", "features": ["TODO"]} for n in "AB"]}),
        ("<h3>x</h3>" * 6, "pricing_table", {}),
        ("<h1>J</h1><b class=company>C</b><b class=location>L</b><p class=description>" + "d" * 51, "job_posting", {"title": "J", "company": "C", "location": "L", "description": "d" * 51}),
        ("<p class=description>" + "d" * 50, "job_posting", {}),
        ("<h1>N</h1><b class=role>R</b> me@x.org (555) 123-4567 <a href=https://linkedin.com/in/n>l</a><p>" + "b" * 31, "person", {"name": "N", "title": "R", "email": "me@x.org", "phone": "(555) 123-4567", "linkedin": "https://linkedin.com/in/n", "bio": "b" * 31}),
        ("<p>" + "b" * 30, "person", {}),
        ("<h1>Gone</h1>Error 404 <p>no", "error_page", {"error_code": 404, "message": "Gone", "description": "no"}),
        ("<h1>Log in</h1><p>x", "auth_required", {"message": "Log in", "description": "x"}),
        ("<div id=__nuxt ng-app>", "empty_shell", {"framework": "vue"}),
        ("<h1>x", "unknown", {}),
        (None, "recipe", {}),
    ],
)
def test_extraction(html, kind, want):
    assert extract.fields_of(html, kind) == want


def test_merge():
    assert extract.merge({"a": "TODO", "b": ["TODO"], "c": {"d": 1, "e": 2}}, {"a": None, "b": [], "c": {"d": 5}, "f": 1}) == {"a": "TODO", "b": [], "c": {"d": 5, "e": 2}, "f": 1}
    with pytest.raises(ValueError):
        extract.annotate("<p>", "nothing")


def test_variations_are_reproducible_and_keep_the_text():
    text = h.visible_text(h.parse(PAGE))
    seen = set()
    for v in range(60):
        html, planned, applied = mutate.vary(PAGE, 42, 7, v)
        assert mutate.vary(PAGE, 42, 7, v) == (html, planned, applied)
        assert set(applied) <= set(planned)
        assert h.visible_text(h.parse(html)).split() == text.split()
        seen |= set(applied)
        if not planned:
            assert html == PAGE
    assert seen == {"wrapper_divs", "random_attrs", "comments", "styles", "whitespace"}
    assert all("wrapper_divs" not in mutate.vary("<p>x</p>", 1, 1, v)[2] and "styles" not in mutate.vary("<p>x</p>", 1, 1, v)[2] for v in range(30))


def test_exploratory_variations():
    text, seen = h.visible_text(h.parse(PAGE)).split(), set()
    for v in range(60):
        html, planned, applied = mutate.vary(PAGE, 42, 7, v, "exploratory")
        assert mutate.vary(PAGE, 42, 7, v, "exploratory")[0] == html and set(applied) <= set(planned)
        assert h.visible_text(h.parse(html)).split() == text
        seen |= set(applied)
    assert seen == {n for n, _ in mutate.GATES["exploratory"]}


ODD = (
    PAGE, "", " ", "text\n", "\n a &amp b < c &lt", "<p>x", "<br>", "<script>a</p> < b</script><b>c", "<script>open", "<style/>x", "<body/>", "<div><body class=' a  b '><i style='x:y'>1</i></body></div><body>2</body>",
    "<title>a &amp b</title><textarea><b>c</textarea><xmp><i>", "<!-- a > b --><?pi x?><![CDATA[ y ]]><!DOCTYPE html><body><!-- c --></body>", '<a href="?a&b=1" "q"=x =y @click=z (k)>t</a>', "<B\u0130 x='\"&gt;'>a\x00b\r\nc\xa0 </b\u0130>", "<pre>  a\n b </pre><svg><style>a<b>c</b></style></svg>",
    "<html><head></head><body>" + "<div>" * 80 + "x" + "</div>" * 40 + "</body> after </html> end",
)


@pytest.mark.parametrize("page", ODD)
def test_variations_by_outline_are_those_of_the_tree(page, monkeypatch):
    quick = [mutate.vary(page, 42, "b", v, "exploratory") for v in range(150)]
    monkeypatch.setattr(mutate, "_vary_outline", lambda *_: None)
    assert quick == [mutate.vary(page, 42, "b", v, "exploratory") for v in range(150)]


def test_variations_of_a_page_parse_it_once(monkeypatch):
    parsed, parse = [], h.parse
    monkeypatch.setattr(mutate, "parse", lambda html: parsed.append(html) or parse(html))
    page = PAGE.replace("Title", "Another title") + "<p>only here</p>"
    for v in range(100):
        mutate.vary(page, 42, 7, v, "exploratory")
    assert len(parsed) < 20  # the page, the page as written, and a comment in each name of a tag
