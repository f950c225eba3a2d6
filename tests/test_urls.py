import pytest
from pyspark.sql import functions as F

from tagloom.functions import urls

#: From the URL standard's table of examples, and RFC 3986, section 5.4.
BASE = "http://a/b/c/d;p?q"
PUBLISHED = [
    ("https:example.org", None, "https://example.org/"), ("https://////example.com///", None, "https://example.com///"), ("https://example.com/././foo", None, "https://example.com/foo"),
    ("hello:world", "https://example.com/", "hello:world"), ("https:example.org", "https://example.com/", "https://example.com/example.org"), (r"\example\..\demo/.\ ".strip(), "https://example.com/", "https://example.com/demo/"),
    ("example", "https://example.com/demo", "https://example.com/example"), ("https://user:password@example.org/", None, "https://user:password@example.org/"), ("https://example.org/foo bar", None, "https://example.org/foo%20bar"),
    ("https://EXAMPLE.com/../x", None, "https://example.com/x"), ("https://ex ample.org/", None, None), ("example", None, None), ("https://example.com:demo", None, None), ("http://[www.example.com]/", None, None), ("https://example.org//", None, "https://example.org//"),
    ("g", BASE, "http://a/b/c/g"), ("./g", BASE, "http://a/b/c/g"), ("g/", BASE, "http://a/b/c/g/"), ("/g", BASE, "http://a/g"), ("//g", BASE, "http://g/"), ("?y", BASE, "http://a/b/c/d;p?y"), ("g?y", BASE, "http://a/b/c/g?y"),
    ("#s", BASE, "http://a/b/c/d;p?q#s"), ("g#s", BASE, "http://a/b/c/g#s"), (";x", BASE, "http://a/b/c/;x"), ("", BASE, BASE), (".", BASE, "http://a/b/c/"), ("./", BASE, "http://a/b/c/"), ("..", BASE, "http://a/b/"), ("../g", BASE, "http://a/b/g"),
    ("../..", BASE, "http://a/"), ("../../../g", BASE, "http://a/g"), ("/./g", BASE, "http://a/g"), ("g.", BASE, "http://a/b/c/g."), ("..g", BASE, "http://a/b/c/..g"), ("./g/.", BASE, "http://a/b/c/g/"), ("g/../h", BASE, "http://a/b/c/h"), ("g?y/../x", BASE, "http://a/b/c/g?y/../x"),
]
OWN = [
    ("//linkedin.com/in/x", "https://s.org/a", "https://linkedin.com/in/x"), (" HTTP://A.org:80/%2E%2e/b\n", None, "http://a.org/b"), ("https://a.org:8443", None, "https://a.org:8443/"), ("https://a.org:99999/", None, None),
    ("mailto:x@y.org", BASE, "mailto:x@y.org"), ("é?ü#ß", "https://s.org/", "https://s.org/%C3%A9?%C3%BC#%C3%9F"), (None, BASE, None), ("x", "mailto:a@b.org", None), ("x", "not a url", None), ("?a'b", "https://s.org/p?c", "https://s.org/p?a%27b"), ("a\tb", "https://s.org/", "https://s.org/ab"),
]


@pytest.mark.parametrize("reference, base, want", PUBLISHED + OWN)
def test_resolved(reference, base, want):
    assert urls.resolved(reference, base) == want


def test_column(spark):
    rows = [(i, r, b) for i, (r, b, _) in enumerate(PUBLISHED + OWN)]
    df = spark.createDataFrame(rows, "i int, reference string, base string").select("i", urls.absolute(F.col("reference"), F.col("base")).alias("url"))
    assert [r.url for r in df.orderBy("i").collect()] == [w for *_, w in PUBLISHED + OWN]
