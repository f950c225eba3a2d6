"""Rule-based extraction of typed fields from HTML, on the tree that a browser makes of it.

Rules are data: a type's fields, each with the rule that finds it. A selector is a tag name, ``.class`` or
``[attribute=value]``; a text rule takes the first selector whose first match has text. Lengths count UTF-16 units.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources import registry
from . import urls
from .dom import Page
from .html_tree import Node
from .kinds import SIMPLE, struct

#: Selectors in order of preference, patterns, markers of frameworks, white space of the rules' language.
TITLE = ("h1", "h2", "h3")
SPACE = "\t\n\x0b\x0c\r \xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000\ufeff"
PRICE = r"\$\d+(?:\.\d{2})?"
EMAIL = r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"
PHONE = rf"\(\d{{3}}\)[{SPACE}]*\d{{3}}-\d{{4}}|\d{{3}}-\d{{3}}-\d{{4}}"
STATUS = r"\b(404|500|503|502|403|429)\b"
FRAMEWORKS = (("react", ("__next", "_reactRoot")), ("vue", ("__nuxt", "__NUXT__")), ("angular", ("ng-version", "ng-app")))
#: EMAIL, tried only where a run of its characters begins: the first match is the same, in linear time.
EMAIL_AT_RUNS = r"(?<![a-zA-Z0-9._%+-])" + EMAIL

Rule = Callable[[Page, dict[str, Any], str | None], Any]


def matcher(selector: str, quirks: bool = False) -> Callable[[Node], bool]:
    """Whether an element is what a selector names. In quirks mode class names match in any case."""
    if selector.startswith("."):
        fold = str.lower if quirks else str
        return lambda x, c=fold(selector[1:]): c in re.split("[ \t\n\f\r]+", fold(x.attrs.get("class") or ""))
    if selector.startswith("["):
        name, _, value = selector[1:-1].partition("=")
        return lambda x: x.attrs.get(name) == value
    return lambda x: x.name == selector


def text_of(x: Node) -> str:
    return "".join(x.texts(frozenset())).strip(SPACE)


def units(text: str) -> int:
    return len(text) + sum(c > "\uffff" for c in text)


def first_text(selectors: tuple[str, ...], above: int = 0, below: float = float("inf")) -> Rule:
    """Text of the first match of the first selector whose first match has text, if its length lies between."""

    def find(page: Page, found: dict[str, Any], url: str | None) -> str | None:
        for s in selectors:
            if (x := page.root.find(matcher(s, page.quirks))) and (t := text_of(x)):
                return t if above < units(t) < below else None
        return None

    return find


def items(inside: frozenset[str], below: float, blanks: bool) -> Rule:
    """Texts of list items within such lists, if there are any and fewer than ``below``."""

    def find(page: Page, found: dict[str, Any], url: str | None) -> list[str] | None:
        texts, todo = [], [(page.root, False)]
        while todo:
            x, listed = todo.pop()
            if listed and x.name == "li" and ((t := text_of(x)) or blanks):
                texts.append(t)
            listed |= x.name in inside
            todo += [(c, listed) for c in reversed(x.children) if isinstance(c, Node)]
        return texts if 0 < len(texts) < below else None

    return find


def in_body(pattern: str, kind: type = str) -> Rule:
    """First match of a pattern in the text of the body."""

    def find(page: Page, found: dict[str, Any], url: str | None) -> Any:
        m = re.search(pattern, "".join(page.body.texts(frozenset())), re.A)
        return kind(m[0]) if m else None

    return find


def attribute(tag: str, name: str) -> Rule:
    """An attribute of the first element of a name that has it."""

    def find(page: Page, found: dict[str, Any], url: str | None) -> str | None:
        x = page.root.find(lambda x: x.name == tag and name in x.attrs)
        return x and (x.attrs[name] or "")

    return find


def link(part: str) -> Rule:
    """The first link whose reference holds ``part``, resolved at the page's base; as it stands if that fails."""

    def find(page: Page, found: dict[str, Any], url: str | None) -> str | None:
        x = page.root.find(lambda x: x.name == "a" and part in (x.attrs.get("href") or ""))
        return x and (urls.resolved(x.attrs["href"], base_of(page, url)) or x.attrs["href"])

    return find


def base_of(page: Page, url: str | None) -> str | None:
    """What references of a page are relative to: its first base element, else its URL."""
    x = page.root.find(lambda x: x.name == "base" and "href" in x.attrs)
    return x and urls.resolved(x.attrs["href"], url) or url


def before_comma(field: str) -> Rule:
    return lambda page, found, url: found[field].split(",")[0].strip(SPACE) if field in found else None


def plans(selectors: tuple[str, ...], most: int) -> Rule:
    """A plan for each element that a selector names and that has text, if there are any and at most so many."""

    def find(page: Page, found: dict[str, Any], url: str | None) -> list[dict[str, Any]] | None:
        tests = [matcher(s, page.quirks) for s in selectors]
        names = [t for x in page.root.elements() if any(test(x) for test in tests) and (t := text_of(x))]
        return [{"name": n, "price": "TODO", "features": ["TODO"]} for n in names] if 0 < len(names) <= most else None

    return find


#: type -> field -> rule
RULES: dict[str, dict[str, Rule]] = {
    "recipe": {
        "name": first_text(TITLE),
        "author": first_text(("[itemprop=author]", ".author", ".recipe-author")),
        "description": first_text(("[itemprop=description]", ".description", "p"), 20, 500),
        "ingredients": items(frozenset({"ul", "ol"}), 30, blanks=False),
        "instructions": items(frozenset({"ol"}), float("inf"), blanks=True),
    },
    "event": {
        "title": first_text(TITLE),
        "datetime": attribute("time", "datetime"),
        "location": first_text(("address", "[itemprop=location]", ".location", ".venue")),
        "venue_name": before_comma("location"),
        "price": in_body(PRICE),
        "description": first_text((".description", "[itemprop=description]", "p"), 20),
    },
    "pricing_table": {"plans": plans(("h2", "h3", ".plan-name", ".tier-name"), 5)},
    "job_posting": {
        "title": first_text(TITLE),
        "company": first_text((".company-name", "[itemprop=hiringOrganization]", ".company")),
        "location": first_text((".location", "[itemprop=jobLocation]", ".job-location")),
        "description": first_text((".description", "[itemprop=description]"), 50),
    },
    "person": {
        "name": first_text(TITLE),
        "title": first_text((".title", "[itemprop=jobTitle]", ".role")),
        "email": in_body(EMAIL_AT_RUNS),
        "phone": in_body(PHONE),
        "linkedin": link("linkedin.com"),
        "bio": first_text((".bio", "[itemprop=description]", "p"), 30),
    },
    "error_page": {"error_code": in_body(STATUS, int), "message": first_text(TITLE), "description": first_text(("p",))},
    "auth_required": {"message": first_text(TITLE), "description": first_text(("p",))},
}


def fields_of(html: str | None, kind: str, url: str | None = None) -> dict[str, Any]:
    """What the rules of a type find in a page (at its URL, if known); unknown types give nothing."""
    html, found = html or "", {}
    if kind == "empty_shell":
        name = next((name for name, marks in FRAMEWORKS if any(m in html for m in marks)), None)
        return {"framework": name} if name else {}
    if kind in RULES:
        page = Page(html)
        for name, rule in RULES[kind].items():
            if (value := rule(page, found, url)) is not None:
                found[name] = value
    return found


def links_of(html: str | None, url: str | None) -> list[tuple[str, str | None]]:
    """(reference, URL or null) of each link of a page, in order."""
    page = Page(html)
    base = base_of(page, url)
    return [(r, urls.resolved(r, base)) for x in page.root.elements() if x.name == "a" and (r := x.attrs.get("href")) is not None]


def merge(template: Any, extracted: Any) -> Any:
    """The template with extracted values: nulls change nothing, objects merge, all else (lists too) is replaced."""
    if isinstance(template, dict) and isinstance(extracted, dict):
        return template | {k: merge(template.get(k), v) for k, v in extracted.items() if v is not None}
    return extracted


def annotate(html: str | None, kind: str, url: str | None = None) -> str:
    """JSON of a type's template filled with what the rules find; an unknown type is an error."""
    return json.dumps(merge(registry.template(kind), fields_of(html, kind, url)), ensure_ascii=False)


@F.pandas_udf(SIMPLE["string"])
def _annotated(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for columns in batches:
        yield pd.Series([annotate(*row) for row in zip(*columns, strict=True)], dtype="object")


@F.pandas_udf(SIMPLE["string"])
def _extracted(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for columns in batches:
        yield pd.Series([json.dumps(fields_of(*row), ensure_ascii=False) for row in zip(*columns, strict=True)], dtype="object")


@F.pandas_udf(T.ArrayType(struct("reference string, url string")))
def page_links(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """Column form of ``links_of`` (html, url)."""
    for html, url in batches:
        yield pd.Series([[{"reference": r, "url": u} for r, u in links_of(h, at)] for h, at in zip(html, url, strict=True)], dtype="object")


def annotated(html: Column | str, kind: Column | str, url: Column | str | None = None) -> Column:
    """Column form of ``annotate``; evaluated once."""
    return _annotated.asNondeterministic()(html, kind, F.lit(None).cast("string") if url is None else url)


def extracted(html: Column | str, kind: Column | str, url: Column | str | None = None) -> Column:
    """Column form of ``fields_of``, as JSON; evaluated once."""
    return _extracted.asNondeterministic()(html, kind, F.lit(None).cast("string") if url is None else url)


def first_match(text: Column, pattern: str, needs: str | None = None) -> Column:
    """First match of a pattern, null if there is none; stays in the JVM. Texts without ``needs``, which every match holds, aren't searched."""
    match = F.nullif(F.regexp_extract(text, f"({pattern})", 1), F.lit(""))
    return F.when(text.contains(needs), match) if needs else match


def framework(html: Column) -> Column:
    out = None
    for name, marks in FRAMEWORKS:
        test = html.contains(marks[0]) | html.contains(marks[1])
        out = F.when(test, name) if out is None else out.when(test, name)
    return out
