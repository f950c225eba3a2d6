"""Scalar expressions on text, JSON and numbers; all of them stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..sources.registry import HTML_MARKER


def word_count(text: Column) -> Column:
    """Words between white space as Unicode has it; empty text has none."""
    return F.regexp_count(text, F.lit(r"(?U)\S+")).cast("long")


def after_marker(text: Column, marker: str = HTML_MARKER) -> Column:
    """What follows the first marker; null without one."""
    at = F.locate(marker, text)
    return F.when(at > 0, F.substring(text, at + len(marker), F.length(text)))


def without_prompt(html: Column, prompt: Column) -> Column:
    """html without the prompt and the blank line before it at its end."""
    tail = F.concat(F.lit("\n\n"), prompt)
    return F.when(F.endswith(html, tail), F.left(html, F.length(html) - F.length(tail))).otherwise(html)


def safe_timestamp(text: Column) -> Column:
    """A timestamp fit for a file name: colons and dots become dashes, 19 characters."""
    return F.left(F.translate(text, ":.", "--"), F.lit(19))


def host(url: Column) -> Column:
    """Lower-case host of a URL, without user and port; null if it has none."""
    return F.nullif(F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1), F.lit(""))


def run_name(prefix: str, at: Column) -> Column:
    return F.concat(F.lit(prefix), F.date_format(at, "yyyyMMdd-HHmmss"))


def answer_of(text: Column) -> Column:
    """Model output without its thinking: with a think tag, what stands between the first and second end tag, or before the tag if it never ends."""
    parts = F.split(text, "</think>")
    thought = F.when(F.size(parts) > 1, F.get(parts, F.lit(1))).otherwise(F.get(F.split(text, "<think>"), F.lit(0)))
    return F.regexp_replace(F.when(text.contains("<think>"), thought).otherwise(text), r"(?U)^\s+|\s+$", "")


def preview(text: Column, n: int = 100) -> Column:
    """The first n characters, with an ellipsis if there are more."""
    return F.when(F.length(text) > n, F.concat(F.left(text, F.lit(n)), F.lit("..."))).otherwise(text)


def joined_fragments(parts: Column, separator: str = "\n\n<!-- FRAGMENT SEPARATOR -->\n\n") -> Column:
    return F.array_join(parts, separator)


def without_blanks(values: Column) -> Column:
    return F.filter(values, lambda x: x != "")


def percent_less(before: Column, after: Column) -> Column:
    """By how many percent ``after`` is less than ``before``; null if that is 0."""
    return F.try_divide((before - after) * F.lit(100.0), before)


def half_even(value: Column, digits: int = 0) -> Column:
    """Rounded, a half to the even neighbour as data-frame libraries do; by the decimal digits that are shown."""
    return F.bround(value.cast("decimal(38,12)"), digits).cast("double")


def holds(text: Column, part: str) -> Column:
    """Whether a text has a part, as it stands; false for null."""
    return F.coalesce(text.contains(part), F.lit(False))


def complete(value: Column) -> Column:
    """Whether a label value (text of a JSON value, null for a JSON null) is filled in. A list with a TODO counts as filled in."""
    return value.isNotNull() & ~value.isin("TODO", "")


def has_open_todo(raw: Column) -> Column:
    return raw.contains('"TODO"')


def saveable(html: Column, raw: Column, kind: Column) -> Column:
    """Whether an annotation may be saved: html not blank, valid JSON, a type chosen."""
    blank = F.coalesce(F.trim(html), F.lit("")) == ""
    return ~blank & F.try_parse_json(raw).isNotNull() & (F.coalesce(kind, F.lit("")) != "")
