"""What a variation changed in a page, found by comparing the two and not by asking the steps.

Both pages are read as streams of tags, texts and comments. Walking both at once, whatever the variation has more must be
something a step can put in: a wrapper, a comment, a style sheet, an attribute, white space. Anything else is a
difference that no step explains.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import functions as F

from . import mutate
from .html_tree import Node, parse
from .kinds import struct

Event = tuple[str, str, dict[str, str | None]]
#: What each profile's steps can put in: pattern of wrappers' classes, texts of comments, (step, attribute, value) of attributes.
WRAPPER = {"standard": "|".join(mutate.WRAPPERS), "exploratory": r"wrapper-\d"}
COMMENT = {"standard": frozenset(mutate.COMMENTS), "exploratory": frozenset(f" {c} " for c in mutate.NOISE_COMMENTS)}
ATTRIBUTES = {
    "standard": (("random_attrs", "class", r"auto-\d{4}"), ("random_attrs", "data-id", r"\d{5}"), ("random_attrs", "aria-hidden", "true")),
    "exploratory": (
        ("noise_attrs", "class", "|".join(mutate.NOISE_CLASSES)), ("noise_attrs", f"data-(?:{'|'.join(mutate.NOISE_DATA)})", r"value-\d+"), ("inline_styles", "style", "|".join(mutate.NOISE_STYLES)),
    ),
}
STEP = {"standard": ("wrapper_divs", "comments", "whitespace"), "exploratory": ("numbered_wrappers", "leading_comments", "pretty")}


def events(root: Node) -> list[Event]:
    """("open", name, attributes), ("close", name), ("text", text) and ("comment" and the like, text) in order."""
    out: list[Event] = []
    todo: list = [("walk", c) for c in reversed(root.children)]
    while todo:
        kind, x = todo.pop()
        if kind == "close":
            out.append(("close", x, {}))
        elif isinstance(x, Node):
            out.append(("open", x.name, x.attrs))
            todo.append(("close", x.name))
            todo += [("walk", c) for c in reversed(x.children)]
        elif isinstance(x, tuple):
            out.append((x[0], x[1], {}))
        else:
            out.append(("text", x, {}))
    return out


def differences(original: str | None, varied: str | None, profile: str = "standard") -> set[str] | None:
    """The steps that explain how a page differs from its original; None if they don't explain all of it.

    White space is compared apart: the standard step adds line feeds alone, pretty printing any white space.
    """
    blank = re.compile(r"\n" if profile == "standard" else r"\s+")
    bare = lambda text: blank.sub("", text or "")
    wrapping, commenting, spacing = STEP[profile]
    found: set[str] = set()
    old, new = (events(parse(x)) for x in (original, varied))
    old_spaces, new_spaces = [], []
    i = 0
    inserted: list[bool] = []  # of the open tags of the variation: whether they were put in
    sheet = False

    def step_of_attribute(name: str, value: str, before: str | None) -> str | None:
        for step, attribute, pattern in ATTRIBUTES[profile]:
            start = ""
            if before and name in mutate.JOINS:
                start = re.escape((" ".join(before.split()) if name == "class" else before) + mutate.JOINS[name])
            if re.fullmatch(attribute, name) and re.fullmatch(f"{start}(?:{pattern})", value):
                return step
        return None

    def attributes(before: dict[str, str | None], after: dict[str, str | None]) -> set[str] | None:
        steps = set()
        if [k for k in after if k in before] != list(before):
            return None
        for name, value in after.items():
            if name not in before or bare(before[name]) != bare(value):
                if (step := step_of_attribute(name, value or "", before.get(name))) is None:
                    return None
                steps.add(step)
        return steps

    for kind, what, attrs in new:
        if sheet:  # inside a style sheet that was put in
            if kind == "text" and not set(what.split("\n")) <= set(mutate.STYLES):
                return None
            sheet = kind != "close"
            continue
        if kind == "text":
            new_spaces.append(what)
            if not bare(what):
                continue
        while i < len(old) and old[i][0] == "text" and not bare(old[i][1]):
            old_spaces.append(old[i][1])
            i += 1
        here = old[i] if i < len(old) else ("end", "", {})
        if kind == "close" and inserted.pop():
            continue
        if kind == here[0] == "open" and what == here[1] and (steps := attributes(here[2], attrs)) is not None:
            found |= steps
            inserted.append(False)
        elif kind == "open" and what == "div" and (name := re.match(rf"(?:{WRAPPER[profile]})(?= |$)", attrs.get("class") or "")) and (steps := attributes({"class": name[0]}, attrs)) is not None:
            found |= steps | {wrapping}
            inserted.append(True)
            continue
        elif profile == "standard" and kind == "open" and what == "style" and (steps := attributes({}, attrs)) is not None and here == ("close", "head", {}):
            found |= steps | {"styles"}
            sheet = True
            continue
        elif kind == "comment" and (here[0] != "comment" or bare(here[1]) != bare(what)) and what in COMMENT[profile]:
            found.add(commenting)
            continue
        elif kind != here[0] or kind != "open" and bare(what) != bare(here[1]) or kind == "open":
            return None
        if kind == "text":
            old_spaces.append(here[1])
        i += 1
    old_spaces += [x[1] for x in old[i:] if x[0] == "text"]
    if any(x[0] != "text" or bare(x[1]) for x in old[i:]):
        return None
    if "".join(old_spaces) != "".join(new_spaces):
        found.add(spacing)
    return found


@F.pandas_udf(struct("kept boolean, exact boolean"))
def _checked(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    for originals, pages, applied, profiles in batches:
        rows = []
        for original, page, names, profile in zip(originals, pages, applied, profiles, strict=True):
            found = differences(original, page, profile)
            # pretty printing may change only how a page is written, which no reader of it sees
            rows.append((found is not None, found is not None and found - {"pretty"} == set(names) - {"pretty"}))
        yield pd.DataFrame(rows, columns=["kept", "exact"])


def checked(original, varied, applied, profile: str):
    """kept: the variation holds the original's tags, attributes and texts in their order, and nothing more that no step explains; exact: ``applied`` names just the steps that do."""
    return _checked.asNondeterministic()(original, varied, applied, F.lit(profile))
