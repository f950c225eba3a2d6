"""Label-preserving variations of HTML.

Each variation has a random stream of its own, seeded by (seed, base id,
variation id), so the result depends on neither the order nor the number of
partitions. ``planned`` names the steps the gates chose, ``applied`` those that
changed the document: without a body, wrapping and comments change nothing,
without a head, styles don't.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Callable, Iterator
from functools import cache, cached_property, lru_cache
from html import escape

from .html_tree import MARKUP, RAW, VOID, Node, parse, serialise, start_tag

#: Names, texts and rules that are put in, and each profile's gates.
WRAPPERS = ("container", "wrapper", "content", "main", "page-wrapper", "site-content", "app-root")
COMMENTS = (" Generated content ", " Auto-generated ", " SEO optimization ", " Analytics tracking ", " Ad placement ")
STYLES = (
    ".hidden { display: none; }",
    '.clearfix::after { content: ""; display: table; clear: both; }',
    "body { margin: 0; padding: 0; }",
    "* { box-sizing: border-box; }",
)
NOISE_CLASSES = ("container", "wrapper", "content", "main", "section", "item", "block", "element", "component", "module")
NOISE_DATA = ("id", "key", "index", "type")
NOISE_STYLES = ("display: block", "margin: 0", "padding: 0", "position: relative", "box-sizing: border-box")
NOISE_COMMENTS = ("Start of section", "End of section", "TODO: refactor this", "Generated by framework", "Container element")
GATES = {
    "standard": (("wrapper_divs", 0.7), ("random_attrs", 0.6), ("comments", 0.5), ("styles", 0.4), ("whitespace", 0.5)),
    "exploratory": (("numbered_wrappers", 0.4), ("noise_attrs", 0.6), ("inline_styles", 0.3), ("leading_comments", 0.4), ("pretty", 0.5)),
}


def stream(seed: int, base_id: object, variation_id: int) -> random.Random:
    return random.Random(int.from_bytes(hashlib.sha256(f"{seed}\0{base_id}\0{variation_id}".encode()).digest()[:8], "big"))


def _first(root: Node, name: str) -> Node | None:
    return root.find(lambda x: x.name == name)


def wrap(root: Node, rng: random.Random) -> bool:
    if body := _first(root, "body"):
        for _ in range(rng.randint(1, 3)):
            div = Node("div", {"class": rng.choice(WRAPPERS)}, body)
            div.children, body.children = body.children, [div]
            for x in div.children:
                if isinstance(x, Node):
                    x.parent = div
    return body is not None


#: How an attribute takes a new value: replaced, or joined to what is there.
JOINS = {"class": " ", "style": "; "}
Rule = tuple[float, Callable[[random.Random], str], Callable[[random.Random], str]]

#: (chance, attribute, value) of the standard change of attributes.
ATTRIBUTE_RULES: tuple[Rule, ...] = (
    (0.5, lambda rng: "class", lambda rng: f"auto-{rng.randint(1000, 9999)}"),
    (0.3, lambda rng: "data-id", lambda rng: str(rng.randint(10000, 99999))),
    (0.2, lambda rng: "aria-hidden", lambda rng: "true"),
)


def decorate(tags: list[Node], rules: tuple[Rule, ...], rng: random.Random) -> bool:
    """Each rule falls on each tag with its chance."""
    changed = False
    for x in tags:
        for chance, attribute, value in rules:
            if rng.random() < chance:
                name = attribute(rng)
                old = x.attrs.get(name) if name in JOINS else None
                old = " ".join(old.split()) if old and name == "class" else old
                new = f"{old}{JOINS[name]}{value(rng)}" if old else value(rng)
                changed |= x.attrs.get(name) != new
                x.attrs = x.attrs | {name: new}  # a new dict: outlines share theirs
    return changed


def attributes(root: Node, rng: random.Random) -> bool:
    """The standard change of attributes, on five to twenty tags."""
    tags = list(root.elements())
    return decorate(rng.sample(tags, min(len(tags), rng.randint(5, 20))), ATTRIBUTE_RULES, rng)


def comments(root: Node, rng: random.Random) -> bool:
    body = _first(root, "body")
    inner = list(body.elements()) if body else []
    for _ in range(rng.randint(2, 5) if inner else 0):
        x = rng.choice(inner)
        at = next(i for i, c in enumerate(x.parent.children) if c is x)
        x.parent.children.insert(at, ("comment", rng.choice(COMMENTS)))
    return bool(inner)


def styles(root: Node, rng: random.Random) -> bool:
    if head := _first(root, "head"):
        style = Node("style", {}, head)
        style.children.append("\n".join(rng.sample(STYLES, rng.randint(1, 3))))
        head.children.append(style)
    return head is not None


#: Where line feeds may go: (text, text with line feed), each in half of the variations.
SPACING = (("<div", "\n<div"), ("><", ">\n<"))


def spaced(html: str, rng: random.Random) -> str:
    """Line feeds before opening divs, between tags, both or neither."""
    for plain, broken in SPACING:
        html = html.replace(plain, broken) if rng.random() < 0.5 else html
    return html


def numbered_wrappers(root: Node, rng: random.Random) -> bool:
    """One to three nested divs around the body's content, the outermost numbered 0."""
    if body := _first(root, "body"):
        inner, at = body.children, body
        for i in range(rng.randint(1, 3)):
            div = Node("div", {"class": f"wrapper-{i}"}, at)
            at.children = [div]
            at = div
        at.children = inner
        for x in inner:
            if isinstance(x, Node):
                x.parent = at
    return body is not None


def noise_attributes(root: Node, rng: random.Random) -> bool:
    """Each tag gets a class with some chance between 0.1 and 0.3, and a data attribute with half of it."""
    chance = rng.uniform(0.1, 0.3)
    noise = (
        (chance, lambda rng: "class", lambda rng: rng.choice(NOISE_CLASSES)),
        (chance / 2, lambda rng: f"data-{rng.choice(NOISE_DATA)}", lambda rng: f"value-{rng.randint(1, 1000)}"),
    )
    return decorate(list(root.elements()), noise, rng)


def inline_styles(root: Node, rng: random.Random) -> bool:
    """Each tag gets a style with some chance between 0.05 and 0.2."""
    return decorate(list(root.elements()), ((rng.uniform(0.05, 0.2), lambda rng: "style", lambda rng: rng.choice(NOISE_STYLES)),), rng)


def leading_comments(root: Node, rng: random.Random) -> bool:
    """Three to ten comments, each as the first child of some tag; raw-text and void tags hold none."""
    tags = [x for x in root.elements() if x.name not in VOID | RAW]
    for _ in range(min(len(tags), rng.randint(3, 10))):
        rng.choice(tags).children.insert(0, ("comment", f" {rng.choice(NOISE_COMMENTS)} "))
    return bool(tags)


#: Steps on the tree; each tells whether it changed it.
TREE_STEPS: dict[str, Callable[[Node, random.Random], bool]] = {
    "wrapper_divs": wrap, "random_attrs": attributes, "comments": comments, "styles": styles,
    "numbered_wrappers": numbered_wrappers, "noise_attrs": noise_attributes, "inline_styles": inline_styles, "leading_comments": leading_comments,
}
TEXT_STEPS: dict[str, Callable[[str, random.Random], str]] = {"whitespace": spaced, "pretty": lambda html, rng: serialise(parse(html), pretty=rng.random() < 0.5)}


#: Steps that put in nothing but attributes and what follows start tags, so they run on a page's outline.
OUTLINE_STEPS = frozenset({"numbered_wrappers", "noise_attrs", "inline_styles", "leading_comments"})
#: Names that a parser reads alike wherever they stand.
PLAIN_NAMES = re.compile(r"[^\s\"'<>/=\0]+(?: [^\s\"'<>/=\0]+)*")


class Elements(Node):
    """A page's elements one after another, each holding only what steps put in."""

    __slots__ = ()

    def elements(self) -> Iterator[Node]:
        for x in self.children:
            yield x
            if x.children:
                yield from x.elements()


class Outline:
    """A page cut into its tags, texts and comments: a variation is a copy of this list with some start tags changed.

    ``pieces`` are (level, as it stands, as pretty printing writes it) in order; an empty third is left out there.
    """

    def __init__(self, html: str):
        root = parse(html)
        self.pieces: list[tuple[int, str, str]] = []
        self.tags: list[tuple[int, Node]] = []  # place of the start tag, element
        self.body: range | None = None  # from the first body's start tag to its end tag
        todo: list[tuple[object, int, bool]] = [(x, 0, False) for x in reversed(root.children)]
        first = _first(root, "body")
        while todo:
            x, level, raw = todo.pop()
            at = len(self.pieces)
            if isinstance(x, Node):
                self.tags.append((at, x))
                text = start_tag(x)
                if x is first:
                    self.body = range(at, at)
                if x.name not in VOID:
                    todo.append((("end", x), level, False))
                    todo += [(c, level + 1, x.name in RAW) for c in reversed(x.children)]
            elif isinstance(x, str):
                text, bare = (x, x.strip()) if raw else (escape(x, quote=False), escape(x.strip(), quote=False))
                self.pieces.append((level, text, bare))
                continue
            elif x[0] == "end":
                text = f"</{x[1].name}>"
                if x[1] is first:
                    self.body = range(self.body.start, at)
            else:
                text = MARKUP[x[0]].format(x[1])
            self.pieces.append((level, text, text))
        self.plain = [text for _, text, _ in self.pieces]
        self._pretty: dict[int, list[str]] = {}

    def pretty(self, wrappers: int) -> list[str]:
        """Pieces as pretty printing writes them if the body's content is so much deeper."""
        if wrappers not in self._pretty:
            inner = self.body or range(0)
            self._pretty[wrappers] = [
                " " * (level + (wrappers if inner.start < i < inner.stop else 0)) + bare + "\n" if bare else "" for i, (level, _, bare) in enumerate(self.pieces)
            ]
        return self._pretty[wrappers]

    @cached_property
    def steady(self) -> bool:
        """Whether a parser that reads what is written here finds these pieces again, with other attributes and more comments too."""
        names = [" ".join((x.name, *x.attrs)) for _, x in self.tags]
        return all(map(PLAIN_NAMES.fullmatch, names)) and Outline("".join(self.plain)).pieces == self.pieces

    def elements(self) -> Elements:
        """The elements for a variation's steps; attributes are shared until a step changes them."""
        root = Elements()
        for _, x in self.tags:
            own = Node(x.name)
            own.attrs = x.attrs
            root.children.append(own)
        return root

    def written(self, root: Elements, pretty: bool = False) -> tuple[str, str]:
        """The page with what steps did to ``elements``: as it stands, and if asked for as pretty printing writes it."""
        inner = self.body or range(0)
        body = next((x for x, (at, _) in zip(root.children, self.tags, strict=True) if at == self.body.start), None) if self.body else None
        wrappers = sum(1 for _ in body.elements()) if body else 0
        out, lines = self.plain.copy(), self.pretty(wrappers).copy() if pretty else None
        for x, (at, old) in zip(root.children, self.tags, strict=True):
            if x.attrs is old.attrs and not x.children:
                continue
            level = self.pieces[at][0] + (wrappers if inner.start < at < inner.stop else 0)
            after, ends, holder = [(level, start_tag(x))], [], x
            while holder is not None:  # comments, then perhaps a wrapper, which holds the same
                level += 1
                here, holder = holder.children, None
                for c in here:
                    if isinstance(c, Node):
                        holder = c
                        ends.insert(0, (level, f"</{c.name}>"))
                        after.append((level, start_tag(c)))
                    else:
                        after.append((level, MARKUP[c[0]].format(c[1])))
            for place, put_in in ((at, after), (inner.stop, [*ends, self.pieces[inner.stop][:2]] if ends else [])):
                if put_in:
                    out[place] = "".join([text for _, text in put_in])
                    if pretty:
                        lines[place] = "".join([" " * n + text + "\n" for n, text in put_in])
        return "".join(out), "".join(lines) if pretty else ""


@cache
def takes_comments(name: str) -> bool:
    """Whether the parser finds comments in elements of a name; in some it reads text alone."""
    return parse(f"<{name}><!-- --></{name}>").children[0].children == [("comment", " ")]


#: The page at hand: its variations follow each other.
outline = lru_cache(maxsize=1)(Outline)


def _vary_outline(html: str, planned: list[str], rng: random.Random) -> tuple[str, list[str]] | None:
    """What the steps of OUTLINE_STEPS and pretty printing make of a page, and which changed it; None if the page must be parsed again to tell."""
    page = outline(html)
    root, printed = page.elements(), planned[-1] == "pretty"
    applied = [step for step in planned if step in OUTLINE_STEPS and TREE_STEPS[step](root, rng)]
    tree = len(planned) > printed
    if tree and printed and not (page.steady and all(takes_comments(x.name) for x in root.elements() if x.children and not isinstance(x.children[0], Node))):
        return None
    pretty = printed and rng.random() < 0.5
    plain, lines = page.written(root, pretty)
    before = plain if tree else html
    after = lines if pretty else plain
    return after, applied + ["pretty"] * (after != before)


def vary(html: str, seed: int, base_id: object, variation_id: int, profile: str = "standard") -> tuple[str, list[str], list[str]]:
    """(html, planned, applied) of one variation. Where the steps allow, they work on the page's outline, which its next variation finds again."""
    rng = stream(seed, base_id, variation_id)
    planned = [name for name, chance in GATES[profile] if rng.random() < chance]
    if planned and OUTLINE_STEPS.issuperset(planned[:-1]) and planned[-1] in OUTLINE_STEPS | {"pretty"}:
        if made := _vary_outline(html, planned, rng):
            return made[0], planned, made[1]
        rng = stream(seed, base_id, variation_id)
        for _ in GATES[profile]:
            rng.random()
    applied: list[str] = []
    tree = [s for s in planned if s in TREE_STEPS]
    if tree:
        root = parse(html)
        applied = [step for step in tree if TREE_STEPS[step](root, rng)]
        html = serialise(root)
    for step in planned:
        if step in TEXT_STEPS:
            after = TEXT_STEPS[step](html, rng)
            if after != html:
                applied.append(step)
            html = after
    return html, planned, applied
