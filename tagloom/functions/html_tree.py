"""A small HTML tree over the standard library's parser, and what is computed on it.

Rules of the tree: void tags have no children; an end tag closes the nearest
open tag of its name and all within it, and is ignored if there is none; what is
open at the end closes there; nothing else is implied. Script and style hold raw
text. A tree lives within one call and is never a column.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from html import escape
from html.parser import HTMLParser

#: Tags without content, raw-text tags, and what each level of cleaning drops and keeps.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset({"script", "style"})
DROP_MINIMAL = frozenset({"style", "script", "noscript"})
DROP_MODERATE = DROP_MINIMAL | {"svg", "path"}
DROP_AGGRESSIVE = DROP_MODERATE | {"link", "meta", "iframe", "form", "input", "button", "nav", "footer", "aside", "header"}
KEEP_ATTRS = frozenset({"href", "src", "alt", "title", "datetime", "content"})
LEVELS = ("original", "minimal", "moderate", "aggressive")


class Node:
    """An element, or with no name the document; children are nodes, texts, and comments and declarations as ("kind", text)."""

    __slots__ = ("attrs", "children", "name", "parent")

    def __init__(self, name: str = "", attrs: dict[str, str | None] | None = None, parent: Node | None = None):
        self.name, self.attrs, self.children, self.parent = name, attrs or {}, [], parent

    def elements(self) -> Iterator[Node]:
        """Elements below, in document order. No recursion: pages nest deeply."""
        todo = [iter(self.children)]
        while todo:
            for x in todo[-1]:
                if isinstance(x, Node):
                    yield x
                    todo.append(iter(x.children))
                    break
            else:
                todo.pop()

    def texts(self, skip: frozenset[str] = RAW) -> Iterator[str]:
        """Texts below, without comments and without those inside ``skip``."""
        todo = [iter(self.children)]
        while todo:
            for x in todo[-1]:
                if isinstance(x, str):
                    yield x
                elif isinstance(x, Node) and x.name not in skip:
                    todo.append(iter(x.children))
                    break
            else:
                todo.pop()

    def text(self) -> str:
        return "".join(self.texts(frozenset())).strip()

    def find(self, test: Callable[[Node], bool]) -> Node | None:
        return next((x for x in self.elements() if test(x)), None)

    def remove(self) -> None:
        self.parent.children.remove(self)

    def depth(self) -> int:
        n, x = 0, self
        while x.parent is not None:
            n, x = n + 1, x.parent
        return n


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node()

    def handle_starttag(self, tag, attrs):
        node = Node(tag, dict(attrs), self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.at = self.at.parent

    def handle_endtag(self, tag):
        x = self.at
        while x.parent is not None and x.name != tag:
            x = x.parent
        if x.parent is not None:
            self.at = x.parent

    def handle_data(self, data):
        if self.at.children and isinstance(self.at.children[-1], str):
            self.at.children[-1] += data
        else:
            self.at.children.append(data)

    def handle_comment(self, data):
        self.at.children.append(("comment", data))

    def handle_decl(self, decl):
        self.at.children.append(("decl", decl))

    def unknown_decl(self, data):
        self.at.children.append(("decl", data))

    def handle_pi(self, data):
        self.at.children.append(("pi", data))


def parse(html: str | None) -> Node:
    b = _Builder()
    b.feed(html or "")
    b.close()
    return b.root


#: How comments, declarations and processing instructions are written.
MARKUP = {"comment": "<!--{}-->", "decl": "<!{}>", "pi": "<?{}>"}


def start_tag(x: Node) -> str:
    return "<" + x.name + "".join(f' {k}="{escape(v)}"' if v is not None else f" {k}" for k, v in x.attrs.items()) + ("/>" if x.name in VOID else ">")


def serialise(root: Node, pretty: bool = False) -> str:
    """HTML of what is below a node; ``pretty`` puts every tag and text on its own line, indented by one space a level."""
    out: list[str] = []
    todo: list[tuple[str, object, int]] = [("markup", x, 0) for x in reversed(root.children)]

    def put(s: str, level: int) -> None:
        out.append(" " * level + s + "\n" if pretty else s)

    while todo:
        kind, x, level = todo.pop()
        if kind == "end":
            put(f"</{x}>", level)
        elif isinstance(x, Node):
            put(start_tag(x), level)
            if x.name not in VOID:
                todo.append(("end", x.name, level))
                todo += [("raw" if x.name in RAW else "markup", c, level + 1) for c in reversed(x.children)]
        elif isinstance(x, tuple):
            put(MARKUP[x[0]].format(x[1]), level)
        elif not pretty or x.strip():
            t = x.strip() if pretty else x
            put(t if kind == "raw" else escape(t, quote=False), level)
    return "".join(out)


PROFILE = "html_size long, text_length long, word_count long, tag_count long, div_count long, span_count long, class_count long, id_count long, style_attr_count long, nesting_depth long"


def profile(html: str | None) -> tuple[int, ...]:
    """The columns of PROFILE. The depth of a top-level tag is 1."""
    root = parse(html)
    tags = deepest = div = span = with_class = with_id = with_style = 0
    todo: list[tuple[Node, int]] = [(root, 0)]
    while todo:
        node, depth = todo.pop()
        for x in node.children:
            if isinstance(x, Node):
                todo.append((x, depth + 1))
                tags += 1
                deepest = max(deepest, depth + 1)
                div += x.name == "div"
                span += x.name == "span"
                with_class += bool((x.attrs.get("class") or "").strip())
                with_id += bool(x.attrs.get("id"))
                with_style += bool(x.attrs.get("style"))
    text = visible_text(root)
    return len(html or ""), len(text), len(text.split()), tags, div, span, with_class, with_id, with_style, deepest


def visible_text(root: Node) -> str:
    """Texts outside script and style, each stripped, joined by spaces."""
    return " ".join(x for t in root.texts() if (x := t.strip()))


OVERVIEW = "title string, has_body boolean, n_div long, n_p long, n_a long, n_headings long"


def overview(html: str | None) -> tuple:
    """The columns of OVERVIEW; title is the text of the first title tag."""
    root = parse(html)
    names = [x.name for x in root.elements()]
    title = root.find(lambda x: x.name == "title")
    return title.text() if title else None, "body" in names, names.count("div"), names.count("p"), names.count("a"), sum(len(n) == 2 and n[0] == "h" and n[1] in "123456" for n in names)


def tag_names(html: str | None) -> list[str]:
    return [x.name for x in parse(html).elements()]


def clean(root: Node, level: str) -> Node:
    """The tree cleaned in place. Levels: minimal drops styles and scripts; moderate also drawings, style and class; aggressive keeps content tags, six attributes, and no tag without text unless it holds an image or link.

    Two passes over the tree, whatever its shape: one drops tags and attributes, one from the inside out tells what holds content.
    """
    drop = {"original": frozenset(), "minimal": DROP_MINIMAL, "moderate": DROP_MODERATE, "aggressive": DROP_AGGRESSIVE}[level]
    order, todo = [], [root]
    while todo:
        x = todo.pop()
        order.append(x)
        x.children = [c for c in x.children if not (isinstance(c, Node) and c.name in drop)]
        todo += [c for c in x.children if isinstance(c, Node)]
        if level == "moderate":
            x.attrs.pop("style", None)
            x.attrs.pop("class", None)
        elif level == "aggressive":
            x.attrs = {k: v for k, v in x.attrs.items() if k in KEEP_ATTRS}
    if level == "aggressive":
        holds: set[int] = set()  # nodes with a text, image or link below
        for x in reversed(order):  # children before their parents
            if any(c.strip() if isinstance(c, str) else isinstance(c, Node) and (id(c) in holds or c.name in ("img", "a")) for c in x.children):
                holds.add(id(x))
            x.children = [c for c in x.children if not isinstance(c, Node) or id(c) in holds]
    return root


def cleaned(html: str | None) -> list[str]:
    """The page at each of LEVELS but the first. Parsed once: each level drops what the one before drops, and more."""
    root = parse(html)
    return [serialise(clean(root, level)) for level in LEVELS[1:]]
