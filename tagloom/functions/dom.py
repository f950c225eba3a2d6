"""The tree a browser makes of HTML: implied tags, reopened formatting, and content that tables put before themselves.

``html_tree`` takes tags as they are written, for profiles and cleaning. Rules that read fields off a page need the tree of
the HTML standard instead, where ``<li>one<li>two`` is two items and a paragraph ends at the next block. Tokens come from the
standard library's parser; the steps follow the standard's "in body" and table modes. Each open element knows the mode it
gives its content and whether a paragraph can be closed from there, so most tags cost the same however deep they stand.

Left out: framesets, and what only scripts can do. Markup in a template is no part of the page.
"""

from __future__ import annotations

from html import unescape
from html.parser import HTMLParser

from .html_tree import VOID, Node

# Classes of tags in the HTML standard.
FORMATTING = frozenset("a b big code em font i nobr s small strike strong tt u".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BLOCKS = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer header hgroup main menu nav ol p search section summary ul pre listing".split())
HEAD_TAGS = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
IMPLIED_END = frozenset("dd dt li optgroup option p rb rp rt rtc".split())
SECTIONS = frozenset("tbody tfoot thead".split())
CELLS = frozenset("td th".split())
TABLE_PARTS = SECTIONS | CELLS | frozenset("caption col colgroup tr".split())
#: Parts of drawings and formulas whose content is HTML again.
INTEGRATION = frozenset("annotation-xml desc foreignobject title mi mn mo ms mtext".split())
MARKED = frozenset("applet marquee object".split())
SCOPE = MARKED | CELLS | frozenset("caption html table template".split()) | frozenset(f"foreign:{x}" for x in INTEGRATION)
SPECIAL = BLOCKS | HEADINGS | SCOPE | TABLE_PARTS | HEAD_TAGS | VOID - frozenset("embed track".split()) | frozenset("body button dd dt form frame frameset head iframe li noembed plaintext select textarea xmp".split())
RAW_TEXT = frozenset("iframe noembed noframes plaintext script style xmp".split())
RCDATA = frozenset("textarea title".split())
#: Tags that end a drawing or formula in which they stand.
BREAKOUT = BLOCKS - frozenset("article aside details dialog dir fieldset figcaption figure footer header hgroup main nav search section summary address".split()) | HEADINGS | FORMATTING - {"a", "font"} | frozenset("body br dd dt embed head hr img li meta ruby span sub sup table var".split())
MODES = {"table": "table", "tr": "row", "caption": "caption", "colgroup": "columns", "select": "select", "svg": "foreign", "math": "foreign"} | dict.fromkeys(SECTIONS, "section") | dict.fromkeys(CELLS, "cell") | dict.fromkeys(("body", "template"), "body")
SPACE = " \t\n\f\r"


class _Open:
    """An open element: its node, the mode of its content, and whether a paragraph is open within button scope. What stands in a drawing is no HTML, whatever its name."""

    __slots__ = ("foreign", "mode", "name", "node", "paragraph")

    def __init__(self, node: Node, above: _Open | None):
        self.node, self.name = node, node.name
        self.foreign = bool(above and above.mode == "foreign") or node.name in ("math", "svg")
        if above and above.mode == "foreign":
            self.name = f"foreign:{node.name}"
            self.mode = "body" if node.name in INTEGRATION else "foreign"
        else:
            self.mode = MODES.get(node.name) or (above.mode if above else "body")
        self.paragraph = self.name == "p" or bool(above and above.paragraph and self.name not in SCOPE and self.name != "button")


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node()
        self.html, self.head, self.body = (Node(n) for n in ("html", "head", "body"))
        self._put(self.root, self.html)
        self._put(self.html, self.head)
        self.open: list[_Open] = [_Open(self.html, None)]
        self.active: list[Node | None] = []  # formatting elements; None marks where an object or cell begins
        self.form: Node | None = None
        self.count: dict[str, int] = {}
        self.stage, self.quirks, self.foster, self.skip_newline = "head", True, False, False
        self.text_of: Node | None = None  # a head or raw-text element whose text is being read

    # -- the stack

    @staticmethod
    def _put(parent: Node, child) -> None:
        if isinstance(child, Node):
            child.parent = parent
        elif isinstance(child, str) and parent.children and isinstance(parent.children[-1], str):
            parent.children[-1] += child
            return
        parent.children.append(child)

    def _push(self, node: Node) -> None:
        self.open.append(x := _Open(node, self.open[-1]))
        self.count[x.name] = self.count.get(x.name, 0) + 1

    def _pop(self) -> _Open:
        x = self.open.pop()
        self.count[x.name] -= 1
        return x

    def _place(self, child) -> None:
        """Under the current element, or before its table where a table can't hold it."""
        at = self.open[-1]
        if not (self.foster and at.name in SECTIONS | {"table", "tr"}):
            self._put(at.node, child)
            return
        table = next((x.node for x in reversed(self.open) if x.name == "table"), None)
        if table is None or table.parent is None:
            self._put(at.node, child)
            return
        siblings = table.parent.children
        i = siblings.index(table)
        if isinstance(child, Node):
            child.parent = table.parent
        elif isinstance(child, str) and i and isinstance(siblings[i - 1], str):
            siblings[i - 1] += child
            return
        siblings.insert(i, child)

    def _insert(self, name: str, attrs: dict[str, str | None]) -> Node:
        node = Node(name, attrs)
        self._place(node)
        self._push(node)
        return node

    def _in_scope(self, names: frozenset[str] | set[str], more: frozenset[str] = frozenset()) -> bool:
        if not any(self.count.get(n) for n in names):
            return False
        for x in reversed(self.open):
            if x.name in names:
                return True
            if x.name in SCOPE or x.name in more:
                return False
        return False

    def _implied_ends(self, but: str = "") -> None:
        while self.open[-1].name in IMPLIED_END and self.open[-1].name != but:
            self._pop()

    def _pop_to(self, names: frozenset[str] | set[str]) -> None:
        while self._pop().name not in names:
            pass

    def _close_paragraph(self) -> None:
        if self.open[-1].paragraph:
            self._pop_to({"p"})

    # -- formatting elements

    def _unmark(self) -> None:
        while self.active and self.active.pop() is not None:
            pass

    def _is_open(self, node: Node) -> bool:
        return bool(self.count.get(node.name)) and any(x.node is node for x in reversed(self.open))

    def _reopen(self) -> None:
        i = len(self.active)
        while i and self.active[i - 1] is not None and not self._is_open(self.active[i - 1]):
            i -= 1
        for k in range(i, len(self.active)):
            self.active[k] = self._insert(self.active[k].name, dict(self.active[k].attrs))

    def _format(self, node: Node) -> None:
        """Of equal formatting elements since the last mark at most three are kept."""
        alike = []
        for i in range(len(self.active) - 1, -1, -1):
            x = self.active[i]
            if x is None:
                break
            if x.name == node.name and x.attrs == node.attrs:
                alike.append(i)
        if len(alike) >= 3:
            del self.active[alike[-1]]
        self.active.append(node)

    def _formatting(self, name: str) -> Node | None:
        for x in reversed(self.active):
            if x is None:
                return None
            if x.name == name:
                return x
        return None

    def _adopt(self, name: str) -> bool:
        """The standard's adoption agency for an end tag; whether there was something to do it for."""
        if self.open[-1].name == name and self.open[-1].node not in self.active:
            self._pop()
            return True
        for _ in range(8):
            node = self._formatting(name)
            if node is None:
                return False
            place = next((i for i, x in enumerate(self.open) if x.node is node), None) if self.count.get(name) else None
            if place is None:
                self.active.remove(node)
                return True
            if any(x.name in SCOPE for x in self.open[place + 1 :]):
                return True
            far = next((i for i in range(place + 1, len(self.open)) if self.open[i].name in SPECIAL), None)
            if far is None:
                while self._pop().node is not node:
                    pass
                self.active.remove(node)
                return True
            block, above = self.open[far].node, self.open[place - 1].node
            mark = self.active.index(node)
            last, i, inner = block, far, 0
            while (i := i - 1) > place:
                inner += 1
                x = self.open[i].node
                if x in self.active and inner > 3:
                    where = self.active.index(x)
                    mark -= where < mark
                    del self.active[where]
                if x not in self.active:
                    self.count[self.open[i].name] -= 1
                    del self.open[i]
                    far -= 1
                    continue
                copy = Node(x.name, dict(x.attrs))
                where = self.active.index(x)
                self.active[where] = copy
                self.open[i].node = copy
                if last is block:
                    mark = where + 1
                self._move(last, copy)
                last = copy
            if last.parent is not None:
                last.remove()
            if above.name in SECTIONS | {"table", "tr"}:
                self.foster, kept = True, self.open
                self.open = kept[:place]
                self._place(last)
                self.open, self.foster = kept, False
            else:
                self._put(above, last)
            copy = Node(node.name, dict(node.attrs))
            for child in block.children:
                self._put(copy, child)
            block.children = []
            self._put(block, copy)
            where = self.active.index(node)
            del self.active[where]
            self.active.insert(mark - (where < mark), copy)
            place = next(i for i, x in enumerate(self.open) if x.node is node)
            del self.open[place]
            self.open.insert(next(i for i, x in enumerate(self.open) if x.node is block) + 1, _Open(copy, self.open[-1]))
            self._recount()
        return True

    def _move(self, node: Node, parent: Node) -> None:
        if node.parent is not None:
            node.remove()
        self._put(parent, node)

    def _recount(self) -> None:
        """Modes and paragraphs of the stack after it was changed within."""
        for i, x in enumerate(self.open):
            self.open[i] = _Open(x.node, self.open[i - 1] if i else None)

    # -- tags

    def handle_decl(self, decl):
        if self.stage == "head" and not self.head.children and decl.lower().split()[:2] == ["doctype", "html"]:
            self.quirks = False

    def handle_starttag(self, tag, attrs):
        given: dict[str, str | None] = {}
        for k, v in attrs:
            given.setdefault(k, v or "")  # of equal names the first counts
        self.skip_newline = False
        if self.open[-1].mode == "foreign" and self._foreign(tag, given):
            return
        if tag in ("html", "body"):
            if tag == "body" and self.stage != "body":
                self._begin_body()
            into = self.html if tag == "html" else self.body
            into.attrs = given | into.attrs
        elif tag == "head" or tag in ("frame", "frameset"):
            pass
        elif self.stage == "head" and tag in HEAD_TAGS:
            node = Node(tag, given)
            self._put(self.head, node)
            if tag in RAW_TEXT | RCDATA:
                self._read_text(node)
            elif tag == "template":
                self._push(node)
                self.active.append(None)
                self.stage = "body"  # until it ends
        else:
            if self.stage != "body":
                self._begin_body()
            self._start(tag, given)

    def handle_startendtag(self, tag, attrs):
        depth = len(self.open)
        self.handle_starttag(tag, attrs)
        if len(self.open) > depth and self.open[-1].mode == "foreign" and self.open[-1].node.name == tag:
            self._pop()

    def _begin_body(self) -> None:
        self.stage = "body"
        self._put(self.html, self.body)
        self._push(self.body)

    def _read_text(self, node: Node) -> None:
        self.text_of = node
        if node.name not in self.CDATA_CONTENT_ELEMENTS:
            self.set_cdata_mode(node.name)

    def _foreign(self, tag: str, attrs: dict[str, str | None]) -> bool:
        if tag in BREAKOUT or tag == "font" and attrs.keys() & {"color", "face", "size"}:
            while self.open[-1].mode == "foreign":
                self._pop()
            return False
        self._insert(tag, attrs)
        return True

    def _start(self, tag: str, attrs: dict[str, str | None]) -> None:
        mode = self.open[-1].mode
        if mode == "select":
            if tag in ("option", "optgroup"):
                if self.open[-1].name == "option":
                    self._pop()
                if tag == "optgroup" and self.open[-1].name == "optgroup":
                    self._pop()
                self._insert(tag, attrs)
            elif tag in ("input", "keygen", "textarea", "select") or tag in TABLE_PARTS | {"table"} and self.count.get("table"):
                self._pop_to({"select"})
                if tag != "select":
                    self._start(tag, attrs)
            elif tag == "script":
                self._read_text(self._insert(tag, attrs))
            return
        if mode in ("table", "section", "row", "columns", "caption", "cell") and self._table_start(tag, attrs, mode):
            return
        self.foster = mode in ("table", "section", "row")
        self._body_start("img" if tag == "image" else tag, attrs)
        self.foster = False

    def _table_start(self, tag: str, attrs: dict[str, str | None], mode: str) -> bool:
        """Tags that a table takes itself; it closes what can't hold them, and implies the parts that are missing."""
        if mode in ("cell", "caption"):
            if tag not in TABLE_PARTS:
                return False
            self._implied_ends()
            self._pop_to(CELLS if mode == "cell" else {"caption"})
            self._unmark()
            return self._table_start(tag, attrs, self.open[-1].mode)
        if mode == "columns":
            if tag == "col":
                self._place(Node(tag, attrs))
                return True
            self._pop_to({"colgroup"})
            return self._table_start(tag, attrs, self.open[-1].mode)
        if tag == "table":
            self._pop_to({"table"})
            self._start(tag, attrs)
            return True
        if tag not in TABLE_PARTS:
            if tag in ("script", "style"):
                self._read_text(self._insert(tag, attrs))
                return True
            if tag == "input" and (attrs.get("type") or "").lower() == "hidden":
                self._place(Node(tag, attrs))
                return True
            return False
        holder = {"row": "tr", "section": None, "table": "table"}[mode]
        while self.open[-1].mode == mode and not (self.open[-1].name == holder or holder is None and self.open[-1].name in SECTIONS):
            self._pop()
        if mode == "row" and tag not in CELLS or mode == "section" and tag not in CELLS | {"tr"}:
            self._pop()
            return self._table_start(tag, attrs, self.open[-1].mode)
        if mode == "table" and tag in CELLS | {"tr"}:
            self._insert("tbody", {})
        if mode == "table" and tag == "col":
            self._insert("colgroup", {})
            self._place(Node(tag, attrs))
            return True
        if mode != "row" and tag in CELLS:
            self._insert("tr", {})
        self._insert(tag, attrs)
        if tag in CELLS or tag == "caption":
            self.active.append(None)
        return True

    def _body_start(self, tag: str, attrs: dict[str, str | None]) -> None:
        if tag in TABLE_PARTS:
            return
        if tag in BLOCKS or tag in HEADINGS or tag in ("form", "hr", "xmp", "plaintext") or tag == "table" and not self.quirks:
            if tag == "form" and self.form is not None:
                return
            self._close_paragraph()
            if tag in HEADINGS and self.open[-1].name in HEADINGS:
                self._pop()
        elif tag in ("li", "dd", "dt"):
            alike = {"li"} if tag == "li" else {"dd", "dt"}
            if any(self.count.get(n) for n in alike):
                for x in reversed(self.open):
                    if x.name in alike:
                        self._implied_ends(x.name)
                        self._pop_to({x.name})
                        break
                    if x.name in SPECIAL and x.name not in ("address", "div", "p"):
                        break
            self._close_paragraph()
        elif tag in HEAD_TAGS:
            pass
        elif tag in ("rb", "rtc", "rp", "rt"):
            if self._in_scope({"ruby"}):
                self._implied_ends("rtc" if tag in ("rp", "rt") else "")
        elif tag in ("iframe", "noembed", "param", "source", "track"):
            pass
        else:
            if tag == "button" and self._in_scope({"button"}):
                self._implied_ends()
                self._pop_to({"button"})
            elif tag in ("option", "optgroup") and self.open[-1].name == "option":
                self._pop()
            elif tag == "a" and (old := self._formatting("a")) is not None:
                self._adopt("a")
                if old in self.active:
                    self.active.remove(old)
                if self._is_open(old):
                    self.open = [x for x in self.open if x.node is not old]
                    self.count["a"] -= 1
                    self._recount()
            self._reopen()
            if tag == "nobr" and self._in_scope({"nobr"}):
                self._adopt("nobr")
                self._reopen()
        if tag in VOID or tag == "keygen":
            self._place(Node(tag, attrs))
            return
        node = self._insert(tag, attrs)
        if tag in FORMATTING:
            self._format(node)
        elif tag in MARKED or tag == "template":
            self.active.append(None)
        elif tag == "form":
            self.form = node
        elif tag in RAW_TEXT | RCDATA:
            self._read_text(node)
        self.skip_newline = tag in ("pre", "listing", "textarea")

    def handle_endtag(self, tag):
        self.skip_newline = False
        if self.text_of is not None:
            if tag == self.text_of.name:
                if self.open[-1].node is self.text_of:
                    self._pop()
                self.text_of = None
            return
        if self.stage != "body":
            if tag != "br":
                return
            self._begin_body()
        mode = self.open[-1].mode
        if tag in ("html", "body", "head") or tag == "select" and not self.count.get("select"):
            return  # what follows goes on in the body
        if tag == "template":
            if self.count.get(tag):
                self._pop_to({tag})
                self._unmark()
            if self.body.parent is None and len(self.open) == 1:
                self.stage = "head"
            return
        if tag in ("p", "br"):
            while self.open[-1].mode == "foreign":
                self._pop()
            mode = self.open[-1].mode
        if self.open[-1].foreign:
            i = len(self.open) - 1
            while self.open[i].foreign:
                if self.open[i].node.name == tag:
                    while len(self.open) > i:
                        self._pop()
                    return
                i -= 1
            mode = self.open[i].mode
        if mode == "select":
            if tag == "optgroup" and self.open[-1].name == "option" and self.open[-2].name == "optgroup":
                self._pop()
            if tag == "select" or tag in ("option", "optgroup") and self.open[-1].name == tag:
                self._pop_to({tag})
            return
        if tag in TABLE_PARTS | {"table"}:
            self._table_end(tag, mode)
            return
        if tag == "form":
            node, self.form = self.form, None
            if node is not None and self._is_open(node):
                self._implied_ends()
                self.open = [x for x in self.open if x.node is not node]
                self.count["form"] -= 1
                self._recount()
        elif tag == "p":
            if not self.open[-1].paragraph:
                self._insert("p", {})
            self._close_paragraph()
        elif tag == "br":
            self._reopen()
            self._place(Node("br", {}))
        elif tag in HEADINGS:
            if self._in_scope(HEADINGS):
                self._implied_ends()
                self._pop_to(HEADINGS)
        elif tag in ("li", "dd", "dt") or tag in BLOCKS or tag in MARKED or tag == "button":
            if self._in_scope({tag}, frozenset({"ol", "ul"}) if tag == "li" else frozenset()):
                self._implied_ends(tag)
                self._pop_to({tag})
                if tag in MARKED:
                    self._unmark()
        elif not (tag in FORMATTING and self._adopt(tag)) and self.count.get(tag):
            for x in reversed(self.open):
                if x.name == tag:
                    self._implied_ends(tag)
                    while self._pop() is not x:
                        pass
                    break
                if x.name in SPECIAL:
                    break

    def _table_end(self, tag: str, mode: str) -> None:
        if mode in ("body", "foreign") or not self.count.get(tag) or not self._in_table_scope(tag):
            return
        self._implied_ends()
        while True:
            x = self._pop()
            if x.name in CELLS or x.name == "caption":
                self._unmark()
            if x.name == tag:
                return

    def _in_table_scope(self, tag: str) -> bool:
        for x in reversed(self.open):
            if x.name == tag:
                return True
            if x.name in ("table", "template"):
                return False
        return False

    # -- text

    def handle_data(self, data):
        if self.text_of is not None:
            data = unescape(data) if self.text_of.name in RCDATA else data
            if self.skip_newline:
                data = data.removeprefix("\n")
            self._put(self.text_of, data)
            self.skip_newline = False
            return
        if self.skip_newline:
            data, self.skip_newline = data.removeprefix("\n"), False
        if self.stage != "body":
            data = data.lstrip(SPACE)
            if not data:
                return
            self._begin_body()
        if not data:
            return
        mode, blank = self.open[-1].mode, not data.strip(SPACE)
        if mode == "columns":
            if blank:
                return
            self._pop_to({"colgroup"})
            mode = self.open[-1].mode
        if mode in ("foreign", "select") or blank and mode in ("table", "section", "row"):
            self._place(data)
            return
        self.foster = mode in ("table", "section", "row")
        self._reopen()
        self._place(data)
        self.foster = False

    def handle_comment(self, data):
        if self.stage == "body":
            self.open[-1].node.children.append(("comment", data))


class Page:
    """The tree of a page: its document node, its body, and whether it is in quirks mode, where class names match in any case."""

    def __init__(self, html: str | None):
        b = _Builder()
        b.feed(html or "")
        b.close()
        if b.body.parent is None:
            b._begin_body()
        self.root, self.body, self.quirks = b.root, b.body, b.quirks
        for x in self.root.elements():
            if x.name == "template":
                x.children = []
