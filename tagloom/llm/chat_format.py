"""Chat formatting with compiled templates.

A small sandboxed template language is parsed to a syntax tree, constants are
folded, and the tree becomes Python closures. The language has text,
``{{ expression }}`` and ``{% for name in expression %}``, ``{% if %}``,
``{% elif %}``, ``{% else %}``, ``{% generation %}`` (its output is under the
loss mask) with their ends ``{% endfor %}``, ``{% endif %}``,
``{% endgeneration %}``. A tag with a dash ({%- -%}) strips the white space on
that side. Expressions know strings, whole numbers, true, false, none, names,
fields (``a.b``, ``a['b']``), ``+ == != < > and or not``, and the filters
``trim upper lower length escape line``. There are no calls, attributes of Python
objects or imports: a name reads the given values and a field reads a mapping.

``escape`` makes control strings harmless, reversibly: ``<|`` becomes ``<\\|``,
and a backslash behind ``<`` gets one more. So what a text says can't be taken
for a marker, and ``read_back`` restores turns and loss texts exactly. ``line``
does the same for what must stay on one line (a role): a line feed becomes the
control string ``<|lf|>``, which an escaped text can't hold.

Edge cases: a null text or role is empty; rows that repeat a turn keep their
order by role and text; a null conv_id is a conversation of its own; one
conversation of any length is formatted as a stream, turn by turn.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mapped

START, END, FEED = "<|im_start|>", "<|im_end|>", "<|lf|>"
CHAT = "{% for m in messages %}" + START + "{{ m.role | line }}\n{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}{% else %}{{ m.text | escape }}{% endif %}" + END + "\n{% endfor %}"

TAG = re.compile(r"\{(\{|%)(-?)\s*(.*?)\s*(-?)(\}|%)\}", re.S)
TOKEN = re.compile(r"\s*(?:(?P<string>'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(?P<number>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<op>==|!=|[|.+<>()\[\]]))")
ESCAPES = {"n": "\n", "t": "\t", "\\": "\\", "'": "'", '"': '"'}
RESERVED = {"and", "or", "not", "true", "false", "none", "in"}


class TemplateError(ValueError):
    """The template is not in the language."""


def escape(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\1\\|", text) if "<" in text else text


def unescape(text: str) -> str:
    return re.sub(r"<(\\*)\\\|", r"<\1|", text) if "<\\" in text else text


FILTERS: dict[str, Callable[[Any], Any]] = {
    "trim": lambda x: _text(x).strip(),
    "upper": lambda x: _text(x).upper(),
    "lower": lambda x: _text(x).lower(),
    "length": lambda x: len(x) if isinstance(x, (str, list, dict)) else 0,
    "escape": lambda x: escape(_text(x)),
    "line": lambda x: escape(_text(x)).replace("\n", FEED),
}


def _text(x: Any) -> str:
    return "" if x is None else x if isinstance(x, str) else ("true" if x else "false") if isinstance(x, bool) else str(x)


class Expression:
    """Recursive descent over an expression; nodes are tuples (kind, ...)."""

    def __init__(self, source: str):
        self.tokens, at = [], 0
        while source[at:].strip():
            if not (m := TOKEN.match(source, at)):
                raise TemplateError(f"unexpected text in expression: {source[at:]!r}")
            self.tokens.append((m.lastgroup, m[m.lastgroup]))
            at = m.end()
        self.at = 0
        self.tree = self._or()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r} in {source!r}")

    def _peek(self) -> str | None:
        return self.tokens[self.at][1] if self.at < len(self.tokens) and self.tokens[self.at][0] != "string" else None

    def _take(self, *wanted: str) -> str | None:
        if (t := self._peek()) in wanted:
            self.at += 1
            return t
        return None

    def _or(self):
        left = self._and()
        while self._take("or"):
            left = ("or", left, self._and())
        return left

    def _and(self):
        left = self._not()
        while self._take("and"):
            left = ("and", left, self._not())
        return left

    def _not(self):
        return ("not", self._not()) if self._take("not") else self._compare()

    def _compare(self):
        left = self._sum()
        while op := self._take("==", "!=", "<", ">"):
            left = (op, left, self._sum())
        return left

    def _sum(self):
        left = self._filtered()
        while self._take("+"):
            left = ("+", left, self._filtered())
        return left

    def _filtered(self):
        left = self._field()
        while self._take("|"):
            kind, name = self._next()
            if kind != "name" or name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            left = ("filter", name, left)
        return left

    def _field(self):
        left = self._atom()
        while op := self._take(".", "["):
            kind, value = self._next()
            if op == "." and kind == "name" or op == "[" and kind == "string":
                left = ("field", left, value if op == "." else self._string(value))
            elif op == "[" and kind == "number":
                left = ("field", left, int(value))
            else:
                raise TemplateError(f"bad field {value!r}")
            if op == "[" and not self._take("]"):
                raise TemplateError("missing ]")
        return left

    def _next(self) -> tuple[str, str]:
        if self.at >= len(self.tokens):
            raise TemplateError("expression ends too early")
        self.at += 1
        return self.tokens[self.at - 1]

    @staticmethod
    def _string(raw: str) -> str:
        return re.sub(r"\\(.)", lambda m: ESCAPES.get(m[1], m[0]), raw[1:-1], flags=re.S)

    def _atom(self):
        if self._take("("):
            inner = self._or()
            if not self._take(")"):
                raise TemplateError("missing )")
            return inner
        kind, value = self._next()
        if kind == "string":
            return ("const", self._string(value))
        if kind == "number":
            return ("const", int(value))
        if kind == "name" and value in ("true", "false", "none"):
            return ("const", {"true": True, "false": False, "none": None}[value])
        if kind == "name" and value not in RESERVED:
            return ("name", value)
        raise TemplateError(f"unexpected {value!r}")


def parse(source: str) -> list:
    """Nodes: ("text", s), ("out", e), ("for", name, e, body), ("if", [(e, body)...]), ("generation", body)."""
    root: list = []
    stack: list[tuple[str, list, Any]] = [("", root, None)]
    at, strip = 0, False
    for m in TAG.finditer(source):
        if (m[1] == "{") != (m[5] == "}"):
            raise TemplateError(f"unbalanced tag {m[0]!r}")
        text = source[at : m.start()]
        text = text.lstrip() if strip else text
        text = text.rstrip() if m[2] else text
        at, strip = m.end(), bool(m[4])
        body = stack[-1][1]
        if text:
            body.append(("text", text))
        if m[1] == "{":
            body.append(("out", Expression(m[3]).tree))
            continue
        word, _, rest = m[3].partition(" ")
        if word == "for":
            if not (f := re.fullmatch(r"\s*([A-Za-z_]\w*)\s+in\s+(.+)", rest, re.S)) or f[1] in RESERVED:
                raise TemplateError(f"bad loop {m[0]!r}")
            inner: list = []
            body.append(("for", f[1], Expression(f[2]).tree, inner))
            stack.append(("for", inner, None))
        elif word == "if":
            branches = [(Expression(rest).tree, inner := [])]
            body.append(("if", branches))
            stack.append(("if", inner, branches))
        elif word in ("elif", "else") and stack[-1][0] == "if":
            branches = stack.pop()[2]
            branches.append((Expression(rest).tree if word == "elif" else ("const", True), inner := []))
            stack.append(("if", inner, branches))
        elif word == "generation":
            if any(k == "generation" for k, _, _ in stack):
                raise TemplateError("generation within generation")
            body.append(("generation", inner := []))
            stack.append(("generation", inner, None))
        elif word == f"end{stack[-1][0]}" and len(stack) > 1:
            stack.pop()
        else:
            raise TemplateError(f"unexpected tag {m[0]!r}")
    if len(stack) > 1:
        raise TemplateError(f"{stack[-1][0]} is not closed")
    if tail := (source[at:].lstrip() if strip else source[at:]):
        root.append(("text", tail))
    return root


def _apply(kind: str, *x: Any) -> Any:
    if kind == "+":
        return x[0] + x[1] if all(isinstance(v, int) and not isinstance(v, bool) for v in x) else _text(x[0]) + _text(x[1])
    if kind in "<>":
        a, b = x if kind == "<" else x[::-1]
        return a < b if type(a) is type(b) and isinstance(a, (int, str)) else False
    return x[0] == x[1] if kind == "==" else x[0] != x[1]


def fold(e: tuple) -> tuple:
    """The expression with constant parts computed."""
    kind = e[0]
    if kind in ("const", "name"):
        return e
    if kind == "filter":
        inner = fold(e[2])
        return ("const", FILTERS[e[1]](inner[1])) if inner[0] == "const" else ("filter", e[1], inner)
    if kind == "field":
        return ("field", fold(e[1]), e[2])
    if kind == "not":
        inner = fold(e[1])
        return ("const", not inner[1]) if inner[0] == "const" else ("not", inner)
    a, b = fold(e[1]), fold(e[2])
    if kind in ("and", "or"):
        return (b if bool(a[1]) == (kind == "and") else a) if a[0] == "const" else (kind, a, b)
    return ("const", _apply(kind, a[1], b[1])) if a[0] == b[0] == "const" else (kind, a, b)


def fold_nodes(nodes: list) -> list:
    """The nodes with constants folded, dead branches gone and neighbouring texts joined."""
    out: list = []

    def add(node: tuple) -> None:
        if node[0] == "text" and out and out[-1][0] == "text":
            out[-1] = ("text", out[-1][1] + node[1])
        elif node != ("text", ""):
            out.append(node)

    for node in nodes:
        if node[0] == "out":
            e = fold(node[1])
            add(("text", _text(e[1])) if e[0] == "const" else ("out", e))
        elif node[0] == "for":
            add(("for", node[1], fold(node[2]), fold_nodes(node[3])))
        elif node[0] == "generation":
            add(("generation", fold_nodes(node[1])))
        elif node[0] == "if":
            left = []
            for e, body in node[1]:
                e = fold(e)
                if e[0] != "const" or e[1]:
                    left.append((e, fold_nodes(body)))
                if e[0] == "const" and e[1]:
                    break
            if left and left[0][0][0] == "const":
                for x in left[0][1]:
                    add(x)
            elif left:
                add(("if", left))
        else:
            add(node)
    return out


def _value(e: tuple) -> Callable[[dict], Any]:
    kind = e[0]
    if kind == "const":
        return lambda scope, v=e[1]: v
    if kind == "name":
        return lambda scope, n=e[1]: scope.get(n)
    if kind == "field":
        of, name = _value(e[1]), e[2]

        def field(scope: dict) -> Any:
            x = of(scope)
            if isinstance(x, dict):
                return x.get(name)
            return x[name] if isinstance(x, list) and isinstance(name, int) and name < len(x) else None

        return field
    if kind == "filter":
        return lambda scope, f=FILTERS[e[1]], of=_value(e[2]): f(of(scope))
    if kind == "not":
        return lambda scope, of=_value(e[1]): not of(scope)
    a, b = _value(e[1]), _value(e[2])
    if kind == "and":
        return lambda scope: a(scope) and b(scope)
    if kind == "or":
        return lambda scope: a(scope) or b(scope)
    return lambda scope: _apply(kind, a(scope), b(scope))


Emit = Callable[[dict, Callable[[str, bool], None], bool], None]


def _closure(nodes: list) -> Emit:
    steps: list[Emit] = []
    for node in nodes:
        if node[0] == "text":
            steps.append(lambda scope, emit, loss, s=node[1]: emit(s, loss))
        elif node[0] == "out":
            steps.append(lambda scope, emit, loss, of=_value(node[1]): emit(_text(of(scope)), loss))
        elif node[0] == "generation":
            steps.append(lambda scope, emit, loss, body=_closure(node[1]): body(scope, emit, True))
        elif node[0] == "for":

            def loop(scope, emit, loss, name=node[1], of=_value(node[2]), body=_closure(node[3])):
                items = of(scope)
                for x in items if items is not None else ():
                    body({**scope, name: x}, emit, loss)

            steps.append(loop)
        else:

            def choose(scope, emit, loss, branches=tuple((_value(e), _closure(body)) for e, body in node[1])):
                for test, body in branches:
                    if test(scope):
                        return body(scope, emit, loss)

            steps.append(choose)

    def run(scope: dict, emit: Callable[[str, bool], None], loss: bool) -> None:
        for step in steps:
            step(scope, emit, loss)

    return run


class Template:
    """A compiled template."""

    def __init__(self, source: str):
        self.nodes = fold_nodes(parse(source))
        self.run = _closure(self.nodes)

    def spans(self, **scope: Any) -> list[tuple[str, bool]]:
        """Parts of the output in order, each with whether it is under the loss mask."""
        parts: list[tuple[str, bool]] = []
        self.run(scope, lambda s, loss: parts.append((s, loss)), False)
        return parts

    def render(self, **scope: Any) -> str:
        return "".join(s for s, _ in self.spans(**scope))


def loss_spans(parts: list[tuple[str, bool]]) -> list[tuple[int, int]]:
    """(start, end) of each stretch of the output that is under the mask."""
    at, out = 0, []
    for s, loss in parts:
        if loss and s:
            if out and out[-1][1] == at:
                out[-1] = (out[-1][0], at + len(s))
            else:
                out.append((at, at + len(s)))
        at += len(s)
    return out


TURN = re.compile(re.escape(START) + r"(.*?)\n(.*?)" + re.escape(END) + "\n", re.S)


def read_back(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn in the output of CHAT."""
    out, at = [], 0
    for m in TURN.finditer(formatted):
        if m.start() != at:
            raise ValueError("text between turns")
        at = m.end()
        out.append((unescape(m[1].replace(FEED, "\n")), unescape(m[2])))
    if at != len(formatted):
        raise ValueError("text after the last turn")
    return out


def _ordered(rows: DataFrame) -> DataFrame:
    """conv, turn, role, text, with a conversation's rows together and in order; sorting spills, nothing is gathered."""
    picked = rows.select(F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return picked.repartition("conv").sortWithinPartitions("conv", "turn", "role", "text")


def formatted_turns(rows: DataFrame, source: str = CHAT) -> DataFrame:
    """conv_id, turn, formatted, loss array<struct<start, end>> of each turn; a conversation is its turns' joined outputs. The template loops over messages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        template = Template(source)
        for b in batches:
            made = [template.spans(messages=[{"role": r, "text": t}]) for r, t in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True)]
            spans = pa.array([[{"start": i, "end": j} for i, j in loss_spans(p)] for p in made], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(["".join(s for s, _ in p) for p in made], pa.string()), spans], ["conv_id", "turn", "formatted", "loss"])

    return _ordered(rows).transform(mapped, run, "conv_id long, turn long, formatted string, loss array<struct<start: long, end: long>>")


class _Digest:
    """What is read back from one conversation's output, turn by turn."""

    def __init__(self):
        self.turns = self.loss_chars = self.chars = 0
        self.turns_hash, self.loss_hash = hashlib.sha256(), hashlib.sha256()

    def add(self, formatted: str, spans: list[tuple[int, int]]) -> None:
        for role, text in read_back(formatted):
            self.turns += 1
            self.turns_hash.update(f"{role}\n{text}\n".encode())
        for i, j in spans:
            loss = unescape(formatted[i:j])
            self.loss_chars += len(loss)
            self.loss_hash.update(loss.encode())
        self.chars += len(formatted)


DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def digests(rows: DataFrame, source: str = CHAT) -> DataFrame:
    """Formats each conversation of rows(conv_id, turn, role, text) and returns what is read back from the output."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        template, now, state = Template(source), None, None

        def batch(done: list[tuple[int | None, _Digest]]) -> pa.RecordBatch:
            cols = [(c, d.turns, d.turns_hash.hexdigest(), d.loss_chars, d.loss_hash.hexdigest(), d.chars) for c, d in done]
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in cols], k) for i, k in enumerate(kinds)], [x.split()[0] for x in DIGEST.split(", ")])

        for b in batches:
            done = []
            for conv, role, text in zip(*(b.column(i).to_pylist() for i in (0, 2, 3)), strict=True):
                if state is None or conv != now:
                    if state is not None:
                        done.append((now, state))
                    now, state = conv, _Digest()
                parts = template.spans(messages=[{"role": role, "text": text}])
                state.add("".join(s for s, _ in parts), loss_spans(parts))
            yield batch(done)
        if state is not None:
            yield batch([(now, state)])

    return _ordered(rows).transform(mapped, run, DIGEST)
