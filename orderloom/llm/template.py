"""A small template language for chats, compiled to Python closures.

    {{ expression }}   {% for x in list %}..{% endfor %}   {% if a %}..{% elif b %}..{% else %}..{% endif %}
    {% set name = expression %}   {% generation %}..{% endgeneration %}   {# comment #}

Expressions know strings, whole numbers, true, false, none, names, ``a.b`` and ``a['b']``, ``| filter``, ``~ + - ==
!= < > <= >= in``, ``not in``, ``and or not`` and parentheses. Templates are closed in: names come from the values
given, members are looked up in dictionaries and lists only, never as attributes, and there are no calls but the
filters listed. Text between ``generation`` marks is what a model is to learn.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from typing import Any


class TemplateError(ValueError):
    """The template is not well formed, or asks for something it may not have."""


@dataclass(frozen=True)
class Const:
    value: Any


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Member:
    of: Any
    key: Any


@dataclass(frozen=True)
class Binary:
    op: str
    left: Any
    right: Any


@dataclass(frozen=True)
class Not:
    of: Any


@dataclass(frozen=True)
class Filtered:
    name: str
    of: Any


@dataclass
class Text:
    text: str


@dataclass
class Output:
    of: Any


@dataclass
class For:
    name: str
    of: Any
    body: list


@dataclass
class If:
    branches: list = field(default_factory=list)  # (condition, body); the condition of "else" is true


@dataclass
class Set:
    name: str
    of: Any


@dataclass
class Generation:
    body: list


_TAGS = re.compile(r"(\{%-?.*?-?%\}|\{\{-?.*?-?\}\}|\{#.*?#\})", re.S)
_TOKEN = re.compile(r"""\s*(?:(?P<string>'(?:\\.|[^'\\])*'|"(?:\\.|[^"\\])*")|(?P<number>\d+)|(?P<word>[A-Za-z_]\w*)"""
                    r"""|(?P<sign>==|!=|<=|>=|[<>|~+\-().\[\]=]))""", re.S)
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}
_WORDS = {"true": True, "false": False, "none": None}
_RESERVED = {"and", "or", "not", "in", "if", "elif", "else", "for"}
_LEVELS = (("or",), ("and",), ("==", "!=", "<", ">", "<=", ">=", "in", "not in"), ("~", "+", "-"))
_OPERATORS: dict[str, Callable[[Any, Any], Any]] = {
    "==": lambda a, b: a == b, "!=": lambda a, b: a != b, "<": lambda a, b: a < b, ">": lambda a, b: a > b,
    "<=": lambda a, b: a <= b, ">=": lambda a, b: a >= b, "in": lambda a, b: a in b,
    "not in": lambda a, b: a not in b, "~": lambda a, b: _shown(a) + _shown(b), "+": lambda a, b: a + b,
    "-": lambda a, b: a - b,
}


def _shown(value: Any) -> str:
    return "" if value is None else value if isinstance(value, str) else str(value)


class _Expression:
    """Reads one expression by levels of binding."""

    def __init__(self, source: str, filters: dict[str, Callable]):
        self.tokens, self.filters, self.source = [], filters, source
        at = 0
        while source[at:].strip():
            m = _TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"cannot read {source[at:]!r}")
            self.tokens.append((m.lastgroup, m[m.lastgroup]))
            at = m.end()
        self.at = 0

    def peek(self, ahead: int = 0) -> tuple[str | None, str | None]:
        return self.tokens[self.at + ahead] if self.at + ahead < len(self.tokens) else (None, None)

    def take(self, value: str) -> None:
        if self.peek()[1] != value or self.peek()[0] == "string":
            raise TemplateError(f"{value!r} expected in {self.source!r}")
        self.at += 1

    def whole(self) -> Any:
        found = self.level(0)
        if self.at < len(self.tokens):
            raise TemplateError(f"{self.peek()[1]!r} not expected in {self.source!r}")
        return found

    def operator(self, names: tuple[str, ...]) -> str | None:
        kind, value = self.peek()
        if kind == "string":
            return None
        if value == "not" and "not in" in names and self.peek(1)[1] == "in":
            self.at += 2
            return "not in"
        if value in names:
            self.at += 1
            return value
        return None

    def level(self, n: int) -> Any:
        if n == len(_LEVELS):
            return self.one()
        if n == 2 and self.peek() == ("word", "not"):
            self.at += 1
            return Not(self.level(2))
        left = self.level(n + 1)
        while op := self.operator(_LEVELS[n]):
            left = Binary(op, left, self.level(n + 1))
        return left

    def one(self) -> Any:
        kind, value = self.peek()
        self.at += 1
        if kind == "string":
            found = Const(re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), value[1:-1], flags=re.S))
        elif kind == "number":
            found = Const(int(value))
        elif kind == "word" and value not in _RESERVED:
            found = Const(_WORDS[value]) if value in _WORDS else Name(value)
        elif value == "(":
            found = self.level(0)
            self.take(")")
        else:
            raise TemplateError(f"a value expected in {self.source!r}")
        while self.peek()[0] == "sign" and self.peek()[1] in ".[|":
            sign = self.peek()[1]
            self.at += 1
            if sign == "[":
                found = Member(found, self.level(0))
                self.take("]")
                continue
            kind, value = self.peek()
            if kind != "word":
                raise TemplateError(f"a name expected after {sign!r} in {self.source!r}")
            self.at += 1
            if sign == ".":
                found = Member(found, Const(value))
            elif value in self.filters:
                found = Filtered(value, found)
            else:
                raise TemplateError(f"no filter named {value!r}")
        return found


def parse(source: str, filters: dict[str, Callable]) -> list:
    """The syntax tree of a template."""
    pieces = _TAGS.split(source)
    for i in range(1, len(pieces), 2):  # a minus sign inside a tag takes the white space beside it
        if pieces[i][2] == "-":
            pieces[i - 1] = pieces[i - 1].rstrip()
        if pieces[i][-3] == "-":
            pieces[i + 1] = pieces[i + 1].lstrip()
    root: list = []
    open_: list[tuple[str, Any, list]] = [("", None, root)]

    def expression(text: str) -> Any:
        return _Expression(text, filters).whole()

    def close(kind: str) -> None:
        if open_[-1][0] != kind:
            raise TemplateError(f"end of {kind} without its start")
        open_.pop()
    for i, piece in enumerate(pieces):
        body = open_[-1][2]
        if i % 2 == 0:
            if piece:
                body.append(Text(piece))
            continue
        inner = piece[2:-2].strip("-").strip() if piece[1] != "#" else ""
        if piece[1] == "#":
            continue
        if piece[1] == "{":
            body.append(Output(expression(inner)))
            continue
        word, _, rest = inner.partition(" ")
        if word == "for":
            m = re.fullmatch(r"([A-Za-z_]\w*)\s+in\s+(.+)", rest.strip(), re.S)
            if not m:
                raise TemplateError(f"cannot read {inner!r}")
            body.append(node := For(m[1], expression(m[2]), []))
            open_.append(("for", node, node.body))
        elif word == "if":
            body.append(node := If([(expression(rest), [])]))
            open_.append(("if", node, node.branches[-1][1]))
        elif word in ("elif", "else"):
            kind, node, _ = open_[-1]
            if kind != "if":
                raise TemplateError(f"{word} without if")
            node.branches.append((expression(rest) if word == "elif" else Const(True), []))
            open_[-1] = ("if", node, node.branches[-1][1])
        elif word == "set":
            name, sign, value = rest.partition("=")
            if not sign or not name.strip().isidentifier():
                raise TemplateError(f"cannot read {inner!r}")
            body.append(Set(name.strip(), expression(value)))
        elif word == "generation":
            body.append(node := Generation([]))
            open_.append(("generation", node, node.body))
        elif word in ("endfor", "endif", "endgeneration"):
            close(word.removeprefix("end"))
        else:
            raise TemplateError(f"cannot read {inner!r}")
    if len(open_) > 1:
        raise TemplateError(f"{open_[-1][0]} without its end")
    return root


def fold_expression(node: Any, filters: dict[str, Callable]) -> Any:
    """The expression with all parts worked out that do not depend on values given later."""
    def fold(x: Any) -> Any:
        return fold_expression(x, filters)
    if isinstance(node, Binary):
        left, right = fold(node.left), fold(node.right)
        if node.op in ("and", "or"):
            if isinstance(left, Const):
                return right if bool(left.value) == (node.op == "and") else left
        elif isinstance(left, Const) and isinstance(right, Const):
            return Const(_OPERATORS[node.op](left.value, right.value))
        return Binary(node.op, left, right)
    if isinstance(node, Not):
        of = fold(node.of)
        return Const(not of.value) if isinstance(of, Const) else Not(of)
    if isinstance(node, Filtered):
        of = fold(node.of)
        return Const(filters[node.name](of.value)) if isinstance(of, Const) else Filtered(node.name, of)
    if isinstance(node, Member):
        return Member(fold(node.of), fold(node.key))
    return node


def fold(body: list, filters: dict[str, Callable]) -> list:
    """The tree with constant output as text, neighbouring texts joined, and branches gone that are never taken."""
    out: list = []

    def add(node: Any) -> None:
        if isinstance(node, Text) and out and isinstance(out[-1], Text):
            out[-1] = Text(out[-1].text + node.text)
        elif not (isinstance(node, Text) and not node.text):
            out.append(node)
    for node in body:
        if isinstance(node, Output):
            of = fold_expression(node.of, filters)
            if isinstance(of, Binary) and of.op == "~" or isinstance(of, Binary) and of.op == "+" and (
                    isinstance(of.left, Const) and isinstance(of.left.value, str)
                    or isinstance(of.right, Const) and isinstance(of.right.value, str)):
                for part in fold([Output(of.left), Output(of.right)], filters):  # strings put one after the other
                    add(part)
            else:
                add(Text(_shown(of.value)) if isinstance(of, Const) else Output(of))
        elif isinstance(node, For):
            out.append(For(node.name, fold_expression(node.of, filters), fold(node.body, filters)))
        elif isinstance(node, If):
            left: list = []
            for condition, inner in node.branches:
                condition = fold_expression(condition, filters)
                if isinstance(condition, Const) and not condition.value:
                    continue
                left.append((condition, fold(inner, filters)))
                if isinstance(condition, Const):
                    break
            if left and isinstance(left[0][0], Const):
                for part in left[0][1]:
                    add(part)
            elif left:
                out.append(If(left))
        elif isinstance(node, Set):
            out.append(Set(node.name, fold_expression(node.of, filters)))
        elif isinstance(node, Generation):
            out.append(Generation(fold(node.body, filters)))
        else:
            add(node)
    return out


Scope = dict[str, Any]
Pieces = Iterator[tuple[str, bool]]


def _value(node: Any, filters: dict[str, Callable]) -> Callable[[Scope], Any]:
    """A closure that works the expression out."""
    if isinstance(node, Const):
        constant = node.value
        return lambda scope: constant
    if isinstance(node, Name):
        name = node.name

        def look(scope: Scope) -> Any:
            if name not in scope:
                raise TemplateError(f"no value named {name!r}")
            return scope[name]
        return look
    if isinstance(node, Member):
        of, key = _value(node.of, filters), _value(node.key, filters)

        def member(scope: Scope) -> Any:
            held, k = of(scope), key(scope)
            if isinstance(held, dict):
                return held.get(k)
            if isinstance(held, (list, tuple, str)) and isinstance(k, int):
                return held[k] if -len(held) <= k < len(held) else None
            raise TemplateError(f"no member {k!r}")
        return member
    if isinstance(node, Not):
        of = _value(node.of, filters)
        return lambda scope: not of(scope)
    if isinstance(node, Filtered):
        of, run = _value(node.of, filters), filters[node.name]
        return lambda scope: run(of(scope))
    left, right = _value(node.left, filters), _value(node.right, filters)
    if node.op == "and":
        return lambda scope: left(scope) and right(scope)
    if node.op == "or":
        return lambda scope: left(scope) or right(scope)
    operate = _OPERATORS[node.op]
    return lambda scope: operate(left(scope), right(scope))


def _render(body: list, filters: dict[str, Callable], learned: bool) -> Callable[[Scope], Pieces]:
    """A closure that renders the nodes, piece by piece."""
    steps = [_step(node, filters, learned) for node in body]

    def run(scope: Scope) -> Pieces:
        for step in steps:
            yield from step(scope)
    return run


def _step(node: Any, filters: dict[str, Callable], learned: bool) -> Callable[[Scope], Iterable]:
    if isinstance(node, Text):
        pieces = ((node.text, learned),)
        return lambda scope: pieces
    if isinstance(node, Output):
        of = _value(node.of, filters)
        return lambda scope: ((_shown(of(scope)), learned),)
    if isinstance(node, Set):
        of, name = _value(node.of, filters), node.name

        def put(scope: Scope) -> Iterable:
            scope[name] = of(scope)
            return ()
        return put
    if isinstance(node, Generation):
        return _render(node.body, filters, True)
    if isinstance(node, If):
        branches = [(_value(c, filters), _render(b, filters, learned)) for c, b in node.branches]

        def choose(scope: Scope) -> Iterable:
            for condition, body in branches:
                if condition(scope):
                    return body(scope)
            return ()
        return choose
    of, body, name = _value(node.of, filters), _render(node.body, filters, learned), node.name

    def each(scope: Scope) -> Pieces:
        items = of(scope)
        if isinstance(items, (str, dict)) or not isinstance(items, Iterable):
            raise TemplateError("for needs a list")
        items, inner = iter(items), dict(scope)
        at, item = 0, next(items, _END)
        while item is not _END:
            following = next(items, _END)
            inner[name] = item
            inner["loop"] = {"index": at + 1, "index0": at, "first": at == 0, "last": following is _END}
            yield from body(inner)
            at, item = at + 1, following
    return each


_END = object()


def _uses(node: Any, name: str, looped: bool = False) -> list[bool]:
    """For each use of a name, whether it is as what a loop that runs once goes through."""
    if isinstance(node, For):
        first = [not looped] if node.of == Name(name) else _uses(node.of, name, looped)
        return first + _uses(node.body, name, True)
    if isinstance(node, Name):
        return [False] if node.name == name else []
    if isinstance(node, (list, tuple)):
        return [u for x in node for u in _uses(x, name, looped)]
    if hasattr(node, "__dict__"):
        return [u for x in vars(node).values() for u in _uses(x, name, looped)]
    return []


@dataclass
class Template:
    """A compiled template. ``streams``: messages are gone through once, so that they need not be held together."""

    render: Callable[[Scope], Pieces]
    streams: bool


def compile_template(source: str, filters: dict[str, Callable] | None = None) -> Template:
    filters = filters or {}
    tree = fold(parse(source, filters), filters)
    return Template(_render(tree, filters, False), _uses(tree, "messages") in ([], [True]))
