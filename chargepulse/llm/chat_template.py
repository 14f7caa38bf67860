"""A small sandboxed template language, compiled to Python closures.

    {{ expression | filter }}     output
    {% for m in messages %} ... {% endfor %}      with loop.first, loop.last, loop.index
    {% if e %} ... {% elif e %} ... {% else %} ... {% endif %}
    {% generation %} ... {% endgeneration %}      marks what a model is trained on

Expressions: names, attributes of mappings, string and whole-number literals,
``~`` (join as text), ``==``, ``!=``, ``and``, ``or``, ``not``, parentheses, and the
filters given to the compiler.  There are no calls, no Python attributes and
no loops but ``for`` over a given sequence, so a template cannot reach anything
it was not given.

A template is parsed into a syntax tree; constant expressions, conditions and
neighbouring text are folded; the tree becomes closures that yield
(text, generated) pieces, so a conversation is rendered as its turns arrive.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator, Mapping
from dataclasses import dataclass, fields, is_dataclass

Piece = tuple[str, bool]
_TAG = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}", re.S)
_TOKEN = re.compile(r"""\s*(?:(?P<text>"[^"\\]*(?:\\.[^"\\]*)*"|'[^'\\]*(?:\\.[^'\\]*)*')|(?P<int>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<op>==|!=|[~|.()]))""")
_ESCAPES = {"n": "\n", "t": "\t", "\\": "\\", "'": "'", '"': '"'}


class TemplateError(ValueError):
    """The template is not in the language."""


# -------------------------------------------------------------- syntax tree
@dataclass
class Const:
    value: object


@dataclass
class Name:
    name: str


@dataclass
class Attribute:
    of: object
    name: str


@dataclass
class Filter:
    of: object
    name: str


@dataclass
class Not:
    of: object


@dataclass
class Binary:
    op: str
    left: object
    right: object


@dataclass
class Output:
    of: object


@dataclass
class For:
    name: str
    of: object
    body: list


@dataclass
class If:
    cases: list  # (condition, body), the last condition may be Const(True)


@dataclass
class Generation:
    body: list


# ------------------------------------------------------------------ parsing
class _Expression:
    def __init__(self, text: str):
        self.tokens, at = [], 0
        while text[at:].strip():
            m = _TOKEN.match(text, at)
            if not m:
                raise TemplateError(f"cannot read {text[at:]!r}")
            self.tokens.append((m.lastgroup, m[m.lastgroup]))
            at = m.end()
        self.at = 0

    def _next(self, *values: str) -> str | None:
        if self.at < len(self.tokens) and self.tokens[self.at][1] in values and self.tokens[self.at][0] != "text":
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def whole(self):
        out = self._or()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return out

    def _or(self):
        out = self._and()
        while self._next("or"):
            out = Binary("or", out, self._and())
        return out

    def _and(self):
        out = self._not()
        while self._next("and"):
            out = Binary("and", out, self._not())
        return out

    def _not(self):
        return Not(self._not()) if self._next("not") else self._compare()

    def _compare(self):
        out = self._join()
        while op := self._next("==", "!="):
            out = Binary(op, out, self._join())
        return out

    def _join(self):
        out = self._filtered()
        while self._next("~"):
            out = Binary("~", out, self._filtered())
        return out

    def _filtered(self):
        out = self._atom()
        while True:
            if self._next("."):
                out = Attribute(out, self._word())
            elif self._next("|"):
                out = Filter(out, self._word())
            else:
                return out

    def _word(self) -> str:
        if self.at < len(self.tokens) and self.tokens[self.at][0] == "name":
            self.at += 1
            return self.tokens[self.at - 1][1]
        raise TemplateError("a name is missing")

    def _atom(self):
        if self._next("("):
            out = self._or()
            if not self._next(")"):
                raise TemplateError("')' is missing")
            return out
        if self.at >= len(self.tokens):
            raise TemplateError("an expression is missing")
        kind, value = self.tokens[self.at]
        self.at += 1
        if kind == "text":
            return Const(re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[0]), value[1:-1], flags=re.S))
        if kind == "int":
            return Const(int(value))
        if kind == "name":
            return Const(value == "true") if value in ("true", "false") else Name(value)
        raise TemplateError(f"unexpected {value!r}")


def parse(source: str) -> list:
    """The syntax tree of a template."""
    parts, at = [], 0
    for m in _TAG.finditer(source):
        if m.start() > at:
            parts.append(("text", source[at:m.start()]))
        parts.append(("out", m[1]) if m[1] is not None else ("tag", m[2].strip()))
        at = m.end()
    if at < len(source):
        parts.append(("text", source[at:]))
    place = 0

    def block(*ends: str) -> tuple[list, str]:
        nonlocal place
        out: list = []
        while place < len(parts):
            kind, text = parts[place]
            place += 1
            word, _, rest = text.partition(" ")
            if kind == "text":
                out.append(Output(Const(text)))
            elif kind == "out":
                out.append(Output(_Expression(text).whole()))
            elif word in ends:
                return out, text
            elif word == "for":
                m = re.fullmatch(r"([A-Za-z_]\w*)\s+in\s+(.+)", rest.strip(), re.S)
                if not m:
                    raise TemplateError(f"cannot read {text!r}")
                out.append(For(m[1], _Expression(m[2]).whole(), block("endfor")[0]))
            elif word == "if":
                cases, condition = [], _Expression(rest).whole()
                while True:
                    body, end = block("elif", "else", "endif")
                    cases.append((condition, body))
                    if end.startswith("elif"):
                        condition = _Expression(end[4:]).whole()
                        continue
                    if end == "else":
                        cases.append((Const(True), block("endif")[0]))
                    break
                out.append(If(cases))
            elif word == "generation":
                out.append(Generation(block("endgeneration")[0]))
            else:
                raise TemplateError(f"unknown tag {text!r}")
        if ends:
            raise TemplateError(f"{ends[-1]} is missing")
        return out, ""
    return block()[0]


# ------------------------------------------------------------------ folding
def _text(value: object) -> str:
    return "" if value is None else str(value)


_BINARY: dict[str, Callable] = {"==": lambda a, b: a == b, "!=": lambda a, b: a != b,
                                "~": lambda a, b: _text(a) + _text(b),
                                "and": lambda a, b: a and b, "or": lambda a, b: a or b}


def fold(node, filters: Mapping[str, Callable[[str], str]]):
    """``node`` with constant parts computed."""
    if isinstance(node, Attribute):
        return Attribute(fold(node.of, filters), node.name)
    if isinstance(node, Filter):
        if node.name not in filters:
            raise TemplateError(f"unknown filter {node.name!r}")
        of = fold(node.of, filters)
        return Const(filters[node.name](_text(of.value))) if isinstance(of, Const) else Filter(of, node.name)
    if isinstance(node, Not):
        of = fold(node.of, filters)
        return Const(not of.value) if isinstance(of, Const) else Not(of)
    if isinstance(node, Binary):
        a, b = fold(node.left, filters), fold(node.right, filters)
        if isinstance(a, Const) and isinstance(b, Const):
            return Const(_BINARY[node.op](a.value, b.value))
        return Binary(node.op, a, b)
    return node


def fold_block(nodes: list, filters) -> list:
    """A block without constant conditions, empty text or neighbouring text."""
    out: list = []

    def add(node) -> None:
        if isinstance(node, Output) and isinstance(node.of, Const):
            text = _text(node.of.value)
            if out and isinstance(out[-1], Output) and isinstance(out[-1].of, Const):
                out[-1] = Output(Const(out[-1].of.value + text))
            elif text:
                out.append(Output(Const(text)))
        else:
            out.append(node)

    for node in nodes:
        if isinstance(node, Output):
            node = Output(fold(node.of, filters))
        elif isinstance(node, For):
            node = For(node.name, fold(node.of, filters), fold_block(node.body, filters))
        elif isinstance(node, Generation):
            node = Generation(fold_block(node.body, filters))
        elif isinstance(node, If):
            cases = []
            for condition, body in node.cases:
                condition = fold(condition, filters)
                if isinstance(condition, Const) and not condition.value:
                    continue
                cases.append((condition, fold_block(body, filters)))
                if isinstance(condition, Const):
                    break
            if not cases:
                continue
            if isinstance(cases[0][0], Const):
                for own in cases[0][1]:
                    add(own)
                continue
            node = If(cases)
        add(node)
    return out


# --------------------------------------------------------------- generation
def _value(node, filters) -> Callable[[dict], object]:
    if isinstance(node, Const):
        return lambda env, v=node.value: v
    if isinstance(node, Name):
        return lambda env, n=node.name: env.get(n)
    if isinstance(node, Attribute):
        of = _value(node.of, filters)

        def attribute(env, n=node.name):
            v = of(env)
            return v.get(n) if isinstance(v, Mapping) else None
        return attribute
    if isinstance(node, Filter):
        of, f = _value(node.of, filters), filters[node.name]
        return lambda env: f(_text(of(env)))
    if isinstance(node, Not):
        of = _value(node.of, filters)
        return lambda env: not of(env)
    a, b, op = _value(node.left, filters), _value(node.right, filters), node.op
    if op == "and":
        return lambda env: a(env) and b(env)
    if op == "or":
        return lambda env: a(env) or b(env)
    return lambda env, f=_BINARY[op]: f(a(env), b(env))


def _with_last(items: Iterable) -> Iterator[tuple[object, bool]]:
    it = iter(items)
    for now in it:
        for following in it:
            yield now, False
            now = following
        yield now, True


def _block(nodes: list, filters) -> Callable[[dict, bool], Iterator[Piece]]:
    steps = [_step(n, filters) for n in nodes]

    def run(env: dict, generated: bool) -> Iterator[Piece]:
        for step in steps:
            yield from step(env, generated)
    return run


def _step(node, filters) -> Callable[[dict, bool], Iterator[Piece]]:
    if isinstance(node, Output):
        value = _value(node.of, filters)
        return lambda env, generated: iter(((_text(value(env)), generated),))
    if isinstance(node, Generation):
        body = _block(node.body, filters)
        return lambda env, generated: body(env, True)
    if isinstance(node, If):
        cases = [(_value(c, filters), _block(b, filters)) for c, b in node.cases]

        def branch(env: dict, generated: bool) -> Iterator[Piece]:
            for condition, body in cases:
                if condition(env):
                    return body(env, generated)
            return iter(())
        return branch
    of, body, name = _value(node.of, filters), _block(node.body, filters), node.name

    def loop(env: dict, generated: bool) -> Iterator[Piece]:
        for i, (item, last) in enumerate(_with_last(of(env) or ())):
            yield from body({**env, name: item, "loop": {"first": i == 0, "last": last, "index": i + 1}}, generated)
    return loop


def _names(node) -> Iterator[str]:
    """All variables that a part of the tree reads."""
    if isinstance(node, Name):
        yield node.name
    elif isinstance(node, (list, tuple)):
        for part in node:
            yield from _names(part)
    elif is_dataclass(node):
        for f in fields(node):
            yield from _names(getattr(node, f.name))


def by_item(source: str, filters: Mapping[str, Callable[[str], str]], sequence: str) -> bool:
    """Whether the output for ``sequence`` is that of its items one after the other: the
    whole template is a loop over it that looks neither at its place nor at the sequence."""
    nodes = fold_block(parse(source), filters)
    return (len(nodes) == 1 and isinstance(nodes[0], For) and nodes[0].of == Name(sequence)
            and not {"loop", sequence} & set(_names(nodes[0].body)))


def compile_template(source: str, filters: Mapping[str, Callable[[str], str]]) -> Callable[..., Iterator[Piece]]:
    """A function of the template's variables that yields (text, generated) pieces."""
    run = _block(fold_block(parse(source), filters), filters)
    return lambda **env: run(env, False)
