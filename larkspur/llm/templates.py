"""A small sandboxed template language, compiled to Python closures.

Statements: ``{{ expression }}``, ``{% for x in list %}``, ``{% if %}``,
``{% elif %}``, ``{% else %}``, ``{% set x = expression %}`` and
``{% generation %}`` ... ``{% endgeneration %}``, whose output is marked.
``-`` inside a tag's braces drops the white space of the text before or after
it, and ``{# ... #}`` is a comment.  Expressions: string and number constants, names, ``a.key`` and ``a[key]`` on
dicts and lists, ``+``, ``~``, ``==``, ``!=``, ``<``, ``>``, ``<=``, ``>=``,
``in``, ``and``, ``or``, ``not`` and ``| filter``.  There are no calls and no
attribute access on objects, so a template reaches nothing but the values and
filters it is given.

``compile_template`` parses the text to a tree, folds constants (adjacent
text, constant expressions, branches whose condition is constant) and turns
each node into a closure.  Rendering returns the text and the marked spans as
``(start, end)`` in code points.  Whatever goes wrong while a template is read
or rendered is a ``TemplateError``.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

Filters = dict[str, Callable[[Any], Any]]


class TemplateError(ValueError):
    """The template is not valid, or asks for something that is not there."""


@dataclass(frozen=True)
class Const:
    value: Any


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Item:
    of: Any
    key: Any


@dataclass(frozen=True)
class Apply:
    """An operator or filter on already parsed operands."""

    name: str
    args: tuple


@dataclass(frozen=True)
class Emit:
    what: Any


@dataclass(frozen=True)
class Loop:
    target: str
    over: Any
    body: tuple


@dataclass(frozen=True)
class Choice:
    arms: tuple  # of (condition, body)


@dataclass(frozen=True)
class Assign:
    target: str
    what: Any


@dataclass(frozen=True)
class Marked:
    body: tuple


_INSIDE = r"""(?:'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|(?!-?{end}).)*"""  # braces inside strings end no tag
_TAGS = re.compile(
    rf"(?P<comment>\{{#.*?#\}})|\{{\{{(?P<left>-?)(?P<emit>{_INSIDE.replace('{end}', r'[}][}]')})(?P<right>-?)[}}][}}]"
    rf"|\{{%(?P<before>-?)(?P<statement>{_INSIDE.replace('{end}', '%[}]')})(?P<after>-?)%[}}]", re.S
)
_TOKEN = re.compile(r"""\s*(?:(?P<text>'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(?P<number>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<sign>==|!=|<=|>=|[-+~<>|.()\[\]=]))""", re.S)
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}
_BINARY: dict[str, Callable[[Any, Any], Any]] = {
    "+": operator.add, "~": lambda a, b: f"{a}{b}", "==": operator.eq, "!=": operator.ne, "<": operator.lt, ">": operator.gt,
    "<=": operator.le, ">=": operator.ge, "in": lambda a, b: a in b,
}
_COMPARE = ("==", "!=", "<", ">", "<=", ">=", "in")


class _Expression:
    """Recursive descent over the tokens of one expression."""

    def __init__(self, source: str, filters: Filters) -> None:
        self.tokens, self.at, self.filters, end = [], 0, filters, 0
        source = source.rstrip()
        while end < len(source):
            found = _TOKEN.match(source, end)
            if not found:
                raise TemplateError(f"cannot read {source[end:]!r}")
            self.tokens.append((found.lastgroup, found.group(found.lastgroup)))
            end = found.end()

    def take(self, *values: str) -> str | None:
        if self.at < len(self.tokens) and self.tokens[self.at][0] != "text" and self.tokens[self.at][1] in values:
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def need(self, value: str) -> None:
        if not self.take(value):
            raise TemplateError(f"expected {value!r}")

    def whole(self) -> Any:
        tree = self.either()
        if self.at != len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return tree

    def either(self) -> Any:
        tree = self.both()
        while self.take("or"):
            tree = Apply("or", (tree, self.both()))
        return tree

    def both(self) -> Any:
        tree = self.negated()
        while self.take("and"):
            tree = Apply("and", (tree, self.negated()))
        return tree

    def negated(self) -> Any:
        return Apply("not", (self.negated(),)) if self.take("not") else self.compared()

    def compared(self) -> Any:
        tree = self.joined()
        while sign := self.take(*_COMPARE):
            tree = Apply(sign, (tree, self.joined()))
        return tree

    def joined(self) -> Any:
        tree = self.filtered()
        while sign := self.take("+", "~"):
            tree = Apply(sign, (tree, self.filtered()))
        return tree

    def filtered(self) -> Any:
        tree = self.primary()
        while self.take("|"):
            kind, name = self.tokens[self.at] if self.at < len(self.tokens) else ("", "")
            if kind != "name" or name not in self.filters:
                raise TemplateError(f"no filter {name!r}")
            self.at += 1
            tree = Apply(f"|{name}", (tree,))
        return tree

    def primary(self) -> Any:
        if self.take("("):
            tree = self.either()
            self.need(")")
        elif self.at < len(self.tokens):
            kind, value = self.tokens[self.at]
            self.at += 1
            if kind == "text":
                tree = Const(re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), value[1:-1], flags=re.S))
            elif kind == "number":
                tree = Const(int(value))
            elif kind == "name":
                tree = Const({"true": True, "false": False, "none": None}[value]) if value in ("true", "false", "none") else Name(value)
            else:
                raise TemplateError(f"unexpected {value!r}")
        else:
            raise TemplateError("an expression ends too early")
        while sign := self.take(".", "["):
            if sign == "[":
                tree = Item(tree, self.either())
                self.need("]")
            else:
                kind, value = self.tokens[self.at] if self.at < len(self.tokens) else ("", "")
                if kind != "name":
                    raise TemplateError("a name must follow '.'")
                self.at += 1
                tree = Item(tree, Const(value))
        return tree


def _parts(source: str) -> list[tuple[str, str]]:
    """Texts, expressions and statements in order, with the white space that ``-`` takes away gone."""
    out: list[tuple[str, str]] = []
    end, trim = 0, False

    def text(piece: str, trim_end: bool) -> None:
        piece = piece.lstrip() if trim else piece
        piece = piece.rstrip() if trim_end else piece
        if piece:
            if "{{" in piece or "{%" in piece:
                raise TemplateError(f"a tag is not closed in {piece!r}")
            out.append(("text", piece))

    for tag in _TAGS.finditer(source):
        text(source[end : tag.start()], bool(tag["left"] or tag["before"]))
        end, trim = tag.end(), bool(tag["right"] or tag["after"])
        if tag["emit"] is not None:
            out.append(("emit", tag["emit"]))
        elif tag["statement"] is not None:
            out.append(("statement", tag["statement"].strip()))
    text(source[end:], False)
    return out


def parse(source: str, filters: Filters) -> tuple:
    """The template's statements as a tree."""
    parts = _parts(source)

    def block(at: int, ends: tuple[str, ...]) -> tuple[tuple, int, str]:
        out: list[Any] = []
        while at < len(parts):
            kind, part = parts[at]
            at += 1
            if kind == "emit":
                out.append(Emit(_Expression(part, filters).whole()))
            elif kind == "statement":
                word, _, rest = part.partition(" ")
                if word in ends:
                    return tuple(out), at, part
                if word == "for":
                    found = re.fullmatch(r"([A-Za-z_]\w*)\s+in\s+(.+)", rest.strip(), re.S)
                    if not found:
                        raise TemplateError(f"cannot read {part!r}")
                    body, at, _ = block(at, ("endfor",))
                    out.append(Loop(found[1], _Expression(found[2], filters).whole(), body))
                elif word == "if":
                    arms, condition = [], _Expression(rest, filters).whole()
                    while True:
                        body, at, end = block(at, ("elif", "else", "endif"))
                        arms.append((condition, body))
                        if end == "endif":
                            break
                        condition = Const(True) if end == "else" else _Expression(end.partition(" ")[2], filters).whole()
                    out.append(Choice(tuple(arms)))
                elif word == "set":
                    target, _, value = rest.partition("=")
                    if not target.strip().isidentifier():
                        raise TemplateError(f"cannot read {part!r}")
                    out.append(Assign(target.strip(), _Expression(value, filters).whole()))
                elif word == "generation":
                    body, at, _ = block(at, ("endgeneration",))
                    out.append(Marked(body))
                else:
                    raise TemplateError(f"unexpected {part!r}")
            else:
                out.append(Emit(Const(part)))
        if ends:
            raise TemplateError(f"{ends[-1]} is missing")
        return tuple(out), at, ""

    return block(0, ())[0]


def _run(name: str, filters: Filters) -> Callable[..., Any]:
    return filters[name[1:]] if name[0] == "|" else operator.not_ if name == "not" else _BINARY[name]


def fold_expression(tree: Any, filters: Filters) -> Any:
    if isinstance(tree, Item):
        return Item(fold_expression(tree.of, filters), fold_expression(tree.key, filters))
    if not isinstance(tree, Apply):
        return tree
    args = tuple(fold_expression(a, filters) for a in tree.args)
    if tree.name in ("and", "or") and isinstance(args[0], Const):
        return args[1] if bool(args[0].value) == (tree.name == "and") else args[0]
    if tree.name not in ("and", "or") and all(isinstance(a, Const) for a in args):
        try:
            return Const(_run(tree.name, filters)(*(a.value for a in args)))
        except Exception as fault:
            raise TemplateError(f"{tree.name} fails on {[a.value for a in args]}: {fault}") from fault
    if tree.name in ("+", "~") and isinstance(args[1], Const) and isinstance(args[0], Apply) and args[0].name == tree.name and isinstance(args[0].args[1], Const):
        inner = args[0].args  # (x + 'a') + 'b' is x + 'ab' when both are texts
        if isinstance(args[1].value, str) and isinstance(inner[1].value, str):
            return Apply(tree.name, (inner[0], Const(inner[1].value + args[1].value)))
    return Apply(tree.name, args)


def fold(body: tuple, filters: Filters) -> tuple:
    """The same statements with constants evaluated, dead branches gone and neighbouring texts joined."""
    out: list[Any] = []

    def add(node: Any) -> None:
        if not (isinstance(node, Emit) and isinstance(node.what, Const)):
            out.append(node)
            return
        text = "" if node.what.value is None else str(node.what.value)
        if out and isinstance(out[-1], Emit) and isinstance(out[-1].what, Const):
            text = out.pop().what.value + text
        if text:
            out.append(Emit(Const(text)))

    for node in body:
        if isinstance(node, Emit):
            add(Emit(fold_expression(node.what, filters)))
        elif isinstance(node, Loop):
            out.append(Loop(node.target, fold_expression(node.over, filters), fold(node.body, filters)))
        elif isinstance(node, Choice):
            arms = []
            for condition, inner in node.arms:
                condition = fold_expression(condition, filters)
                if isinstance(condition, Const) and not condition.value:
                    continue
                arms.append((condition, fold(inner, filters)))
                if isinstance(condition, Const):
                    break
            if arms and isinstance(arms[0][0], Const):
                for inner in arms[0][1]:
                    add(inner)
            elif arms:
                out.append(Choice(tuple(arms)))
        elif isinstance(node, Assign):
            out.append(Assign(node.target, fold_expression(node.what, filters)))
        else:
            out.append(Marked(fold(node.body, filters)))
    return tuple(out)


class _Output:
    """Text written so far, its length, and the marked spans."""

    def __init__(self) -> None:
        self.parts: list[str] = []
        self.length = 0
        self.spans: list[tuple[int, int]] = []


def _item(of: Any, key: Any) -> Any:
    if isinstance(of, dict):
        return of.get(key)
    if isinstance(of, (list, str)) and isinstance(key, int) and not isinstance(key, bool):
        return of[key] if key < len(of) else None
    raise TemplateError(f"no {key!r} in a {type(of).__name__}")


def _expression(tree: Any, filters: Filters) -> Callable[[dict], Any]:
    if isinstance(tree, Const):
        return lambda scope, value=tree.value: value
    if isinstance(tree, Name):
        return lambda scope, name=tree.name: scope.get(name)
    if isinstance(tree, Item):
        of, key = _expression(tree.of, filters), _expression(tree.key, filters)
        return lambda scope: _item(of(scope), key(scope))
    args = [_expression(a, filters) for a in tree.args]
    if tree.name == "and":
        return lambda scope: args[0](scope) and args[1](scope)
    if tree.name == "or":
        return lambda scope: args[0](scope) or args[1](scope)
    run = _run(tree.name, filters)
    if len(args) == 1:
        return lambda scope: run(args[0](scope))
    return lambda scope: run(args[0](scope), args[1](scope))


def _statement(node: Any, filters: Filters) -> Callable[[dict, _Output], None]:
    if isinstance(node, Emit):
        value = _expression(node.what, filters)

        def emit(scope: dict, out: _Output) -> None:
            what = value(scope)
            if what is not None:
                out.parts.append(text := str(what))
                out.length += len(text)

        return emit
    if isinstance(node, Loop):
        over, body, target = _expression(node.over, filters), _body(node.body, filters), node.target

        def loop(scope: dict, out: _Output) -> None:
            items = over(scope) or []
            for i, item in enumerate(items):
                body({**scope, target: item, "loop": {"index0": i, "index": i + 1, "first": i == 0, "last": i == len(items) - 1}}, out)

        return loop
    if isinstance(node, Choice):
        arms = [(_expression(condition, filters), _body(body, filters)) for condition, body in node.arms]

        def choose(scope: dict, out: _Output) -> None:
            for condition, body in arms:
                if condition(scope):
                    return body(scope, out)

        return choose
    if isinstance(node, Assign):
        value, target = _expression(node.what, filters), node.target
        return lambda scope, out: scope.__setitem__(target, value(scope))
    body = _body(node.body, filters)

    def marked(scope: dict, out: _Output) -> None:
        start = out.length
        body(scope, out)
        out.spans.append((start, out.length))

    return marked


def _body(nodes: tuple, filters: Filters) -> Callable[[dict, _Output], None]:
    steps = [_statement(n, filters) for n in nodes]

    def run(scope: dict, out: _Output) -> None:
        for step in steps:
            step(scope, out)

    return run


def compile_template(source: str, filters: Filters) -> Callable[..., tuple[str, list[tuple[int, int]]]]:
    """``render(**values) -> (text, marked spans)``."""
    program = _body(fold(parse(source, filters), filters), filters)

    def render(**values: Any) -> tuple[str, list[tuple[int, int]]]:
        out = _Output()
        try:
            program(dict(values), out)
        except TemplateError:
            raise
        except Exception as fault:
            raise TemplateError(f"rendering fails: {type(fault).__name__}: {fault}") from fault
        return "".join(out.parts), out.spans

    return render
