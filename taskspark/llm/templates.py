"""Chat templates: a small sandboxed template language, compiled to Python closures.

Tags: ``{{ expression }}``, ``{% for x in list %}``, ``{% if %} {% elif %} {% else %}``, ``{% set x = expression %}``,
``{% generation %}`` around what a model is to learn, ``{# comment #}``. Expressions: literals, names,
``a.b`` and ``a["b"]`` on mappings only, comparison, ``in``, ``and or not``, ``+ ~``, filters from FILTERS and
``loop.index index0 first last``. Nothing else can be reached: no attributes, no calls. A missing name is the
empty text. Constant parts are folded when the template is compiled.

A compiled template yields (text, learnt) pieces as it goes and looks one element ahead at most, so a
conversation of any length renders in the memory of one turn.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from typing import Any

Piece = tuple[str, bool]
Scope = dict[str, Any]
TAG = re.compile(r"\{\{-?(.*?)-?\}\}|\{%-?(.*?)-?%\}|\{#.*?#\}", re.DOTALL)
WORD = re.compile(
    r"\s*(?:(?P<text>\"(?:[^\"\\]|\\.)*\"|'(?:[^'\\]|\\.)*')|(?P<number>\d+)|(?P<name>[A-Za-z_]\w*)"
    r"|(?P<mark>==|!=|<=|>=|[<>+~.|()\[\]]))"
)
ESCAPES = {"n": "\n", "t": "\t"}
FILTERS: dict[str, Callable[[Any], Any]] = {
    "trim": lambda x: str(x).strip(),
    "upper": lambda x: str(x).upper(),
    "lower": lambda x: str(x).lower(),
    "length": lambda x: len(x) if isinstance(x, str | list | tuple | dict) else 0,
    "string": str,
}
COMPARE: dict[str, Callable[[Any, Any], bool]] = {
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "<": lambda a, b: a < b,
    ">": lambda a, b: a > b,
    "<=": lambda a, b: a <= b,
    ">=": lambda a, b: a >= b,
    "in": lambda a, b: a in b,
}


class TemplateError(ValueError):
    """The template is not in the language."""


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
    """A pure function of expressions; with constants only it is folded."""

    run: Callable
    parts: tuple


@dataclass(frozen=True)
class Choice:
    """``and`` / ``or``: decided by the left side."""

    stop_on: bool
    left: Any
    right: Any


@dataclass(frozen=True)
class Out:
    value: Any


@dataclass(frozen=True)
class Loop:
    name: str
    over: Any
    body: tuple


@dataclass(frozen=True)
class If:
    test: Any
    yes: tuple
    no: tuple


@dataclass(frozen=True)
class Set:
    name: str
    value: Any


@dataclass(frozen=True)
class Learnt:
    body: tuple


class _Expression:
    """Reads one expression by descent, weakest operator first."""

    def __init__(self, source: str, filters: dict[str, Callable]) -> None:
        self.words, self.filters, at = [], filters, 0
        source = source.rstrip()
        while at < len(source):
            word = WORD.match(source, at)
            if not word:
                raise TemplateError(f"unexpected {source[at:]!r}")
            self.words.append((word.lastgroup, word[word.lastgroup]))
            at = word.end()

    def peek(self) -> str | None:
        return self.words[0][1] if self.words and self.words[0][0] != "text" else None

    def take(self, *expected: str) -> str:
        if not self.words or (expected and self.peek() not in expected):
            raise TemplateError(f"expected {expected or 'a value'}, found {self.words[:1]}")
        return self.words.pop(0)[1]

    def whole(self) -> Any:
        value = self.either()
        if self.words:
            raise TemplateError(f"unexpected {self.words[0][1]!r}")
        return value

    def either(self) -> Any:
        left = self.both()
        while self.peek() == "or":
            self.take()
            left = Choice(True, left, self.both())
        return left

    def both(self) -> Any:
        left = self.negated()
        while self.peek() == "and":
            self.take()
            left = Choice(False, left, self.negated())
        return left

    def negated(self) -> Any:
        if self.peek() == "not":
            self.take()
            return Apply(lambda x: not x, (self.negated(),))
        left = self.sum()
        if self.peek() in COMPARE:
            return Apply(COMPARE[self.take()], (left, self.sum()))
        return left

    def sum(self) -> Any:
        left = self.filtered()
        while self.peek() in ("+", "~"):
            joins = self.take() == "~"
            run = (lambda a, b: f"{a}{b}") if joins else (lambda a, b: a + b)
            left = Apply(run, (left, self.filtered()))
        return left

    def filtered(self) -> Any:
        value = self.value()
        while self.peek() in (".", "[", "|"):
            mark = self.take()
            if mark == ".":
                value = Item(value, Const(self.take()))
            elif mark == "[":
                value = Item(value, self.either())
                self.take("]")
            else:
                name = self.take()
                if name not in self.filters:
                    raise TemplateError(f"no filter {name!r}")
                value = Apply(self.filters[name], (value,))
        return value

    def value(self) -> Any:
        if self.peek() == "(":
            self.take()
            inner = self.either()
            self.take(")")
            return inner
        kind = self.words[0][0] if self.words else None
        word = self.take()
        if kind == "text":
            return Const(re.sub(r"\\(.)", lambda m: ESCAPES.get(m[1], m[1]), word[1:-1]))
        if kind == "number":
            return Const(int(word))
        if kind == "name" and word in ("true", "false", "none"):
            return Const({"true": True, "false": False, "none": None}[word])
        if kind == "name":
            return Name(word)
        raise TemplateError(f"unexpected {word!r}")


def parse(source: str, filters: dict[str, Callable] | None = None) -> tuple:
    """The syntax tree of a template."""
    filters = FILTERS | (filters or {})
    read = lambda text: _Expression(text, filters).whole()
    tags: list[tuple[str, str]] = []
    at = 0
    for tag in TAG.finditer(source):
        if tag.start() > at:
            tags.append(("text", source[at : tag.start()]))
        if tag[1] is not None:
            tags.append(("out", tag[1]))
        elif tag[2] is not None:
            tags.append(("tag", tag[2].strip()))
        at = tag.end()
    if at < len(source):
        tags.append(("text", source[at:]))
    if re.search(r"\{[{%#]", "".join(text for kind, text in tags if kind == "text")):
        raise TemplateError("a tag is not closed")

    def block(*ends: str) -> tuple[tuple, str]:
        nodes: list = []
        while tags:
            kind, text = tags.pop(0)
            word, _, rest = text.partition(" ") if kind == "tag" else ("", "", "")
            if kind == "text":
                nodes.append(Out(Const(text)))
            elif kind == "out":
                nodes.append(Out(read(text)))
            elif word in ends:
                return tuple(nodes), text
            elif word == "for" and (m := re.fullmatch(r"(\w+)\s+in\s+(.+)", rest.strip(), re.DOTALL)):
                nodes.append(Loop(m[1], read(m[2]), block("endfor")[0]))
            elif word == "if":
                nodes.append(branch(rest))
            elif word == "set" and (m := re.fullmatch(r"(\w+)\s*=\s*(.+)", rest.strip(), re.DOTALL)):
                nodes.append(Set(m[1], read(m[2])))
            elif word == "generation":
                nodes.append(Learnt(block("endgeneration")[0]))
            else:
                raise TemplateError(f"unexpected tag {text!r}")
        if ends:
            raise TemplateError(f"missing {ends[0]}")
        return tuple(nodes), ""

    def branch(test: str) -> If:
        yes, end = block("elif", "else", "endif")
        if end.startswith("elif"):
            return If(read(test), yes, (branch(end[4:]),))
        return If(read(test), yes, block("endif")[0] if end == "else" else ())

    return block()[0]


def fold(node: Any) -> Any:
    """The same tree with constant expressions evaluated, decided branches chosen and neighbouring texts joined."""
    if isinstance(node, tuple):
        nodes: list = []
        for part in map(fold, node):
            flat = part if isinstance(part, tuple) else (part,)
            for one in flat:
                last = nodes[-1] if nodes else None
                if isinstance(one, Out) and isinstance(one.value, Const):
                    one = Out(Const(shown(one.value.value)))
                    if isinstance(last, Out) and isinstance(last.value, Const):
                        nodes[-1] = Out(Const(last.value.value + one.value.value))
                        continue
                nodes.append(one)
        return tuple(nodes)
    if isinstance(node, Apply):
        parts = tuple(map(fold, node.parts))
        if all(isinstance(p, Const) for p in parts):
            return Const(node.run(*(p.value for p in parts)))
        return Apply(node.run, parts)
    if isinstance(node, Choice):
        left, right = fold(node.left), fold(node.right)
        if isinstance(left, Const):
            return left if bool(left.value) == node.stop_on else right
        return Choice(node.stop_on, left, right)
    if isinstance(node, Item):
        return Item(fold(node.of), fold(node.key))
    if isinstance(node, Out):
        return Out(fold(node.value))
    if isinstance(node, Loop):
        return Loop(node.name, fold(node.over), fold(node.body))
    if isinstance(node, Set):
        return Set(node.name, fold(node.value))
    if isinstance(node, Learnt):
        return Learnt(fold(node.body))
    if isinstance(node, If):
        test = fold(node.test)
        if isinstance(test, Const):
            return fold(node.yes if test.value else node.no)
        return If(test, fold(node.yes), fold(node.no))
    return node


def shown(value: Any) -> str:
    return "" if value is None else str(value)


def _value(node: Any) -> Callable[[Scope], Any]:
    """A closure that evaluates an expression."""
    if isinstance(node, Const):
        return lambda scope: node.value
    if isinstance(node, Name):
        return lambda scope: scope.get(node.name, "")
    if isinstance(node, Item):
        of, key = _value(node.of), _value(node.key)

        def item(scope: Scope) -> Any:
            holder = of(scope)
            return holder.get(key(scope), "") if isinstance(holder, dict) else ""

        return item
    if isinstance(node, Choice):
        left, right = _value(node.left), _value(node.right)
        return lambda scope: v if bool(v := left(scope)) == node.stop_on else right(scope)
    parts = [_value(p) for p in node.parts]
    if len(parts) == 1:
        only = parts[0]
        return lambda scope: node.run(only(scope))
    first, second = parts
    return lambda scope: node.run(first(scope), second(scope))


def _loop(values: Iterable) -> Iterator[tuple[dict, Any]]:
    """Each element with its loop variables, looking one ahead."""
    rest = iter(values)
    ahead, index = next(rest, rest), 0
    while ahead is not rest:
        now, ahead = ahead, next(rest, rest)
        yield {"index": index + 1, "index0": index, "first": index == 0, "last": ahead is rest}, now
        index += 1


def _nodes(tree: tuple) -> Callable[[Scope, bool], Iterator[Piece]]:
    """A closure that renders a sequence of nodes."""
    parts = [_node(n) for n in tree]

    def render(scope: Scope, learnt: bool) -> Iterator[Piece]:
        for part in parts:
            yield from part(scope, learnt)

    return render


def _node(node: Any) -> Callable[[Scope, bool], Iterator[Piece]]:
    if isinstance(node, Out):
        value = _value(node.value)

        def out(scope: Scope, learnt: bool) -> Iterator[Piece]:
            yield shown(value(scope)), learnt

        return out
    if isinstance(node, Loop):
        over, body = _value(node.over), _nodes(node.body)

        def loop(scope: Scope, learnt: bool) -> Iterator[Piece]:
            for state, one in _loop(over(scope)):
                yield from body({**scope, node.name: one, "loop": state}, learnt)

        return loop
    if isinstance(node, If):
        test, yes, no = _value(node.test), _nodes(node.yes), _nodes(node.no)
        return lambda scope, learnt: yes(scope, learnt) if test(scope) else no(scope, learnt)
    if isinstance(node, Set):
        value = _value(node.value)

        def assign(scope: Scope, learnt: bool) -> Iterator[Piece]:
            scope[node.name] = value(scope)
            return iter(())

        return assign
    body = _nodes(node.body)
    return lambda scope, learnt: body(scope, True)


def compiled(source: str, filters: dict[str, Callable] | None = None) -> Callable[[Scope], Iterator[Piece]]:
    """A function from variables to rendered pieces."""
    render = _nodes(fold(parse(source, filters)))
    return lambda variables: render(dict(variables), False)
