"""A small template language for conversations: parsed to a tree, folded, and compiled to closures.

    {# a comment #}
    {% for turn in turns %} ... {% endfor %}                 once, around all that uses a turn
    {% if e %} ... {% elif e %} ... {% else %} ... {% endif %}
    {% generation %} ... {% endgeneration %}                 what a model learns to write
    {{ e }}                                                  writes a value

Expressions: 'text', "text", whole numbers, true, false, the names in NAMES, ==, !=, in, not, and, or, ~
(joins texts), | with the filters given, and parentheses. There is nothing else: no calls, no attributes,
no access to Python. Whatever is unknown is refused when the template is compiled, with its place.

Constant expressions, branches and neighbouring texts are folded before closures are made, so that a turn
costs only what depends on it.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from typing import NamedTuple

#: Fixed values of the language: what an expression can name.
NAMES = ("turn.role", "turn.text", "loop.first", "loop.last", "loop.index")
_TAG = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}|\{#.*?#\}", re.S)
_TOKEN = re.compile(r"""\s*(?:(?P<text>'[^']*'|"[^"]*")|(?P<number>\d+)|(?P<name>[A-Za-z_]+(?:\.[A-Za-z_]+)?)|(?P<sign>==|!=|[~|()]))""")


class TemplateError(ValueError):
    pass


class Turn(NamedTuple):
    """What a closure sees of one turn; in the order of NAMES."""

    role: str
    text: str
    first: bool
    last: bool
    index: int


@dataclass(frozen=True)
class Const:
    value: object


@dataclass(frozen=True)
class Name:
    at: int


@dataclass(frozen=True)
class Apply:
    """A filter, an operator or `not` over its arguments."""

    what: str
    args: tuple


@dataclass(frozen=True)
class Write:
    value: object


@dataclass(frozen=True)
class If:
    test: object
    then: tuple
    other: tuple


@dataclass(frozen=True)
class Loop:
    body: tuple


@dataclass(frozen=True)
class Generation:
    body: tuple


OPERATORS: dict[str, Callable] = {
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "in": lambda a, b: str(a) in str(b),
    "~": lambda a, b: f"{a}{b}",
    "not": lambda a: not a,
    "and": lambda a, b: a and b,
    "or": lambda a, b: a or b,
}
FILTERS: dict[str, Callable] = {"trim": lambda v: str(v).strip(), "upper": lambda v: str(v).upper(), "lower": lambda v: str(v).lower()}


class _Expression:
    """Reads one expression by descent; each level binds tighter than the one before."""

    def __init__(self, source: str, at: int, filters: Mapping[str, Callable]):
        self.tokens, self.filters, self.source, self.k = [], filters, source, 0
        place = 0
        while source[place:].strip():
            m = _TOKEN.match(source, place)
            if not m:
                raise TemplateError(f"at {at}: {source[place:].strip()!r} is no expression")
            self.tokens.append((m.lastgroup, m.group(m.lastgroup)))
            place = m.end()

    def fail(self) -> TemplateError:
        rest = self.tokens[self.k][1] if self.k < len(self.tokens) else "its end"
        return TemplateError(f"{rest!r} is not expected in {self.source.strip()!r}")

    def take(self, *values: str) -> str | None:
        if self.k < len(self.tokens) and self.tokens[self.k][0] != "text" and self.tokens[self.k][1] in values:
            self.k += 1
            return self.tokens[self.k - 1][1]
        return None

    def whole(self):
        out = self.joined_by(("or",), lambda: self.joined_by(("and",), self.negated))
        if self.k < len(self.tokens):
            raise self.fail()
        return out

    def joined_by(self, signs: tuple[str, ...], part: Callable):
        out = part()
        while sign := self.take(*signs):
            out = Apply(sign, (out, part()))
        return out

    def negated(self):
        return Apply("not", (self.negated(),)) if self.take("not") else self.joined_by(("==", "!=", "in"), lambda: self.joined_by(("~",), self.filtered))

    def filtered(self):
        out = self.single()
        while self.take("|"):
            kind, name = self.tokens[self.k] if self.k < len(self.tokens) else ("", "")
            if kind != "name" or name not in self.filters:
                raise TemplateError(f"there is no filter {name!r}")
            self.k += 1
            out = Apply(f"|{name}", (out,))
        return out

    def single(self):
        if self.take("("):
            out = self.joined_by(("or",), lambda: self.joined_by(("and",), self.negated))
            if not self.take(")"):
                raise self.fail()
            return out
        if self.k >= len(self.tokens):
            raise self.fail()
        kind, value = self.tokens[self.k]
        self.k += 1
        if kind == "text":
            return Const(value[1:-1])
        if kind == "number":
            return Const(int(value))
        if value in ("true", "false"):
            return Const(value == "true")
        if kind == "name" and value in NAMES:
            return Name(NAMES.index(value))
        if kind == "name":
            raise TemplateError(f"there is no name {value!r}")
        self.k -= 1
        raise self.fail()


def parse(source: str, filters: Mapping[str, Callable] = FILTERS) -> tuple:
    """The tree of a template."""
    # Open blocks, innermost last: (tag, test, bodies so far).
    stack: list[tuple[str, object, list]] = [("", None, [[]])]

    def expression(text: str, at: int):
        return _Expression(text, at, filters).whole()

    def close(tag: str, at: int) -> tuple[object, list]:
        opened, test, bodies = stack.pop()
        if opened != tag or not stack:
            raise TemplateError(f"at {at}: nothing is open that end{tag} could close" if not stack else f"at {at}: end{tag} closes {opened}")
        return test, bodies

    def put(node) -> None:
        stack[-1][2][-1].append(node)

    place = 0
    for m in _TAG.finditer(source):
        put(Write(Const(source[place : m.start()])))
        place, at = m.end(), m.start()
        if m[1] is not None:
            put(Write(expression(m[1], at)))
        elif m[2] is not None:
            word, _, rest = m[2].strip().partition(" ")
            if word == "if":
                stack.append(("if", [expression(rest, at)], [[]]))
            elif word in ("elif", "else"):
                tag, tests, bodies = stack[-1]
                if tag != "if" or len(bodies) > len(tests):
                    raise TemplateError(f"at {at}: {word} has no if")
                if word == "elif":
                    tests.append(expression(rest, at))
                elif rest:
                    raise TemplateError(f"at {at}: else takes nothing")
                bodies.append([])
            elif word == "for":
                if rest.split() != ["turn", "in", "turns"] or len(stack) > 1:
                    raise TemplateError(f"at {at}: the one loop is 'for turn in turns', outside of other blocks")
                stack.append(("for", None, [[]]))
            elif word == "generation" and not rest:
                stack.append(("generation", None, [[]]))
            elif word in ("endif", "endfor", "endgeneration") and not rest:
                test, bodies = close(word[3:], at)
                if word == "endif":
                    node: tuple = tuple(bodies.pop()) if len(bodies) > len(test) else ()
                    for t, body in zip(test[::-1], bodies[::-1]):
                        node = (If(t, tuple(body), node),)
                    put(node[0])
                else:
                    put((Loop if word == "endfor" else Generation)(tuple(bodies[0])))
            else:
                raise TemplateError(f"at {at}: there is no {m[2].strip()!r}")
    put(Write(Const(source[place:])))
    if len(stack) > 1:
        raise TemplateError(f"{stack[-1][0]} is never closed")
    return tuple(stack[0][2][0])


def fold(node, filters: Mapping[str, Callable] = FILTERS):
    """The node (or body, a tuple of nodes) with all that is constant worked out."""
    again = lambda x: fold(x, filters)
    if isinstance(node, tuple):
        out: list = []
        for part in map(again, node):
            for x in part if isinstance(part, tuple) else (part,):
                if isinstance(x, Write) and isinstance(x.value, Const) and out and isinstance(out[-1], Write) and isinstance(out[-1].value, Const):
                    out[-1] = Write(Const(f"{out[-1].value.value}{x.value.value}"))
                elif x != Write(Const("")):
                    out.append(x)
        return tuple(out)
    if isinstance(node, Write):
        value = again(node.value)
        return Write(Const(f"{value.value}") if isinstance(value, Const) else value)
    if isinstance(node, If):
        test = again(node.test)
        return again(node.then if test.value else node.other) if isinstance(test, Const) else If(test, again(node.then), again(node.other))
    if isinstance(node, (Loop, Generation)):
        return type(node)(again(node.body))
    if isinstance(node, Apply):
        args = tuple(map(again, node.args))
        if node.what in ("and", "or") and isinstance(args[0], Const):
            return args[1] if bool(args[0].value) == (node.what == "and") else args[0]
        if all(isinstance(a, Const) for a in args):
            return Const(_function(node.what, filters)(*(a.value for a in args)))
        return Apply(node.what, args)
    return node


def _function(what: str, filters: Mapping[str, Callable]) -> Callable:
    return filters[what[1:]] if what[0] == "|" else OPERATORS[what]


def _value(node, filters: Mapping[str, Callable]) -> Callable[[Turn], object]:
    if isinstance(node, Const):
        return lambda turn, value=node.value: value
    if isinstance(node, Name):
        return lambda turn, at=node.at: turn[at]
    args = [_value(a, filters) for a in node.args]
    if node.what == "and":
        return lambda turn: args[0](turn) and args[1](turn)
    if node.what == "or":
        return lambda turn: args[0](turn) or args[1](turn)
    f = _function(node.what, filters)
    if len(args) == 1:
        return lambda turn, a=args[0]: f(a(turn))
    return lambda turn, a=args[0], b=args[1]: f(a(turn), b(turn))


Emit = Callable[[str, bool], None]


def _closure(body: tuple, filters: Mapping[str, Callable], learned: bool = False) -> Callable[[Turn, Emit], None]:
    """What writes the body: emit gets each text, and whether a model learns it."""
    steps: list[Callable[[Turn, Emit], None]] = []
    for node in body:
        if isinstance(node, Write) and isinstance(node.value, Const):
            steps.append(lambda turn, emit, text=node.value.value: emit(text, learned))
        elif isinstance(node, Write):
            steps.append(lambda turn, emit, value=_value(node.value, filters): emit(f"{value(turn)}", learned))
        elif isinstance(node, If):
            test, then, other = _value(node.test, filters), _closure(node.then, filters, learned), _closure(node.other, filters, learned)
            steps.append(lambda turn, emit, test=test, then=then, other=other: (then if test(turn) else other)(turn, emit))
        elif isinstance(node, Generation):
            steps.append(_closure(node.body, filters, True))
        else:
            raise TemplateError("a loop stands outside of other blocks")
    if len(steps) == 1:
        return steps[0]

    def run(turn: Turn, emit: Emit) -> None:
        for step in steps:
            step(turn, emit)

    return run


def _uses_turn(node) -> bool:
    if isinstance(node, tuple):
        return any(map(_uses_turn, node))
    return isinstance(node, Name) or any(_uses_turn(x) for x in vars(node).values() if isinstance(x, (tuple, Apply, Name, Const, Write, If, Loop, Generation)))


class Template:
    """A compiled template: what stands before the turns, what writes a turn, and what stands after them."""

    def __init__(self, source: str, filters: Mapping[str, Callable] = FILTERS):
        self.tree = fold(parse(source, filters), filters)
        loops = [k for k, node in enumerate(self.tree) if isinstance(node, Loop)]
        if len(loops) != 1:
            raise TemplateError("a template has one loop over the turns")
        at = loops[0]
        if _uses_turn(self.tree[:at]) or _uses_turn(self.tree[at + 1 :]):
            raise TemplateError("a turn is known only inside the loop")
        self._before, self._turn, self._after = (_closure(b, filters) for b in (self.tree[:at], self.tree[at].body, self.tree[at + 1 :]))

    def write(self, turn: Turn, emit: Emit) -> None:
        """One turn, with what stands before the first and after the last one."""
        if turn.first:
            self._before(turn, emit)
        self._turn(turn, emit)
        if turn.last:
            self._after(turn, emit)

    def render(self, turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
        """A whole conversation of (role, text) as one text, and the spans of it that a model learns."""
        sheet = Sheet()
        for k, (role, text) in enumerate(turns):
            self.write(Turn(role, text, k == 0, k == len(turns) - 1, k), sheet.emit)
        return sheet.text(), sheet.spans


class Sheet:
    """Gathers what a template writes: the text, its length and the learned spans, neighbouring ones joined within a block."""

    def __init__(self) -> None:
        self.parts: list[str] = []
        self.size = 0
        self.spans: list[tuple[int, int]] = []
        self._open = False

    def emit(self, text: str, learned: bool) -> None:
        if not text:
            return
        self.parts.append(text)
        end = self.size + len(text)
        if learned and self._open:
            self.spans[-1] = (self.spans[-1][0], end)
        elif learned:
            self.spans.append((self.size, end))
        self._open, self.size = learned, end

    def text(self) -> str:
        return "".join(self.parts)
