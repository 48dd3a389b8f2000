"""A small sandboxed chat template language, compiled to Python closures.

    {{ expression }}                       output
    {% for name in expression %} ... {% endfor %}    with loop.index, index0, first, last
    {% if expression %} ... {% elif expression %} ... {% else %} ... {% endif %}
    {% set name = expression %}
    {% generation %} ... {% endgeneration %}         marks output that the loss sees
    {# comment #}

Expressions: strings, numbers, true, false, none, names, attributes and items
of dictionaries, lists, ``+ - * / // % ~``, comparisons, ``in``, ``and or not``,
``a if b else c``, and filters ``| name`` from a fixed table. There are no
calls, no imports and no attributes of Python objects, so a template sees only
what it is given.

Compilation: text to tokens, tokens to a syntax tree, constant folding (constant
expressions are computed, constant branches chosen, neighbouring constant output joined),
then one closure per node. A rendered template is a stream of (text, in_generation)
pieces, made as the loops go, so loops may run over any iterator and nothing
is held whole.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field


class TemplateError(ValueError):
    pass


# --- syntax tree -------------------------------------------------------------

@dataclass
class Const:
    value: object


@dataclass
class Name:
    name: str


@dataclass
class Item:
    of: object
    key: object


@dataclass
class Apply:
    """An operator or filter on expressions."""
    name: str
    args: list


@dataclass
class Choose:
    test: object
    then: object
    other: object


@dataclass
class Output:
    value: object


@dataclass
class Loop:
    name: str
    over: object
    body: list


@dataclass
class Branch:
    test: object
    then: list
    other: list = field(default_factory=list)


@dataclass
class Assign:
    name: str
    value: object


@dataclass
class Generation:
    body: list


def _text(x) -> str:
    return "" if x is None else x if isinstance(x, str) else str(x)


def _and(a, b):
    return a and b


def _or(a, b):
    return a or b


OPERATORS: dict[str, Callable] = {
    "+": operator.add, "-": operator.sub, "*": operator.mul, "/": operator.truediv, "//": operator.floordiv,
    "%": operator.mod, "~": lambda a, b: _text(a) + _text(b), "==": operator.eq, "!=": operator.ne,
    "<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge, "in": lambda a, b: a in b,
    "not": operator.not_, "neg": operator.neg, "and": _and, "or": _or, "list": lambda *items: list(items),
}
FILTERS: dict[str, Callable] = {
    "trim": lambda x: _text(x).strip(), "upper": lambda x: _text(x).upper(), "lower": lambda x: _text(x).lower(),
    "length": len, "string": _text, "title": lambda x: _text(x).title(),
}
_LEVELS = [("or",), ("and",), ("==", "!=", "<", "<=", ">", ">=", "in"), ("+", "-", "~"), ("*", "/", "//", "%")]
_MARKS = re.compile(r"(\{\{.*?\}\}|\{%.*?%\}|\{#.*?#\})", re.S)
_TOKENS = re.compile(r"""\s*(?:(\d+\.\d+|\d+)|('(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|([A-Za-z_]\w*)|(==|!=|<=|>=|//|[-+*/%~<>|().,\[\]=]))""")
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}
_WORDS = {"true": True, "false": False, "none": None, "True": True, "False": False, "None": None}


class _Expression:
    """Recursive descent over the tokens of one expression."""

    def __init__(self, source: str):
        self.tokens, at = [], 0
        source = source.strip()
        while at < len(source):
            m = _TOKENS.match(source, at)
            if not m or m.end() == at:
                raise TemplateError(f"cannot read {source[at:at + 20]!r}")
            number, string, word, mark = m.groups()
            if number:
                self.tokens.append(("const", float(number) if "." in number else int(number)))
            elif string:
                self.tokens.append(("const", re.sub(r"\\(.)", lambda e: _ESCAPES.get(e[1], e[1]), string[1:-1], flags=re.S)))
            else:
                self.tokens.append(("word", word) if word else ("mark", mark))
            at = m.end()
        self.at = 0

    def peek(self):
        return self.tokens[self.at] if self.at < len(self.tokens) else ("end", None)

    def accept(self, *values) -> str | None:
        kind, value = self.peek()
        if kind in ("word", "mark") and value in values:
            self.at += 1
            return value
        return None

    def expect(self, value: str) -> None:
        if not self.accept(value):
            raise TemplateError(f"expected {value!r}, found {self.peek()[1]!r}")

    def name(self) -> str:
        kind, value = self.peek()
        if kind != "word":
            raise TemplateError(f"expected a name, found {value!r}")
        self.at += 1
        return value

    def whole(self):
        out = self.choice()
        if self.peek()[0] != "end":
            raise TemplateError(f"unexpected {self.peek()[1]!r}")
        return out

    def choice(self):
        value = self.level(0)
        if self.accept("if"):
            test = self.level(0)
            other = self.choice() if self.accept("else") else Const("")
            return Choose(test, value, other)
        return value

    def level(self, depth: int):
        if depth == len(_LEVELS):
            return self.unary()
        if depth == 2 and self.accept("not"):
            return Apply("not", [self.level(2)])
        left = self.level(depth + 1)
        while True:
            op = self.accept(*_LEVELS[depth])
            if not op and depth == 2 and self.peek() == ("word", "not") and self.tokens[self.at + 1:self.at + 2] == [("word", "in")]:
                self.at += 2
                left = Apply("not", [Apply("in", [left, self.level(depth + 1)])])
                continue
            if not op:
                return left
            left = Apply(op, [left, self.level(depth + 1)])

    def unary(self):
        if self.accept("-"):
            return Apply("neg", [self.unary()])
        value = self.atom()
        while True:
            if self.accept("."):
                value = Item(value, Const(self.name()))
            elif self.accept("["):
                value = Item(value, self.choice())
                self.expect("]")
            elif self.accept("|"):
                name = self.name()
                if name not in FILTERS:
                    raise TemplateError(f"unknown filter {name!r}")
                value = Apply("|" + name, [value])
            else:
                return value

    def atom(self):
        kind, value = self.peek()
        if kind == "const":
            self.at += 1
            return Const(value)
        if self.accept("("):
            inner = self.choice()
            self.expect(")")
            return inner
        if self.accept("["):
            items = []
            while not self.accept("]"):
                items.append(self.choice())
                if not self.accept(","):
                    self.expect("]")
                    break
            return Apply("list", items)
        name = self.name()
        return Const(_WORDS[name]) if name in _WORDS else Name(name)


def parse(source: str) -> list:
    """The syntax tree of a template. Marks with a dash ({%- -%}) drop the white space beside them."""
    parts = _MARKS.split(source)
    for i in range(1, len(parts), 2):
        if parts[i][2:3] == "-":
            parts[i - 1] = parts[i - 1].rstrip()
            parts[i] = parts[i][:2] + parts[i][3:]
        if parts[i][-3:-2] == "-":
            parts[i + 1] = parts[i + 1].lstrip()
            parts[i] = parts[i][:-3] + parts[i][-2:]
    root: list = []
    open_: list[tuple[str, object, list]] = [("", None, root)]

    def into() -> list:
        return open_[-1][2]

    def close(*kinds):
        if open_[-1][0] not in kinds:
            raise TemplateError(f"nothing to close for one of {kinds}")
        return open_.pop()

    for i, part in enumerate(parts):
        if i % 2 == 0:
            if part:
                into().append(Output(Const(part)))
            continue
        body = part[2:-2].strip()
        if part.startswith("{#"):
            continue
        if part.startswith("{{"):
            into().append(Output(_Expression(body).whole()))
            continue
        word, _, rest = body.partition(" ")
        if word == "for":
            e = _Expression(rest)
            name = e.name()
            e.expect("in")
            node = Loop(name, e.whole(), [])
            into().append(node)
            open_.append(("for", node, node.body))
        elif word in ("if", "elif"):
            node = Branch(_Expression(rest).whole(), [])
            if word == "elif":
                _, last, _ = close("if", "elif")
                last.other = [node]
            else:
                into().append(node)
            open_.append((word, node, node.then))
        elif word == "else":
            _, node, _ = close("if", "elif")
            open_.append(("else", node, node.other))
        elif word == "set":
            name, _, value = rest.partition("=")
            if not re.fullmatch(r"\s*[A-Za-z_]\w*\s*", name):
                raise TemplateError(f"cannot set {name!r}")
            into().append(Assign(name.strip(), _Expression(value).whole()))
        elif word == "generation":
            node = Generation([])
            into().append(node)
            open_.append(("generation", node, node.body))
        elif word in ("endfor", "endgeneration"):
            close(word[3:])
        elif word == "endif":
            close("if", "elif", "else")
        else:
            raise TemplateError(f"unknown tag {word!r}")
    if len(open_) > 1:
        raise TemplateError(f"{open_[-1][0]!r} is not closed")
    return root


# --- constant folding --------------------------------------------------------

def fold(node):
    """The same tree with constant parts computed."""
    if isinstance(node, list):
        out: list = []
        for part in map(fold, node):
            for x in part if isinstance(part, list) else [part]:
                if isinstance(x, Output) and isinstance(x.value, Const):
                    text = _text(x.value.value)
                    if out and isinstance(out[-1], Output) and isinstance(out[-1].value, Const):
                        out[-1] = Output(Const(out[-1].value.value + text))
                    elif text:
                        out.append(Output(Const(text)))
                else:
                    out.append(x)
        return out
    if isinstance(node, Apply):
        args = [fold(a) for a in node.args]
        if all(isinstance(a, Const) for a in args):
            try:
                return Const(_function(node.name)(*[a.value for a in args]))
            except Exception:  # left to fail when and if it is rendered
                return Apply(node.name, args)
        return Apply(node.name, args)
    if isinstance(node, Choose):
        test = fold(node.test)
        if isinstance(test, Const):
            return fold(node.then if test.value else node.other)
        return Choose(test, fold(node.then), fold(node.other))
    if isinstance(node, Item):
        return Item(fold(node.of), fold(node.key))
    if isinstance(node, Output):
        return Output(fold(node.value))
    if isinstance(node, Assign):
        return Assign(node.name, fold(node.value))
    if isinstance(node, Generation):
        return Generation(fold(node.body))
    if isinstance(node, Loop):
        return Loop(node.name, fold(node.over), fold(node.body))
    if isinstance(node, Branch):
        test = fold(node.test)
        if isinstance(test, Const):
            return fold(node.then if test.value else node.other)
        return Branch(test, fold(node.then), fold(node.other))
    return node


# --- closures ----------------------------------------------------------------

def _function(name: str) -> Callable:
    return FILTERS[name[1:]] if name.startswith("|") else OPERATORS[name]


def _item(of, key):
    if isinstance(of, dict):
        return of.get(key)
    if isinstance(of, (list, tuple, str)) and isinstance(key, int):
        return of[key] if -len(of) <= key < len(of) else None
    return None


def _value(node) -> Callable:
    """A closure from the variables to the value of an expression."""
    if isinstance(node, Const):
        value = node.value
        return lambda scope: value
    if isinstance(node, Name):
        name = node.name
        return lambda scope: scope.get(name)
    if isinstance(node, Item):
        of, key = _value(node.of), _value(node.key)
        return lambda scope: _item(of(scope), key(scope))
    if isinstance(node, Choose):
        test, then, other = _value(node.test), _value(node.then), _value(node.other)
        return lambda scope: then(scope) if test(scope) else other(scope)
    args = [_value(a) for a in node.args]
    if node.name in ("and", "or"):
        left, right, stop = args[0], args[1], node.name == "or"
        return lambda scope: value if bool(value := left(scope)) == stop else right(scope)
    function = _function(node.name)
    if len(args) == 1:
        one = args[0]
        return lambda scope: function(one(scope))
    if len(args) == 2:
        first, second = args
        return lambda scope: function(first(scope), second(scope))
    return lambda scope: function(*[a(scope) for a in args])


def _run(nodes: list) -> Callable:
    """A closure from (variables, in_generation) to a stream of pieces."""
    steps = [_step(n) for n in nodes]

    def run(scope, marked):
        for step in steps:
            yield from step(scope, marked)

    return run


def _step(node) -> Callable:
    if isinstance(node, Output):
        if isinstance(node.value, Const):
            text = _text(node.value.value)
            return lambda scope, marked: ((text, marked),)
        value = _value(node.value)
        return lambda scope, marked: ((_text(value(scope)), marked),)
    if isinstance(node, Assign):
        value, name = _value(node.value), node.name

        def assign(scope, marked):
            scope[name] = value(scope)
            return ()

        return assign
    if isinstance(node, Generation):
        body = _run(node.body)
        return lambda scope, marked: body(scope, True)
    if isinstance(node, Branch):
        test, then, other = _value(node.test), _run(node.then), _run(node.other)
        return lambda scope, marked: then(scope, marked) if test(scope) else other(scope, marked)

    over, body, name = _value(node.over), _run(node.body), node.name

    def loop(scope, marked):
        items = iter(over(scope) or ())
        ahead = next(items, _END)
        index = 0
        while ahead is not _END:
            item, ahead = ahead, next(items, _END)
            inner = dict(scope)
            inner[name] = item
            inner["loop"] = {"index": index + 1, "index0": index, "first": index == 0, "last": ahead is _END}
            yield from body(inner, marked)
            index += 1

    return loop


_END = object()


def compile_template(source: str) -> Callable[[dict], Iterator[tuple[str, bool]]]:
    """A function from variables to a stream of (text, in_generation)."""
    run = _run(fold(parse(source)))
    return lambda variables: run(dict(variables), False)
