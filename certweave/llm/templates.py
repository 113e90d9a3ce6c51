"""A small template language, compiled to Python closures.

Text, ``{{ expression }}``, ``{% for x in y %}``, ``{% if %}`` / ``{% elif %}`` / ``{% else %}``,
``{% set x = expression %}`` and ``{% generation %}``, whose output is what a model learns to
write. Expressions: strings, whole numbers, names, ``a.b`` (a field of a mapping, never an
attribute of a Python object), ``==``, ``!=``, ``+`` (joins texts), ``and``, ``or``, ``not``,
brackets and ``| filter`` with the filters given. Nothing else can be reached.

``parse`` gives a syntax tree, ``fold`` works out what is constant, ``compile_template`` turns the
tree into closures. A compiled template yields (text, inside generation) segments while it
reads its input, and None behind each round of an outermost loop, so a conversation of any
length passes through without being held.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass


class TemplateError(ValueError):
    """The template is not well formed, or names what is not there."""


@dataclass(frozen=True)
class Const:
    value: object


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Field:
    of: object
    name: str


@dataclass(frozen=True)
class Call:
    op: str
    args: tuple


@dataclass(frozen=True)
class Output:
    value: object


@dataclass(frozen=True)
class Block:
    items: tuple


@dataclass(frozen=True)
class If:
    test: object
    then: object
    other: object


@dataclass(frozen=True)
class For:
    name: str
    over: object
    body: object


@dataclass(frozen=True)
class Set:
    name: str
    value: object


@dataclass(frozen=True)
class Generation:
    body: object


TAG = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}", re.S)
TOKEN = re.compile(r"""\s*(?:("(?:[^"\\]|\\.)*"|'(?:[^'\\]|\\.)*')|(\d+)|([A-Za-z_]\w*)|(==|!=|[().|+]))""")
ESCAPES = {"n": "\n", "t": "\t"}


class Expression:
    """Recursive descent over the tokens of one expression."""

    def __init__(self, source: str, filters):
        self.tokens, self.filters, at = [], filters, 0
        source = source.rstrip()
        while at < len(source):
            m = TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"unexpected {source[at:]!r}")
            self.tokens.append((m.lastindex, m[m.lastindex]))
            at = m.end()

    def take(self, *texts):
        if self.tokens and self.tokens[0][0] in (3, 4) and self.tokens[0][1] in texts:
            return self.tokens.pop(0)[1]
        return None

    def whole(self):
        tree = self.either()
        if self.tokens:
            raise TemplateError(f"unexpected {self.tokens[0][1]!r}")
        return tree

    def _chain(self, op, part):
        tree = part()
        while self.take(op):
            tree = Call(op, (tree, part()))
        return tree

    def either(self):
        return self._chain("or", self.both)

    def both(self):
        return self._chain("and", self.negated)

    def negated(self):
        return Call("not", (self.negated(),)) if self.take("not") else self.compared()

    def compared(self):
        tree = self.joined()
        op = self.take("==", "!=")
        return Call(op, (tree, self.joined())) if op else tree

    def joined(self):
        return self._chain("+", self.filtered)

    def filtered(self):
        tree = self.single()
        while True:
            if self.take("|"):
                kind, name = self.tokens.pop(0) if self.tokens else (0, "")
                if kind != 3 or name not in self.filters:
                    raise TemplateError(f"no filter {name!r}")
                tree = Call(f"|{name}", (tree,))
            elif self.take("."):
                kind, name = self.tokens.pop(0) if self.tokens else (0, "")
                if kind != 3 or name.startswith("_"):
                    raise TemplateError(f"no field {name!r}")
                tree = Field(tree, name)
            else:
                return tree

    def single(self):
        if self.take("("):
            tree = self.either()
            if not self.take(")"):
                raise TemplateError("missing )")
            return tree
        if not self.tokens:
            raise TemplateError("expression missing")
        kind, text = self.tokens.pop(0)
        if kind == 1:
            return Const(re.sub(r"\\(.)", lambda m: ESCAPES.get(m[1], m[1]), text[1:-1], flags=re.S))
        if kind == 2:
            return Const(int(text))
        if kind == 3 and text not in ("and", "or", "not", "in"):
            return {"true": Const(True), "false": Const(False)}.get(text) or Name(text)
        raise TemplateError(f"unexpected {text!r}")


def parse(source: str, filters) -> Block:
    parts, at = [], 0
    for m in TAG.finditer(source):
        parts += [("text", source[at:m.start()])] if m.start() > at else []
        parts.append(("out", m[1]) if m[1] is not None else ("tag", m[2].strip()))
        at = m.end()
    parts += [("text", source[at:])] if at < len(source) else []
    expression = lambda text: Expression(text, filters).whole()

    def block(ends):
        items = []
        while parts:
            kind, text = parts.pop(0)
            word = text.split(None, 1)[0] if kind == "tag" and text else ""
            if kind == "text":
                items.append(Output(Const(text)))
            elif kind == "out":
                items.append(Output(expression(text)))
            elif word in ends:
                return Block(tuple(items)), word, text[len(word):]
            elif word == "for" and (m := re.fullmatch(r"for\s+(\w+)\s+in\s+(.+)", text, re.S)):
                body, _, _ = block(("endfor",))
                items.append(For(m[1], expression(m[2]), body))
            elif word == "if":
                items.append(branch(text[2:]))
            elif word == "set" and (m := re.fullmatch(r"set\s+(\w+)\s*=(.+)", text, re.S)):
                items.append(Set(m[1], expression(m[2])))
            elif word == "generation":
                items.append(Generation(block(("endgeneration",))[0]))
            else:
                raise TemplateError(f"unexpected tag {text!r}")
        if ends:
            raise TemplateError(f"missing {ends[-1]}")
        return Block(tuple(items)), "", ""

    def branch(test):
        then, end, rest = block(("elif", "else", "endif"))
        if end == "elif":
            return If(expression(test), then, Block((branch(rest),)))
        other = block(("endif",))[0] if end == "else" else Block(())
        return If(expression(test), then, other)

    return block(())[0]


def as_text(value) -> str:
    return "" if value is None else value if isinstance(value, str) else str(value)


OPERATORS: dict[str, Callable] = {"==": lambda a, b: a == b, "!=": lambda a, b: a != b, "+": lambda a, b: as_text(a) + as_text(b), "not": lambda a: not a}


def fold(node, filters):
    """The same tree with constant expressions worked out, dead branches gone and neighbouring texts joined."""
    if isinstance(node, Call):
        args = tuple(fold(a, filters) for a in node.args)
        if node.op in ("and", "or") and isinstance(args[0], Const):
            return args[1] if bool(args[0].value) == (node.op == "and") else args[0]
        if node.op not in ("and", "or") and all(isinstance(a, Const) for a in args):
            done = filters[node.op[1:]](as_text(args[0].value)) if node.op[0] == "|" else OPERATORS[node.op](*(a.value for a in args))
            return Const(done)
        return Call(node.op, args)
    if isinstance(node, Field):
        return Field(fold(node.of, filters), node.name)
    if isinstance(node, Output):
        value = fold(node.value, filters)
        return Output(Const(as_text(value.value))) if isinstance(value, Const) else Output(value)
    if isinstance(node, If):
        test = fold(node.test, filters)
        if isinstance(test, Const):
            return fold(node.then if test.value else node.other, filters)
        return If(test, fold(node.then, filters), fold(node.other, filters))
    if isinstance(node, For):
        return For(node.name, fold(node.over, filters), fold(node.body, filters))
    if isinstance(node, Set):
        return Set(node.name, fold(node.value, filters))
    if isinstance(node, Generation):
        return Generation(fold(node.body, filters))
    if isinstance(node, Block):
        items = []
        for item in (fold(i, filters) for i in node.items):
            for one in item.items if isinstance(item, Block) else (item,):
                constant = isinstance(one, Output) and isinstance(one.value, Const)
                if constant and not one.value.value:
                    continue
                if constant and items and isinstance(items[-1], Output) and isinstance(items[-1].value, Const):
                    items[-1] = Output(Const(items[-1].value.value + one.value.value))
                else:
                    items.append(one)
        return Block(tuple(items))
    return node


def _value(node, filters) -> Callable[[dict], object]:
    if isinstance(node, Const):
        return lambda env, v=node.value: v
    if isinstance(node, Name):
        def name(env, n=node.name):
            if n not in env:
                raise TemplateError(f"no name {n!r}")
            return env[n]
        return name
    if isinstance(node, Field):
        of, key = _value(node.of, filters), node.name

        def field(env):
            found = of(env)
            if type(found) is not dict or key not in found:
                raise TemplateError(f"no field {key!r}")
            return found[key]
        return field
    args = [_value(a, filters) for a in node.args]
    if node.op == "and":
        return lambda env: args[0](env) and args[1](env)
    if node.op == "or":
        return lambda env: args[0](env) or args[1](env)
    if node.op[0] == "|":
        run = filters[node.op[1:]]
        return lambda env: run(as_text(args[0](env)))
    run = OPERATORS[node.op]
    return lambda env: run(*[a(env) for a in args])


def _steps(node, filters, depth: int, learned: bool) -> Callable[[dict], Iterator]:
    if isinstance(node, Output):
        value = _value(node.value, filters)

        def output(env):
            text = as_text(value(env))
            if text:
                yield text, learned
        return output
    if isinstance(node, Set):
        value = _value(node.value, filters)

        def put(env, name=node.name):
            env[name] = value(env)
            return iter(())
        return put
    if isinstance(node, Generation):
        return _steps(node.body, filters, depth, True)
    if isinstance(node, If):
        test, then, other = _value(node.test, filters), _steps(node.then, filters, depth, learned), _steps(node.other, filters, depth, learned)
        return lambda env: then(env) if test(env) else other(env)
    if isinstance(node, For):
        over, body = _value(node.over, filters), _steps(node.body, filters, depth + 1, learned)

        def loop(env, name=node.name):
            items = iter(over(env))
            following, more = next(items, None), True
            index = 0
            while following is not None and more:
                item, following = following, next(items, None)
                more = following is not None
                inner = env | {name: item, "loop": {"index0": index, "first": index == 0, "last": not more}}
                yield from body(inner)
                index += 1
                if not depth:
                    yield None
        return loop
    steps = [_steps(i, filters, depth, learned) for i in node.items]

    def block(env):
        for step in steps:
            yield from step(env)
    return block


def compile_template(source: str, filters: dict[str, Callable[[str], str]]) -> Callable[[dict], Iterator]:
    """A function from the names a template may use to its segments."""
    run = _steps(fold(parse(source, filters), filters), filters, 0, False)
    return lambda names: run(dict(names))
