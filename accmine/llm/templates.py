"""A small sandboxed template language, compiled to Python closures.

``{{ expr }}`` writes a value; ``{% for x in e %}``, ``{% if e %} {% elif e %} {% else %}``,
``{% set x = e %}`` and ``{% generation %}`` (text to learn from) are blocks closed by ``end…``; ``{# #}`` is a
comment; a dash inside a tag (``{%-``, ``-%}``) drops the white space beside it. Expressions have literals, names,
``a.b`` / ``a['b']`` (keys of mappings and positions of lists only: no Python attribute is ever reached), ``+ - *
~ == != < <= > >= in not and or``, ``x if c else y`` and ``value | filter(args)`` from a given set. There are no
calls, so a template can do nothing but read its variables; texts are not multiplied, and values that grow beyond
``MAX_TEXT`` characters or ``MAX_NUMBER`` are refused, so it bounds memory, too.

Compilation: source -> tags -> syntax tree (nested tuples) -> constants folded -> closures. A rendered
template is a stream of pieces made on demand, so ``for`` may run over a stream of any length.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping
from functools import partial

_IN_TAG = r"""((?:'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|[^'"])*?)"""      # a tag does not end inside a string
TAG = re.compile(r"\{\{(-?)" + _IN_TAG + r"(-?)\}\}|\{%(-?)" + _IN_TAG + r"(-?)%\}|\{#(-?).*?(-?)#\}", re.S)
MAX_TEXT = 1 << 26        # characters of a value, and
MAX_NUMBER = 1 << 63      # size of a number, that an expression may make
TOKEN = re.compile(r"""\s*(?:(?P<num>\d+(?:\.\d+)?)|(?P<str>'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(?P<name>[A-Za-z_]\w*)"""
                   r"""|(?P<op>==|!=|<=|>=|[-+*~<>|.,()\[\]]))""", re.S)
ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}
WORDS = {"and", "or", "not", "in", "if", "else", "true", "false", "none"}
CONSTANTS = {"true": True, "false": False, "none": None}


class TemplateError(ValueError):
    pass


# --------------------------------------------------------------------- parsing ---

class _Expr:
    """Recursive descent, loosest binding first."""

    LEVELS = [("or",), ("and",)]
    COMPARE = {"==", "!=", "<", "<=", ">", ">=", "in"}

    def __init__(self, source: str):
        self.toks, i = [], 0
        while source[i:].strip():
            m = TOKEN.match(source, i)
            if not m:
                raise TemplateError(f"unexpected {source[i:].strip()[:10]!r}")
            self.toks.append((m.lastgroup, m[m.lastgroup]))
            i = m.end()
        self.i = 0

    def peek(self):
        return self.toks[self.i] if self.i < len(self.toks) else (None, None)

    def take(self, *values):
        if self.peek()[1] in values and self.peek()[0] != "str":
            self.i += 1
            return self.toks[self.i - 1][1]
        return None

    def need(self, value):
        if not self.take(value):
            raise TemplateError(f"expected {value!r}, found {self.peek()[1]!r}")

    def whole(self):
        e = self.ternary()
        if self.i < len(self.toks):
            raise TemplateError(f"unexpected {self.peek()[1]!r}")
        return e

    def ternary(self):
        e = self.logic(0)
        if self.take("if"):
            c = self.logic(0)
            return ("pick", c, e, self.ternary() if self.take("else") else ("lit", ""))
        return e

    def logic(self, level):
        if level == len(self.LEVELS):
            return ("not", self.logic(level)) if self.take("not") else self.compare()
        e = self.logic(level + 1)
        while op := self.take(*self.LEVELS[level]):
            e = (op, e, self.logic(level + 1))
        return e

    def compare(self):
        e = self.sum()
        while True:
            if op := self.take(*self.COMPARE):
                e = ("bin", op, e, self.sum())
            elif self.peek()[1] == "not" and self.toks[self.i + 1:self.i + 2] == [("name", "in")]:
                self.i += 2
                e = ("not", ("bin", "in", e, self.sum()))
            else:
                return e

    def sum(self):
        e = self.product()
        while op := self.take("+", "-", "~"):
            e = ("bin", op, e, self.product())
        return e

    def product(self):
        e = self.unary()
        while self.take("*"):
            e = ("bin", "*", e, self.unary())
        return e

    def unary(self):
        return ("neg", self.unary()) if self.take("-") else self.filtered()

    def filtered(self):
        e = self.primary()
        while True:
            if self.take("."):
                kind, key = self.peek()
                if kind != "name":
                    raise TemplateError("a name must follow '.'")
                self.i += 1
                e = ("get", e, ("lit", key))
            elif self.take("["):
                e = ("get", e, self.ternary())
                self.need("]")
            elif self.take("|"):
                name, args = self.peek()[1], []
                self.i += 1
                if self.take("("):
                    while not self.take(")"):
                        args.append(self.ternary())
                        self.take(",")
                        if self.i >= len(self.toks):
                            raise TemplateError("unclosed '('")
                e = ("filter", name, e, tuple(args))
            else:
                return e

    def primary(self):
        kind, v = self.peek()
        self.i += 1
        if kind == "num":
            return ("lit", float(v) if "." in v else int(v))
        if kind == "str":
            return ("lit", re.sub(r"\\(.)", lambda m: ESCAPES.get(m[1], m[1]), v[1:-1], flags=re.S))
        if kind == "name" and v in CONSTANTS:
            return ("lit", CONSTANTS[v])
        if kind == "name" and v not in WORDS:
            return ("name", v)
        if v == "(":
            e = self.ternary()
            self.need(")")
            return e
        raise TemplateError(f"unexpected {v!r}")


def parse(source: str) -> tuple:
    """Syntax tree: a tuple of statements."""
    parts, i, trim = [], 0, False
    for m in TAG.finditer(source):
        text = source[i:m.start()]
        text = text.lstrip() if trim else text
        out_l, out, out_r, tag_l, tag, tag_r, com_l, com_r = m.groups()
        text = text.rstrip() if out_l or tag_l or com_l else text
        trim = bool(out_r or tag_r or com_r)
        if text:
            parts.append(("text", text))
        if out is not None:
            parts.append(("out", out))
        elif tag is not None:
            parts.append(("tag", tag.strip()))
        i = m.end()
    rest = source[i:].lstrip() if trim else source[i:]
    if rest:
        parts.append(("text", rest))
    if any(kind == "text" and re.search(r"\{[{%#]", v) for kind, v in parts):
        raise TemplateError("a tag is not closed")
    body, at, end = _body(parts, 0, ())
    return body


def _body(parts, i, ends):
    out = []
    while i < len(parts):
        kind, v = parts[i]
        i += 1
        if kind == "text":
            out.append(("text", v))
        elif kind == "out":
            out.append(("out", _Expr(v).whole()))
        else:
            word, _, rest = v.partition(" ")
            if word in ends:
                return tuple(out), i, v
            if word == "for":
                m = re.fullmatch(r"([A-Za-z_]\w*)\s+in\s+(.*)", rest.strip(), re.S)
                if not m:
                    raise TemplateError(f"bad loop: {v!r}")
                body, i, _ = _body(parts, i, ("endfor",))
                out.append(("for", m[1], _Expr(m[2]).whole(), body))
            elif word == "if":
                arms, test, other = [], rest, ()
                while True:
                    body, i, end = _body(parts, i, ("elif", "else", "endif"))
                    if test is None:
                        other = body
                    else:
                        arms.append((_Expr(test).whole(), body))
                    if end == "endif":
                        break
                    test = end[4:] if end.startswith("elif") else None
                out.append(("if", tuple(arms), other))
            elif word == "set":
                name, eq, value = rest.partition("=")
                if not eq or not name.strip().isidentifier():
                    raise TemplateError(f"bad set: {v!r}")
                out.append(("set", name.strip(), _Expr(value).whole()))
            elif word == "generation":
                body, i, _ = _body(parts, i, ("endgeneration",))
                out.append(("generation", body))
            else:
                raise TemplateError(f"unknown tag {v!r}")
    if ends:
        raise TemplateError(f"missing {ends[-1]!r}")
    return tuple(out), i, None


# --------------------------------------------------------------- constant folding ---

def fold(node, filters: Mapping[str, Callable] = {}):
    """The same tree with constant expressions evaluated, settled conditions replaced by their branch and
    neighbouring text joined."""
    if isinstance(node, tuple) and node and isinstance(node[0], str):
        return _fold_expr(node, filters)
    out = []
    for st in node:
        kind = st[0]
        if kind == "out":
            e = _fold_expr(st[1], filters)
            new = [("text", show(e[1]))] if e[0] == "lit" else [("out", e)]
        elif kind == "for":
            new = [("for", st[1], _fold_expr(st[2], filters), fold(st[3], filters))]
        elif kind == "set":
            new = [("set", st[1], _fold_expr(st[2], filters))]
        elif kind == "generation":
            body = fold(st[1], filters)
            new = [("generation", body)] if body else []
        elif kind == "if":
            arms, other, new = [], fold(st[2], filters), None
            for test, body in st[1]:
                test = _fold_expr(test, filters)
                if test[0] == "lit" and not test[1]:
                    continue
                if test[0] == "lit":
                    other = fold(body, filters)
                    break
                arms.append((test, fold(body, filters)))
            new = [("if", tuple(arms), other)] if arms else list(other)
        else:
            new = [st]
        for s in new:
            if s[0] == "text" and out and out[-1][0] == "text":
                out[-1] = ("text", out[-1][1] + s[1])
            elif s != ("text", ""):
                out.append(s)
    return tuple(out)


def _fold_expr(e, filters):
    kind = e[0]
    if kind in ("lit", "name"):
        return e
    if kind == "bin":
        e = ("bin", e[1], _fold_expr(e[2], filters), _fold_expr(e[3], filters))
        parts = e[2:]
    elif kind == "filter":
        e = ("filter", e[1], _fold_expr(e[2], filters), tuple(_fold_expr(a, filters) for a in e[3]))
        parts = (e[2], *e[3])
    else:
        e = (kind, *[_fold_expr(a, filters) for a in e[1:]])
        parts = e[1:]
        if kind == "pick" and parts[0][0] == "lit":
            return parts[1] if parts[0][1] else parts[2]
        if kind in ("and", "or") and parts[0][0] == "lit":
            return parts[1] if bool(parts[0][1]) == (kind == "and") else parts[0]
    if all(p[0] == "lit" for p in parts):
        return ("lit", _expr(e, filters)({}))
    return e


# -------------------------------------------------------------------- closures ---

def show(v) -> str:
    return "" if v is None else v if isinstance(v, str) else str(v)


def _get(obj, key):
    if isinstance(obj, Mapping):
        return obj.get(key)
    if isinstance(obj, (list, tuple, str)) and isinstance(key, int) and -len(obj) <= key < len(obj):
        return obj[key]
    return None


def _bounded(v):
    if isinstance(v, str) and len(v) > MAX_TEXT or isinstance(v, (int, float)) and not -MAX_NUMBER <= v <= MAX_NUMBER:
        raise TemplateError("a value grows too large")
    return v


def _times(a, b):
    if isinstance(a, (int, float)) and isinstance(b, (int, float)):
        return _bounded(a * b)
    raise TemplateError("only numbers are multiplied")


OPS: dict[str, Callable] = {
    "+": lambda a, b: _bounded(a + b), "-": lambda a, b: _bounded(a - b), "*": _times, "~": lambda a, b: _bounded(show(a) + show(b)),
    "==": lambda a, b: a == b, "!=": lambda a, b: a != b, "<": lambda a, b: a < b, "<=": lambda a, b: a <= b,
    ">": lambda a, b: a > b, ">=": lambda a, b: a >= b, "in": lambda a, b: a in b}


def _expr(e, filters) -> Callable:
    kind = e[0]
    sub = partial(_expr, filters=filters)
    if kind == "lit":
        return lambda s, v=e[1]: v
    if kind == "name":
        return lambda s, n=e[1]: s.get(n)
    if kind == "get":
        return lambda s, a=sub(e[1]), b=sub(e[2]): _get(a(s), b(s))
    if kind == "bin":
        return lambda s, f=OPS[e[1]], a=sub(e[2]), b=sub(e[3]): f(a(s), b(s))
    if kind == "neg":
        return lambda s, a=sub(e[1]): -a(s)
    if kind == "not":
        return lambda s, a=sub(e[1]): not a(s)
    if kind == "and":
        return lambda s, a=sub(e[1]), b=sub(e[2]): a(s) and b(s)
    if kind == "or":
        return lambda s, a=sub(e[1]), b=sub(e[2]): a(s) or b(s)
    if kind == "pick":
        return lambda s, c=sub(e[1]), a=sub(e[2]), b=sub(e[3]): a(s) if c(s) else b(s)
    if e[1] not in filters:
        raise TemplateError(f"unknown filter {e[1]!r}")
    return lambda s, f=filters[e[1]], a=sub(e[2]), r=tuple(map(sub, e[3])): f(a(s), *[x(s) for x in r])


def _with_last(items: Iterable):
    """(item, is it the last one) with one item read ahead."""
    it = iter(items)
    try:
        held = next(it)
    except StopIteration:
        return
    for x in it:
        yield held, False
        held = x
    yield held, True


def _block(body, filters) -> Callable:
    steps = [_statement(st, filters) for st in body]

    def run(scope):
        for step in steps:
            yield from step(scope)

    return steps[0] if len(steps) == 1 else run


def _statement(st, filters) -> Callable:
    """A closure from variables to a stream of pieces: text, or True / False around generation blocks."""
    kind = st[0]
    if kind == "text":
        return lambda scope, one=(st[1],): one
    if kind == "out":
        return lambda scope, f=_expr(st[1], filters): (show(f(scope)),)
    if kind == "set":
        def assign(scope, n=st[1], f=_expr(st[2], filters)):
            scope[n] = f(scope)
            return ()

        return assign
    if kind == "generation":
        def generation(scope, inner=_block(st[1], filters)):
            yield True
            yield from inner(scope)
            yield False

        return generation
    if kind == "for":
        def loop(scope, items=_expr(st[2], filters), inner=_block(st[3], filters), var=st[1]):
            own = dict(scope)
            for n, (x, last) in enumerate(_with_last(items(scope) or ())):
                own[var] = x
                own["loop"] = {"index0": n, "index": n + 1, "first": n == 0, "last": last}
                yield from inner(own)

        return loop
    arms, other = [(_expr(t, filters), _block(b, filters)) for t, b in st[1]], _block(st[2], filters)

    def choose(scope):
        for test, inner in arms:
            if test(scope):
                return inner(scope)
        return other(scope)

    return choose


def compile_template(source: str, filters: Mapping[str, Callable]) -> Callable:
    """``render(variables)``: the output as a stream of pieces, texts and True / False where a generation
    block begins / ends. Nothing is rendered before it is asked for."""
    body = _block(fold(parse(source), filters), filters)
    return lambda variables: body(dict(variables))
