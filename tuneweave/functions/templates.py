"""Chat-template text compiled to column expressions.

The Jinja subset that chat templates use becomes one Spark expression over a column of
messages: text, `{{ }}`, `set`, `if`/`elif`/`else`, `for` with an optional condition and `loop.first`,
`last`, `index`, `index0`, `length`; attributes, items and slices; literals and dicts of literals; `+`, `~`, `%`,
comparisons, `in`, `and`/`or`/`not`, the conditional expression, `is defined`/`none`; the filters and methods of
`FUNCTIONS`; `raise_exception`. Anything else, such as `namespace` or macros, raises `TemplateError` when
compiled. A null or missing value prints as nothing and is false.

With `trim_blocks` and `lstrip_blocks` (as tokenizers compile their templates) the line feed after a block
and the blanks before one on its line are dropped.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import capitalize, strip

FIELDS = ("role", "content")
# Distinct templates of a table become branches of one expression.
MOST_TEMPLATES = 200


class TemplateError(ValueError):
    pass


@dataclass
class Value:
    """An expression: its kind (text, number, bool, list, message, dict, loop, undefined) and column or parts."""

    kind: str
    column: Column | None = None
    parts: dict = field(default_factory=dict)


UNDEFINED = Value("undefined")


def text_of(v: Value) -> Column:
    if v.kind == "undefined":
        return F.lit("")
    if v.kind == "text":
        return F.coalesce(v.column, F.lit(""))
    if v.kind == "number":
        return F.coalesce(v.column.cast("string"), F.lit(""))
    if v.kind == "bool":
        return F.when(v.column, "True").otherwise("False")
    raise TemplateError(f"a {v.kind} cannot be printed")


def truth(v: Value) -> Column:
    if v.kind == "undefined":
        return F.lit(False)
    if v.kind == "text":
        return F.coalesce(v.column != "", F.lit(False))
    if v.kind == "number":
        return F.coalesce(v.column != 0, F.lit(False))
    if v.kind == "bool":
        return F.coalesce(v.column, F.lit(False))
    if v.kind == "list":
        return F.coalesce(F.size(v.column) > 0, F.lit(False))
    if v.kind == "dict":
        return F.lit(bool(v.parts))
    return v.column.isNotNull()


def choose(condition: Column, yes: Value, no: Value) -> Value:
    if yes is no:
        return yes
    kinds = {yes.kind, no.kind} - {"undefined"}
    if not kinds:
        return yes
    if len(kinds) > 1 or kinds & {"dict", "loop"}:
        raise TemplateError(f"one name stands for {' or '.join(sorted(kinds))}")
    pick = F.when(condition, yes.column) if yes.kind != "undefined" else F.when(~condition, no.column)
    if "undefined" not in (yes.kind, no.kind):
        pick = pick.otherwise(no.column)
    return Value(kinds.pop(), pick)


def _text(c: Column) -> Value:
    return Value("text", c)


# Filters, also callable as methods, of one text.
FUNCTIONS: dict[str, Callable[[Column], Value]] = {
    "trim": lambda c: _text(strip(c)),
    "strip": lambda c: _text(strip(c)),
    "upper": lambda c: _text(F.upper(c)),
    "lower": lambda c: _text(F.lower(c)),
    "capitalize": lambda c: _text(capitalize(c)),
    "length": lambda c: Value("number", F.length(c)),
    "string": lambda c: _text(c),
}

_token = re.compile(
    r"""\s*(?:(?P<text>'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(?P<number>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<sign>==|!=|<=|>=|[-+~%<>()\[\]{}.,:|=]))""",
    re.S,
)
_escape = re.compile(r"\\(.)", re.S)
_escapes = {"n": "\n", "t": "\t", "r": "\r"}
_part = re.compile(r"\{\{(-?)(.*?)(-?)\}\}|\{%([-+]?)(.*?)(-?)%\}|\{#(-?)(.*?)(-?)#\}", re.S)


def tokens_of(code: str) -> list[tuple[str, str]]:
    found, at, code = [], 0, code.strip()
    while at < len(code):
        m = _token.match(code, at)
        if not m:
            raise TemplateError(f"cannot read {code[at:at + 20]!r}")
        kind, value = m.lastgroup, m.group(m.lastgroup)
        if kind == "text":
            value = _escape.sub(lambda e: _escapes.get(e.group(1), e.group(1)), value[1:-1])
        found.append((kind, value))
        at = m.end()
    return found


class Expression:
    """Recursive descent over the tokens of one expression or statement."""

    def __init__(self, code: str, names: dict[str, Value]):
        self.tokens, self.at, self.names = tokens_of(code), 0, names

    def peek(self, *values: str) -> bool:
        return self.at < len(self.tokens) and self.tokens[self.at][0] != "text" and self.tokens[self.at][1] in values

    def take(self, *values: str) -> str | None:
        if self.peek(*values):
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def need(self, value: str) -> None:
        if not self.take(value):
            raise TemplateError(f"{value!r} is missing")

    def name(self) -> str:
        if self.at < len(self.tokens) and self.tokens[self.at][0] == "name":
            self.at += 1
            return self.tokens[self.at - 1][1]
        raise TemplateError("a name is missing")

    def end(self) -> None:
        if self.at < len(self.tokens):
            raise TemplateError(f"unsupported: {self.tokens[self.at][1]!r}")

    def whole(self) -> Value:
        v = self.conditional()
        self.end()
        return v

    def conditional(self) -> Value:
        yes = self.either()
        if not self.take("if"):
            return yes
        condition = truth(self.either())
        return choose(condition, yes, self.conditional() if self.take("else") else UNDEFINED)

    def either(self) -> Value:
        v = self.both()
        while self.take("or"):
            v = self._short(v, self.both(), keep_true=True)
        return v

    def both(self) -> Value:
        v = self.negated()
        while self.take("and"):
            v = self._short(v, self.negated(), keep_true=False)
        return v

    @staticmethod
    def _short(a: Value, b: Value, keep_true: bool) -> Value:
        if a.kind == b.kind and a.kind in ("text", "number", "list"):
            return choose(truth(a), a, b) if keep_true else choose(truth(a), b, a)
        return Value("bool", truth(a) | truth(b) if keep_true else truth(a) & truth(b))

    def negated(self) -> Value:
        if self.take("not"):
            return Value("bool", ~truth(self.negated()))
        return self.compared()

    def compared(self) -> Value:
        v = self.joined()
        while True:
            if sign := self.take("==", "!=", "<", ">", "<=", ">="):
                v = Value("bool", self._compare(sign, v, self.joined()))
            elif self.peek("in") or self.peek("not"):
                negate = bool(self.take("not"))
                self.need("in")
                held = self._holds(v, self.joined())
                v = Value("bool", ~held if negate else held)
            elif self.take("is"):
                negate = bool(self.take("not"))
                test = self.name()
                if test not in ("defined", "none", "undefined"):
                    raise TemplateError(f"unsupported test {test!r}")
                missing = F.lit(v.kind == "undefined") if v.column is None else v.column.isNull()
                v = Value("bool", missing if (test == "defined") == negate else ~missing)
            else:
                return v

    @staticmethod
    def _compare(sign: str, a: Value, b: Value) -> Column:
        if "undefined" in (a.kind, b.kind) or a.kind != b.kind:
            same = F.lit(a.kind == b.kind)
        elif a.kind not in ("text", "number", "bool"):
            raise TemplateError(f"a {a.kind} cannot be compared")
        elif sign in ("==", "!="):
            same = a.column.eqNullSafe(b.column)
        else:
            found = {"<": a.column < b.column, ">": a.column > b.column, "<=": a.column <= b.column, ">=": a.column >= b.column}
            return F.coalesce(found[sign], F.lit(False))
        return ~same if sign == "!=" else same

    def _holds(self, a: Value, b: Value) -> Column:
        if b.kind == "text" and a.kind == "text":
            return F.coalesce(b.column.contains(a.column), F.lit(False))
        if b.kind == "dict":
            return reduce(lambda x, y: x | y, [self._compare("==", a, k) for k in b.parts.get("keys", [])], F.lit(False))
        raise TemplateError(f"unsupported: a {a.kind} in a {b.kind}")

    def joined(self) -> Value:
        v = self.remainder()
        while sign := self.take("+", "~", "-"):
            w = self.remainder()
            if sign == "~" or sign == "+" and "text" in (v.kind, w.kind):
                v = _text(F.concat(text_of(v), text_of(w)))
            elif v.kind == w.kind == "number":
                v = Value("number", v.column + w.column if sign == "+" else v.column - w.column)
            else:
                raise TemplateError(f"unsupported: {v.kind} {sign} {w.kind}")
        return v

    def remainder(self) -> Value:
        v = self.filtered()
        while self.take("%"):
            w = self.filtered()
            if not v.kind == w.kind == "number":
                raise TemplateError(f"unsupported: {v.kind} % {w.kind}")
            v = Value("number", v.column % w.column)
        return v

    def filtered(self) -> Value:
        v = self.item()
        while self.take("|"):
            v = self._call(v, self.name(), self._arguments() if self.peek("(") else [])
        return v

    def _arguments(self) -> list[Value]:
        self.need("(")
        found: list[Value] = []
        while not self.take(")"):
            found.append(self.conditional())
            if not self.peek(")"):
                self.need(",")
        return found

    def _call(self, v: Value, name: str, given: list[Value]) -> Value:
        if name == "default" and len(given) == 1:
            return choose(F.lit(True), given[0], UNDEFINED) if v.kind == "undefined" else choose(v.column.isNotNull(), v, given[0])
        if name == "get" and v.kind == "dict" and given:
            v_default = given[1] if len(given) > 1 else UNDEFINED
            for key, value in zip(reversed(v.parts["keys"]), reversed(v.parts["values"])):
                v_default = choose(self._compare("==", given[0], key), value, v_default)
            return v_default
        if name in ("startswith", "endswith") and v.kind == "text" and len(given) == 1:
            return Value("bool", F.coalesce(getattr(v.column, name)(given[0].column), F.lit(False)))
        if name in ("length", "count") and v.kind == "list":
            return Value("number", F.size(v.column))
        if name in FUNCTIONS and not given:
            return FUNCTIONS[name](text_of(v))
        raise TemplateError(f"unsupported: {name} of a {v.kind}")

    def item(self) -> Value:
        v = self.atom()
        while True:
            if self.take("."):
                name = self.name()
                v = self._call(v, name, self._arguments()) if self.peek("(") else self._field(v, name)
            elif self.take("["):
                v = self._index(v)
            else:
                return v

    def _field(self, v: Value, name: str) -> Value:
        if v.kind == "message":
            return _text(v.column[name]) if name in FIELDS else UNDEFINED
        if v.kind == "loop" and name in v.parts:
            return v.parts[name]
        if v.kind == "undefined":
            return UNDEFINED
        raise TemplateError(f"unsupported: {name!r} of a {v.kind}")

    def _index(self, v: Value) -> Value:
        number = lambda: int(self.tokens[self.at - 1][1])
        if self.at < len(self.tokens) and self.tokens[self.at][0] == "text":
            self.at += 1
            name = self.tokens[self.at - 1][1]
            self.need("]")
            if v.kind == "dict":
                return self._call(v, "get", [_text(F.lit(name))])
            return self._field(v, name)
        if v.kind == "dict":
            key = self.conditional()
            self.need("]")
            return self._call(v, "get", [key])
        back = bool(self.take("-"))
        start = None
        if self.at < len(self.tokens) and self.tokens[self.at][0] == "number":
            self.at += 1
            start = -number() if back else number()
        if v.kind != "list":
            raise TemplateError(f"unsupported: an index of a {v.kind}")
        if self.take(":"):
            if not self.take("]") or (start or 0) < 0:
                raise TemplateError("only slices from a position to the end are supported")
            return Value("list", F.slice(v.column, (start or 0) + 1, F.greatest(F.size(v.column), F.lit(0))))
        self.need("]")
        if start is None:
            raise TemplateError("an index must be a number")
        at = F.lit(start) if start >= 0 else F.size(v.column) + start
        return Value("message", F.get(v.column, at))

    def atom(self) -> Value:
        if self.at >= len(self.tokens):
            raise TemplateError("an expression is missing")
        kind, value = self.tokens[self.at]
        self.at += 1
        if kind == "text":
            return _text(F.lit(value))
        if kind == "number":
            return Value("number", F.lit(int(value)))
        if value == "(":
            v = self.conditional()
            self.need(")")
            return v
        if value in ("{", "["):
            keys, values = [], []
            while not self.take("}" if value == "{" else "]"):
                keys.append(self.conditional())
                if value == "{":
                    self.need(":")
                    values.append(self.conditional())
                if not self.peek("}", "]"):
                    self.need(",")
            return Value("dict", None, {"keys": keys, "values": values or keys})
        if value in ("true", "True", "false", "False"):
            return Value("bool", F.lit(value.lower() == "true"))
        if value in ("none", "None"):
            return UNDEFINED
        if value == "raise_exception":
            given = self._arguments()
            return _text(F.raise_error(text_of(given[0])).cast("string"))
        if kind == "name" and not self.peek("("):
            return self.names.get(value, UNDEFINED)
        raise TemplateError(f"unsupported: {value!r}")


def parts_of(text: str, trim_blocks: bool, lstrip_blocks: bool) -> list[tuple[str, str]]:
    """Text, expressions and statements of a template, with white space control applied."""
    found: list[tuple[str, str]] = []
    at, trim = 0, ""
    for m in _part.finditer(text):
        before, block, left = text[at : m.start()], m.group(5) is not None or m.group(8) is not None, m.group(1) or m.group(4) or m.group(7)
        if trim == "-":
            before = before.lstrip()
        elif trim == "block" and before.startswith("\n"):
            before = before[1:]
        if left == "-":
            before = before.rstrip()
        elif block and lstrip_blocks and left != "+":
            line = before[before.rfind("\n") + 1 :]
            if not line.strip(" \t") and ("\n" in before or at == 0):
                before = before[: len(before) - len(line)]
        found.append(("text", before))
        if m.group(2) is not None:
            found.append(("print", m.group(2)))
        elif m.group(5) is not None:
            found.append(("block", m.group(5).strip()))
        trim = "-" if m.group(3) or m.group(6) or m.group(9) else "block" if block and trim_blocks else ""
        at = m.end()
    rest = text[at:]
    rest = rest.lstrip() if trim == "-" else rest[1:] if trim == "block" and rest.startswith("\n") else rest
    found.append(("text", rest))
    if "{{" in rest or "{%" in rest:
        raise TemplateError("a block is not closed")
    return [p for p in found if p[1]]


class Body:
    """Compiles parts up to one of the given block ends."""

    def __init__(self, parts: list[tuple[str, str]]):
        self.parts, self.at = parts, 0

    def compile(self, names: dict[str, Value], ends: tuple[str, ...] = ()) -> tuple[Column, str]:
        out: list[Column] = []
        while self.at < len(self.parts):
            kind, code = self.parts[self.at]
            self.at += 1
            if kind == "text":
                out.append(F.lit(code))
            elif kind == "print":
                out.append(text_of(Expression(code, names).whole()))
            else:
                word = code.split(None, 1)[0]
                if word in ends:
                    return self._concat(out), code
                rest = code[len(word) :]
                if word == "set":
                    e = Expression(rest, names)
                    name = e.name()
                    e.need("=")
                    names[name] = e.whole()
                elif word == "if":
                    out.append(self._if(rest, names))
                elif word == "for":
                    out.append(self._for(rest, names))
                elif word != "generation" and word != "endgeneration":
                    raise TemplateError(f"unsupported block {word!r}")
        if ends:
            raise TemplateError(f"{ends[-1]!r} is missing")
        return self._concat(out), ""

    @staticmethod
    def _concat(out: list[Column]) -> Column:
        return F.lit("") if not out else out[0] if len(out) == 1 else F.concat(*out)

    def _if(self, code: str, names: dict[str, Value]) -> Column:
        condition = truth(Expression(code, names).whole())
        yes, no = dict(names), dict(names)
        shown, ended = self.compile(yes, ("elif", "else", "endif"))
        word = ended.split(None, 1)[0]
        if word == "elif":
            other = self._if(ended[4:], no)
        elif word == "else":
            other, _ = self.compile(no, ("endif",))
        else:
            other = F.lit("")
        # What a branch sets holds after it.
        for name in {**yes, **no}:
            names[name] = choose(condition, yes.get(name, UNDEFINED), no.get(name, UNDEFINED))
        return F.when(condition, shown).otherwise(other)

    def _for(self, code: str, names: dict[str, Value]) -> Column:
        e = Expression(code, names)
        name = e.name()
        e.need("in")
        over = e.item()
        if over.kind not in ("list", "undefined"):
            raise TemplateError(f"unsupported: a loop over a {over.kind}")
        start, inner = self.at, None
        rows = over.column
        if e.take("if"):
            condition = " ".join(v if k != "text" else repr(v) for k, v in e.tokens[e.at :])
            rows = None if rows is None else F.filter(rows, lambda m: truth(Expression(condition, {**names, name: Value("message", m)}).whole()))
        else:
            e.end()

        def body(m: Column, i: Column) -> Column:
            nonlocal inner
            self.at = start
            size = F.size(rows)
            loop = {"index0": i, "index": i + 1, "length": size}
            parts = {k: Value("number", v) for k, v in loop.items()} | {"first": Value("bool", i == 0), "last": Value("bool", i == size - 1)}
            shown, _ = self.compile({**names, name: Value("message", m), "loop": Value("loop", None, parts)}, ("endfor",))
            inner = self.at
            return shown

        if rows is None:
            rows = F.array().cast("array<struct<role:string,content:string>>")
        out = F.array_join(F.transform(rows, body), "")
        self.at = inner
        return F.coalesce(out, F.lit(""))


def compile_template(text: str, trim_blocks: bool = True, lstrip_blocks: bool = True) -> Callable[..., Column]:
    """Function of a column of messages (array of structs with role and content) and of named values (text, bool, columns or None)."""
    parts = parts_of(text, trim_blocks, lstrip_blocks)

    def render(messages: Column, **given) -> Column:
        names = {"messages": Value("list", messages)}
        for name, v in given.items():
            if isinstance(v, bool):
                names[name] = Value("bool", F.lit(v))
            elif v is not None:
                names[name] = _text(v if isinstance(v, Column) else F.lit(v))
        return Body(parts).compile(names)[0]

    return render


def check_template(text: str) -> None:
    """Raises `TemplateError` for a template that cannot be compiled."""
    compile_template(text)(F.array().cast("array<struct<role:string,content:string>>"))


def render_by_template(df: DataFrame, template: str, messages: str, out: str = "text", trim_blocks: bool = True, lstrip_blocks: bool = True, **given) -> DataFrame:
    """`df` with the messages of each row rendered by the template text in its own column; a null template gives null.

    There are as many templates as there are tokenizers, so their distinct texts come to the driver;
    more than `MOST_TEMPLATES` are an error, as is a template that cannot be compiled.
    """
    texts = [r[0] for r in df.select(template).where(F.col(template).isNotNull()).distinct().limit(MOST_TEMPLATES + 1).collect()]
    if len(texts) > MOST_TEMPLATES:
        raise TemplateError(f"more than {MOST_TEMPLATES} distinct templates")
    shown = F.lit(None).cast("string")
    for text in sorted(texts):
        one = compile_template(text, trim_blocks, lstrip_blocks)(F.col(messages), **given)
        shown = F.when(F.col(template) == text, one).otherwise(shown)
    return df.withColumn(out, shown)
