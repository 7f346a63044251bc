"""A model's chat template, as its tokenizer ships it, as one Column expression.

The text of a template (loops over messages, tests, ``set``, ``add_generation_prompt``) is read
once, on the driver. What comes of it is built-in Spark functions: a loop is a ``transform`` of the
message array, a test a ``CASE``. Tests whose outcome is known beforehand (a variable that is given,
or one that is not) are decided while reading, and only the branch taken remains.

Known: ``for`` over messages or a slice of them (with an ``if``), ``if / elif / else``, ``set``,
comments and white-space control; strings, whole numbers, ``true / false / none``; ``+ - * // % ~``,
comparisons, ``in``, ``is``, ``and / or / not``, ``a if test else b``; ``loop.index``, ``index0``,
``first``, ``last``, ``length``, ``previtem``, ``nextitem``; ``m.role`` and ``m['role']``; the string methods and
filters in ``_METHODS``; ``length``, ``first``, ``last``, ``default``; ``raise_exception``. Anything else is
refused with a ``TemplateError`` that names it.

Blocks are trimmed as tokenizers do it: a block takes the line break behind it and the blanks
before it on its line. Differences by choice: a role or content of NULL is empty text, so that its
turn is not lost; a name set to text in one branch and to false or none in another is empty text when
printed; a name without a value prints nothing. NULL messages give NULL.
"""

from __future__ import annotations

import ast
import operator
import re
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tunefeed.functions.text import PY_WS

_TAG = re.compile(
    r"""\{\#.*?\#\} | \{(?P<open>[%{])(?P<left>[-+]?)(?P<body>(?:'(?:\\.|[^'\\])*'|"(?:\\.|[^"\\])*"|[^'"])*?)(?P<right>[-+]?)[%}]\}""",
    re.DOTALL | re.VERBOSE,
)
_TOKEN = re.compile(
    r"""\s*(?:(?P<string>'(?:\\.|[^'\\])*'|"(?:\\.|[^"\\])*")|(?P<number>\d+(?![.\w]))|(?P<name>[A-Za-z_]\w*)"""
    r"""|(?P<sign>==|!=|<=|>=|//|[-+*%~<>()\[\].,:|=]))""",
    re.DOTALL,
)


class TemplateError(ValueError):
    """The template has something that cannot be translated."""


# --- values: what a part of an expression is known to be


@dataclass(frozen=True)
class Value:
    """``kind`` is text, number, truth, messages, message or nothing; ``known`` says that
    ``constant`` is the value itself, else ``column`` has it. A NULL column is nothing."""

    kind: str
    column: Column | None = None
    constant: object = None
    known: bool = False
    defined: bool = True

    @property
    def col(self) -> Column:
        return F.lit(self.constant) if self.known else self.column


NONE = Value("nothing", constant=None, known=True)
UNDEFINED = replace(NONE, defined=False)


def _constant(value: object) -> Value:
    if value is None:
        return NONE
    kinds = {bool: "truth", int: "number", str: "text"}
    if type(value) not in kinds:
        raise TemplateError(f"a variable of type {type(value).__name__}")
    return Value(kinds[type(value)], constant=value, known=True)


def _truth(value: Value) -> Value:
    """Whether a value counts as true; never NULL."""
    if value.known:
        return _constant(bool(value.constant))
    tests = {
        "text": lambda c: c != "",
        "number": lambda c: c != 0,
        "truth": lambda c: c,
        "messages": lambda c: F.size(c) > 0,
        "message": lambda c: c.isNotNull(),
    }
    return Value("truth", F.coalesce(tests[value.kind](value.column), F.lit(False)))


def _not(value: Value) -> Value:
    value = _truth(value)
    return _constant(not value.constant) if value.known else Value("truth", ~value.column)


def _choose(test: Value, yes: Value, no: Value) -> Value:
    """``yes`` where the (truth) test holds, else ``no``."""
    if test.known:
        return yes if test.constant else no
    if yes is no or (yes.known and no.known and yes == no):
        return yes
    empty = [v.kind == "nothing" or (v.known and v.constant is False) for v in (yes, no)]
    if yes.kind != no.kind and not any(empty):
        raise TemplateError(f"a value that is {yes.kind} in one branch and {no.kind} in another")
    if yes.kind == no.kind:
        return Value(yes.kind, F.when(test.column, yes.col).otherwise(no.col))
    if all(empty):
        return Value("truth", F.lit(False))
    if empty[0]:
        return Value(no.kind, F.when(~test.column, no.col))
    return Value(yes.kind, F.when(test.column, yes.col))


def _printed(value: Value) -> Column:
    if value.kind in ("messages", "message"):
        raise TemplateError(f"printing a whole {value.kind}")
    if value.known:
        return F.lit("" if value.constant is None and not value.defined else str(value.constant))
    if value.kind == "truth":
        return F.when(value.column, F.lit("True")).otherwise(F.lit("False"))
    return F.coalesce(value.column.cast("string"), F.lit(""))


def _text(value: Value, use: str) -> Column:
    if value.kind != "text":
        raise TemplateError(f"{use} of {value.kind}")
    return value.col


# --- expressions


def _fixed(value: Value, use: str) -> object:
    if not value.known:
        raise TemplateError(f"{use} that depends on the row")
    return value.constant


def _stripped(side: str):
    def strip(text: Column, chars: str = PY_WS) -> Column:
        if not chars:
            return text
        cut = {"both": F.trim, "left": F.ltrim, "right": F.rtrim}[side]
        return cut(text, F.lit(chars))

    return strip


# Methods and filters of a text, with arguments that do not depend on the row.
_METHODS = {
    "strip": _stripped("both"),
    "trim": _stripped("both"),
    "lstrip": _stripped("left"),
    "rstrip": _stripped("right"),
    "upper": lambda text: F.upper(text),
    "lower": lambda text: F.lower(text),
    "replace": lambda text, old, new: F.replace(text, F.lit(old), F.lit(new)),
    "startswith": lambda text, part: F.startswith(text, F.lit(part)),
    "endswith": lambda text, part: F.endswith(text, F.lit(part)),
}
_TESTS_OF_TEXT = ("startswith", "endswith")


def _called(name: str, value: Value, arguments: list[Value]) -> Value:
    if name not in _METHODS:
        raise TemplateError(f"the method or filter {name!r}")
    fixed = [_fixed(a, f"an argument of {name!r}") for a in arguments]
    if any(type(a) is not str for a in fixed):
        raise TemplateError(f"an argument of {name!r} that is no text")
    if name in ("upper", "lower") and fixed or name in ("replace",) and len(fixed) != 2:
        raise TemplateError(f"the arguments of {name!r}")
    column = _METHODS[name](F.coalesce(_text(value, f"{name!r}"), F.lit("")), *fixed)
    return Value("truth" if name in _TESTS_OF_TEXT else "text", column)


def _filtered(name: str, value: Value, arguments: list[Value]) -> Value:
    if name in ("length", "count"):
        if value.kind == "messages":
            return Value("number", F.size(value.column))
        return Value("number", F.length(F.coalesce(_text(value, name), F.lit(""))))
    if name in ("first", "last") and value.kind == "messages":
        return _item(value, 0 if name == "first" else -1)
    if name in ("default", "d") and 1 <= len(arguments) <= 2:
        anyway = len(arguments) == 2 and bool(_fixed(arguments[1], "default"))
        if value.known:
            missing = not value.defined or (anyway and not value.constant)
            return arguments[0] if missing else value
        return _choose(_truth(value) if anyway else Value("truth", value.column.isNotNull()), value, arguments[0])
    if name == "string":
        return Value("text", _printed(value))
    return _called(name, value, arguments)


def _item(value: Value, at: int) -> Value:
    if value.kind != "messages":
        raise TemplateError(f"an item of {value.kind}")
    index = F.lit(at) if at >= 0 else F.size(value.column) + at
    # A place before the first one is none.
    return Value("message", F.when(index >= 0, F.get(value.column, F.greatest(index, F.lit(0)))))


def _slice(value: Value, begin: int | None, end: int | None) -> Value:
    size = F.size(value.column)

    def place(at: int) -> Column:
        return F.least(F.lit(at), size) if at >= 0 else F.greatest(size + at, F.lit(0))

    first = place(begin or 0)
    length = F.greatest((size if end is None else place(end)) - first, F.lit(0))
    return Value("messages", F.slice(value.column, first + 1, length))


def _equal(a: Value, b: Value) -> Value:
    if a.known and b.known:
        return _constant(a.constant == b.constant)
    for x, y in ((a, b), (b, a)):
        if x.known and (x.constant is None or (x.constant is False and y.kind != "truth")):
            return Value("truth", y.col.isNull())
    if a.kind != b.kind:
        return _constant(False)
    return Value("truth", a.col.eqNullSafe(b.col))


_ORDER = {"<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge}
_ARITHMETIC = {
    "-": operator.sub,
    "*": operator.mul,
    "//": lambda a, b: F.floor(a / b).cast("int"),
    "%": lambda a, b: F.pmod(a, b),
}


def _arithmetic(sign: str, a: Value, b: Value) -> Value:
    if sign == "+" and a.kind == b.kind == "text":
        if a.known and b.known:
            return _constant(a.constant + b.constant)
        blank = F.lit("")
        return Value("text", F.concat(F.coalesce(a.col, blank), F.coalesce(b.col, blank)))
    if a.kind != "number" or b.kind != "number":
        raise TemplateError(f"{a.kind} {sign} {b.kind}")
    if a.known and b.known:
        known = {"+": operator.add, "-": operator.sub, "*": operator.mul, "//": operator.floordiv, "%": operator.mod}
        return _constant(known[sign](a.constant, b.constant))
    return Value("number", operator.add(a.col, b.col) if sign == "+" else _ARITHMETIC[sign](a.col, b.col))


class _Expression:
    """One expression, read from left to right and translated on the way."""

    def __init__(self, text: str, names: dict[str, Value], fields: tuple[str, ...]):
        self.names, self.fields, self.text = names, fields, text
        self.tokens: list[tuple[str, str]] = []
        at, text = 0, text.strip()
        while at < len(text):
            found = _TOKEN.match(text, at)
            if not found:
                raise TemplateError(f"{text[at:at + 20]!r} in {self.text.strip()!r}")
            self.tokens.append((found.lastgroup, found[found.lastgroup]))
            at = found.end()
        self.at = 0

    def whole(self) -> Value:
        value = self.ternary()
        if self.at < len(self.tokens):
            raise TemplateError(f"{self.tokens[self.at][1]!r} in {self.text.strip()!r}")
        return value

    def peek(self, *words: str) -> bool:
        if self.at >= len(self.tokens):
            return False
        kind, word = self.tokens[self.at]
        return kind in ("name", "sign") and word in words

    def take(self, *words: str) -> str | None:
        if self.peek(*words):
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def need(self, word: str) -> None:
        if not self.take(word):
            raise TemplateError(f"{word!r} is missing in {self.text.strip()!r}")

    def name(self) -> str:
        if self.at < len(self.tokens) and self.tokens[self.at][0] == "name":
            self.at += 1
            return self.tokens[self.at - 1][1]
        raise TemplateError(f"a name is missing in {self.text.strip()!r}")

    def ternary(self) -> Value:
        value = self.either()
        while self.take("if"):
            test = _truth(self.either())
            value = _choose(test, value, self.ternary() if self.take("else") else UNDEFINED)
        return value

    def either(self) -> Value:
        value = self.both()
        while self.take("or"):
            other = self.both()
            if value.known:
                value = value if value.constant else other
            elif value.kind == other.kind != "truth":
                value = _choose(_truth(value), value, other)
            else:
                value = Value("truth", _truth(value).column | _truth(other).col)
        return value

    def both(self) -> Value:
        value = self.negated()
        while self.take("and"):
            other = self.negated()
            if value.known:
                value = other if value.constant else value
            elif value.kind == other.kind != "truth":
                value = _choose(_truth(value), other, value)
            else:
                value = Value("truth", _truth(value).column & _truth(other).col)
        return value

    def negated(self) -> Value:
        return _not(self.negated()) if self.take("not") else self.compared()

    def compared(self) -> Value:
        value = self.sum()
        while True:
            if sign := self.take("==", "!="):
                same = _equal(value, self.sum())
                value = same if sign == "==" else _not(same)
            elif sign := self.take("<", "<=", ">", ">="):
                other = self.sum()
                if value.kind != "number" or other.kind != "number":
                    raise TemplateError(f"{value.kind} {sign} {other.kind}")
                value = _truth(Value("truth", _ORDER[sign](value.col, other.col)))
            elif self.take("in"):
                value = self.contained(value)
            elif self.peek("not") and self.tokens[self.at + 1 : self.at + 2] == [("name", "in")]:
                self.at += 2
                value = _not(self.contained(value))
            else:
                return value

    def contained(self, value: Value) -> Value:
        if self.take("[", "("):
            close, same = {"[": "]", "(": ")"}[self.tokens[self.at - 1][1]], []
            while not self.take(close):
                same.append(_equal(value, self.ternary()))
                if not self.peek(close):
                    self.need(",")
            hits = [s for s in same if not s.known]
            if any(s.known and s.constant for s in same):
                return _constant(True)
            return Value("truth", reduce(operator.or_, [s.column for s in hits])) if hits else _constant(False)
        other = self.sum()
        if not other.defined or not value.defined:
            return _constant(False)
        return _truth(Value("truth", F.contains(_text(other, "in"), _text(value, "in"))))

    def sum(self) -> Value:
        value = self.joined()
        while sign := self.take("+", "-"):
            value = _arithmetic(sign, value, self.joined())
        return value

    def joined(self) -> Value:
        value = self.product()
        while self.take("~"):
            value = Value("text", F.concat(_printed(value), _printed(self.product())))
        return value

    def product(self) -> Value:
        value = self.signed()
        while sign := self.take("*", "//", "%"):
            value = _arithmetic(sign, value, self.signed())
        return value

    def signed(self) -> Value:
        if self.take("-"):
            return _arithmetic("-", _constant(0), self.signed())
        value = self.primary()
        while True:
            if self.take("."):
                value = self.attribute(value, self.name())
            elif self.take("["):
                value = self.subscript(value)
            elif self.take("|"):
                name = self.name()
                value = _filtered(name, value, self.arguments() if self.take("(") else [])
            elif self.take("is"):
                no, test = self.take("not"), self.name()
                value = _not(self.tested(value, test)) if no else self.tested(value, test)
            else:
                return value

    def arguments(self) -> list[Value]:
        out = []
        while not self.take(")"):
            out.append(self.ternary())
            if not self.peek(")"):
                self.need(",")
        return out

    def primary(self) -> Value:
        if self.take("("):
            value = self.ternary()
            self.need(")")
            return value
        if self.at >= len(self.tokens):
            raise TemplateError(f"the end of {self.text.strip()!r}")
        kind, word = self.tokens[self.at]
        self.at += 1
        if kind == "string":
            return _constant(ast.literal_eval(word.replace("\n", "\\n")))
        if kind == "number":
            return _constant(int(word))
        if kind != "name":
            raise TemplateError(f"{word!r} in {self.text.strip()!r}")
        if word.lower() in ("true", "false", "none"):
            return _constant({"true": True, "false": False, "none": None}[word.lower()])
        if word == "raise_exception":
            self.need("(")
            message = self.arguments()
            if len(message) != 1:
                raise TemplateError("raise_exception without one message")
            return Value("text", F.raise_error(_printed(message[0])).cast("string"))
        if self.peek("("):
            raise TemplateError(f"the function {word!r}")
        return self.names.get(word, UNDEFINED)

    def attribute(self, value: Value, name: str) -> Value:
        if value is self.names.get("loop") and isinstance(value, Loop):
            return value.part(name)
        if self.take("("):
            return _called(name, value, self.arguments())
        if value.kind == "message":
            return Value("text", value.column[name]) if name in self.fields else UNDEFINED
        if not value.defined:
            return UNDEFINED
        raise TemplateError(f"{name!r} of {value.kind}")

    def subscript(self, value: Value) -> Value:
        begin = None if self.peek(":") else _fixed(self.ternary(), "an index")
        if self.take(":"):
            end = None if self.peek("]") else _fixed(self.ternary(), "an index")
            self.need("]")
            if value.kind != "messages" or any(i is not None and type(i) is not int for i in (begin, end)):
                raise TemplateError(f"a slice of {value.kind}")
            return _slice(value, begin, end)
        self.need("]")
        if isinstance(begin, str):
            return self.attribute(value, begin)
        if type(begin) is not int:
            raise TemplateError(f"the index {begin!r}")
        return _item(value, begin)

    def tested(self, value: Value, test: str) -> Value:
        exists = _constant(value.constant is not None) if value.known else Value("truth", value.column.isNotNull())
        if test == "defined":
            # A message always has its fields; a place may be beyond the last message.
            return _constant(value.defined) if value.known or value.kind == "text" else exists
        if test == "undefined":
            return _not(self.tested(value, "defined"))
        if test == "none":
            return _not(exists) if value.defined else _constant(False)
        kinds = {"string": ("text",), "number": ("number",), "mapping": ("message",), "iterable": ("text", "messages", "message")}
        if test not in kinds:
            raise TemplateError(f"the test {test!r}")
        return exists if value.kind in kinds[test] else _constant(False)


@dataclass(frozen=True)
class Loop(Value):
    """The name ``loop`` inside a loop over ``items``."""

    items: Column | None = None
    index: Column | None = None

    def part(self, name: str) -> Value:
        size = F.size(self.items)
        numbers = {"index0": self.index, "index": self.index + 1, "length": size, "revindex": size - self.index, "revindex0": size - self.index - 1}
        if name in numbers:
            return Value("number", numbers[name])
        if name in ("first", "last"):
            return Value("truth", self.index == (F.lit(0) if name == "first" else size - 1))
        if name == "nextitem":
            return Value("message", F.get(self.items, self.index + 1))
        if name == "previtem":
            return Value("message", F.when(self.index > 0, F.get(self.items, F.greatest(self.index - 1, F.lit(0)))))
        raise TemplateError(f"loop.{name}")


# --- statements


@dataclass
class _Block:
    """A piece of text, an expression to print, or a statement with what stands in it."""

    kind: str
    body: str = ""
    branches: list[tuple[str, list[_Block]]] = field(default_factory=list)


def _pieces(source: str) -> list[tuple[str, str]]:
    """(kind, body): text, print or statement, white space taken out as blocks demand."""
    if source.endswith("\n"):
        source = source[:-1]
    out, at, line_begins, strip_left, drop_break = [], 0, True, False, False
    for tag in [*_TAG.finditer(source), None]:
        text = source[at : tag.start() if tag else len(source)]
        if strip_left:
            line_begins = text[: len(text) - len(text.lstrip())].endswith("\n")
            text = text.lstrip()
        elif drop_break:
            line_begins = text.startswith("\n")
            text = text[1:] if line_begins else text
        if tag:
            comment = tag["open"] is None
            left = "-" if comment and tag[0].startswith("{#-") else tag["left"] or ""
            right = "-" if comment and tag[0].endswith("-#}") else tag["right"] or ""
            if left == "-":
                text = text.rstrip()
            elif tag["open"] != "{" and left != "+":
                line = text.rfind("\n") + 1
                if (line or line_begins) and not text[line:].strip():
                    text = text[:line]
            strip_left, drop_break = right == "-", tag["open"] != "{" and right != "+"
            at, line_begins = tag.end(), False
        if text:
            out.append(("text", text))
        if tag and not comment:
            out.append(("print" if tag["open"] == "{" else "statement", tag["body"]))
    for kind, text in out:
        if kind == "text" and re.search(r"\{[%{#]", text):
            raise TemplateError(f"a tag without an end near {text[-30:]!r}")
    return out


def _parsed(pieces: list[tuple[str, str]]) -> list[_Block]:
    root = _Block("root", branches=[("", [])])
    open_blocks = [root]
    for kind, body in pieces:
        inside = open_blocks[-1].branches[-1][1]
        if kind != "statement":
            inside.append(_Block(kind, body))
            continue
        word, _, rest = body.strip().partition(" ")
        rest = rest.strip()
        if word in ("if", "for", "generation"):
            block = _Block(word, rest, [(rest, [])])
            inside.append(block)
            open_blocks.append(block)
        elif word in ("elif", "else") and open_blocks[-1].kind == "if" and open_blocks[-1].branches[-1][0]:
            open_blocks[-1].branches.append((rest if word == "elif" else "", []))
        elif word in ("endif", "endfor", "endgeneration") and open_blocks[-1].kind == word[3:]:
            open_blocks.pop()
        elif word == "set" and "=" in rest:
            inside.append(_Block("set", rest))
        else:
            raise TemplateError(f"the statement {body.strip()!r}")
    if len(open_blocks) > 1:
        raise TemplateError(f"a {open_blocks[-1].kind} without an end")
    return root.branches[0][1]


@dataclass(frozen=True)
class TemplateText:
    """A template to render message lists with; see ``compile_template``."""

    source: str
    variables: tuple[tuple[str, object], ...] = ()
    fields: tuple[str, ...] = ("role", "content")

    def render(self, messages: Column, add_generation_prompt: bool = False) -> Column:
        """The text of an array of messages; NULL for a NULL array."""
        names = {k: _constant(v) for k, v in self.variables}
        names["messages"] = Value("messages", messages)
        names["add_generation_prompt"] = _constant(add_generation_prompt)
        parts = self._run(_parsed(_pieces(self.source)), names)
        return F.when(messages.isNotNull(), _concat(parts))

    def _run(self, blocks: list[_Block], names: dict[str, Value]) -> list[Column | str]:
        """What the blocks print; ``names`` is changed by what they set."""
        out: list[Column | str] = []
        for block in blocks:
            if block.kind == "text":
                out.append(block.body)
            elif block.kind == "print":
                value = self._value(block.body, names)
                out.append(value.constant if value.known and value.kind == "text" else _printed(value))
            elif block.kind == "set":
                name, _, text = block.body.partition("=")
                if not name.strip().isidentifier():
                    raise TemplateError(f"setting {name.strip()!r}")
                names[name.strip()] = self._value(text, names)
            elif block.kind == "generation":
                out += self._run(block.branches[0][1], names)
            elif block.kind == "if":
                out += self._branches(block.branches, names)
            else:
                out.append(self._loop(block, names))
        return out

    def _value(self, text: str, names: dict[str, Value]) -> Value:
        return _Expression(text, names, self.fields).whole()

    def _branches(self, branches: list[tuple[str, list[_Block]]], names: dict[str, Value]) -> list[Column | str]:
        if not branches:
            return []
        (text, blocks), rest = branches[0], branches[1:]
        test = _truth(self._value(text, names)) if text else _constant(True)
        if test.known:
            return self._run(blocks, names) if test.constant else self._branches(rest, names)
        yes, no = dict(names), dict(names)
        taken, other = _concat(self._run(blocks, yes)), _concat(self._branches(rest, no))
        for name in yes.keys() | no.keys():
            names[name] = _choose(test, yes.get(name, UNDEFINED), no.get(name, UNDEFINED))
        return [F.when(test.column, taken).otherwise(other)]

    def _loop(self, block: _Block, names: dict[str, Value]) -> Column:
        found = re.fullmatch(r"(\w+)\s+in\s+(.+)", block.body, re.DOTALL)
        if not found:
            raise TemplateError(f"the loop {block.body!r}")
        name, source = found[1], found[2]
        expression = _Expression(source, names, self.fields)
        items = expression.either()
        if items.kind != "messages":
            raise TemplateError(f"a loop over {items.kind}")
        column = items.column
        if expression.take("if"):
            rest = " ".join(word for _, word in expression.tokens[expression.at :])
            column = F.filter(column, lambda m: _truth(self._value(rest, names | {name: Value("message", m)})).col)
        elif expression.at < len(expression.tokens):
            raise TemplateError(f"the loop {block.body!r}")

        def body(message: Column, index: Column) -> Column:
            inner = names | {name: Value("message", message), "loop": Loop("loop", items=column, index=index)}
            return _concat(self._run(block.branches[0][1], inner))

        return F.array_join(F.transform(column, body), "")


def _concat(parts: list[Column | str]) -> Column:
    """Texts that are known beforehand become one literal."""
    merged: list[Column | str] = []
    for part in parts:
        if isinstance(part, str) and merged and isinstance(merged[-1], str):
            merged[-1] += part
        else:
            merged.append(part)
    columns = [F.lit(p) if isinstance(p, str) else p for p in merged]
    return columns[0] if len(columns) == 1 else F.concat(*columns) if columns else F.lit("")


def compile_template(source: str, fields: tuple[str, ...] = ("role", "content"), **variables: object) -> TemplateText:
    """A template's text as something ``render_chat``, ``render_prompt``, ``training_text`` and
    ``prepare_feed`` take for ``template``. ``variables`` are what the template may name besides the
    messages, such as ``bos_token``; ``fields`` are those of a message. What cannot be translated
    is refused here, before any row is read.
    """
    template = TemplateText(source, tuple(sorted(variables.items())), fields)
    for prompt in (False, True):
        template.render(F.col("messages"), prompt)
    return template
