"""Chat templates given as text, compiled to columns.

Conversations have known roles, so a template is worked through once for each shape of conversation:
what depends on roles, places and tokens is decided then, and only contents are left as columns. The
result is a concatenation in generated code. What lies outside the subset raises with its place.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from promptloom.functions.values import optional_text, present, printed, stripped

_TAG = re.compile(r"\{%[-+]?|\{\{[-+]?|\{#[-+]?")
_TOKEN = re.compile(
    r"""\s*(?:(?P<text>'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(?P<number>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<mark>==|!=|<=|>=|//|[-+*/%~<>=.,:|()\[\]]))""",
    re.S,
)
_CLOSES = {"{%": "%}", "{{": "}}", "{#": "#}"}
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r", "\\": "\\", "'": "'", '"': '"'}


class TemplateError(ValueError):
    """A template, or a part of one, that is not compiled."""


class _Raised(Exception):
    """What a template raises itself."""


@dataclass(frozen=True)
class _Text:
    """A text that is only known in the rows."""

    column: Column
    null: Column | None = None

    def printed(self) -> Column:
        return printed(self.column) if self.null is not None else self.column


@dataclass(frozen=True)
class _Condition:
    """A condition that is only known in the rows; never null."""

    column: Column


class _Undefined:
    pass


class _Namespace(dict):
    pass


UNDEFINED = _Undefined()


# Reading


def _pieces(source: str) -> list[tuple[str, str, int]]:
    """Texts and tags with their places. As chat templates are rendered, the line end after a block goes,
    and the white space before a block that begins its line."""
    source = source.removesuffix("\n")
    out, at, strip_next, line_start = [], 0, False, True
    while True:
        opening = _TAG.search(source, at)
        text = source[at : opening.start() if opening else len(source)]
        if strip_next:
            text = text.lstrip()
        if opening:
            kind, mark = opening[0][:2], opening[0][2:]
            if mark == "-":
                text = text.rstrip()
            elif kind != "{{" and mark != "+":
                last = text.rfind("\n") + 1
                if (last or line_start) and not text[last:].strip(" \t"):
                    text = text[:last]
        if text:
            out.append(("text", text, at))
        if not opening:
            return out
        end = _end_of(source, opening.end(), _CLOSES[kind])
        body = source[opening.end() : end]
        strip_next = body.endswith("-")
        at, line_start = end + 2, False
        if kind != "{#":
            out.append((kind, body[:-1] if strip_next else body, opening.end()))
        if kind != "{{" and not strip_next and source.startswith("\n", at):
            at, line_start = at + 1, True


def _end_of(source: str, at: int, closing: str) -> int:
    quote = None
    for i in range(at, len(source)):
        if quote:
            quote = None if source[i] == quote and source[i - 1] != "\\" else quote
        elif source[i] in "'\"" and closing != "#}":
            quote = source[i]
        elif source.startswith(closing, i):
            return i
    raise TemplateError(f"A tag is not closed{_place(source, at)}")


def _place(source: str, at: int) -> str:
    line = source.count("\n", 0, at) + 1
    return f" (line {line}, column {at - source.rfind(chr(10), 0, at)})"


class _Reader:
    """Turns the tags of a template into nested tuples: (kind, place, parts…)."""

    def __init__(self, source: str) -> None:
        self.source, self.pieces, self.next = source, _pieces(source), 0

    def fail(self, what: str, at: int):
        raise TemplateError(what + _place(self.source, at))

    def statements(self, *ends: str) -> tuple[list, str]:
        """Statements up to a tag of one of these names, and that name; its tokens are left to read."""
        found = []
        while self.next < len(self.pieces):
            kind, body, at = self.pieces[self.next]
            self.next += 1
            if kind == "text":
                found.append(("text", at, body))
                continue
            self.tokens, self.token = self._split(body, at), 0
            if kind == "{{":
                found.append(("print", at, self.expression()))
                self._finish()
                continue
            name = self._name()
            if name in ends:
                return found, name
            found.append(self._statement(name, at))
        if ends:
            self.fail(f"{ends[-1]} is missing", len(self.source))
        return found, ""

    def _split(self, body: str, at: int) -> list[tuple[str, str, int]]:
        tokens, i = [], 0
        while body[i:].strip():
            match = _TOKEN.match(body, i)
            if not match:
                self.fail(f"{body[i:].split()[0]!r} is not understood", at + i)
            tokens.append((match.lastgroup, match[match.lastgroup], at + match.start(match.lastgroup)))
            i = match.end()
        return [*tokens, ("end", "", at + len(body))]

    def _peek(self) -> str:
        kind, value, _ = self.tokens[self.token]
        return value if kind in ("mark", "name") else ""

    def _take(self, *values: str) -> bool:
        if self._peek() in values and self._peek():
            self.token += 1
            return True
        return False

    def _need(self, value: str) -> None:
        if not self._take(value):
            self.fail(f"{value!r} is missing", self.tokens[self.token][2])

    def _name(self) -> str:
        kind, value, at = self.tokens[self.token]
        if kind != "name":
            self.fail("A name is missing", at)
        self.token += 1
        return value

    def _finish(self) -> None:
        kind, value, at = self.tokens[self.token]
        if kind != "end":
            self.fail(f"{value!r} is not understood", at)

    def _statement(self, name: str, at: int) -> tuple:
        if name == "if":
            branches, otherwise = [], []
            while True:
                condition = self.expression()
                self._finish()
                body, end = self.statements("elif", "else", "endif")
                branches.append((condition, body))
                if end == "else":
                    self._finish()
                    otherwise, end = self.statements("endif")
                if end == "endif":
                    self._finish()
                    return "if", at, branches, otherwise
        if name == "for":
            variable = self._name()
            self._need("in")
            values = self.expression(ternary=False)
            condition = self.expression() if self._take("if") else None
            self._finish()
            body, _ = self.statements("endfor")
            self._finish()
            return "for", at, variable, values, condition, body
        if name == "set":
            target = [self._name()]
            if self._take("."):
                target.append(self._name())
            self._need("=")
            value = self.expression()
            self._finish()
            return "set", at, target, value
        if name in ("generation", "endgeneration"):
            self._finish()
            return "text", at, ""
        self.fail(f"{name!r} is not compiled", at)

    def expression(self, ternary: bool = True) -> tuple:
        value = self._binary(0)
        if ternary and self._take("if"):
            condition = self._binary(0)
            other = self.expression() if self._take("else") else ("value", 0, UNDEFINED)
            return "choice", 0, condition, value, other
        return value

    _LEVELS = (("or",), ("and",), ("not",), ("==", "!=", "<", ">", "<=", ">=", "in", "not"), ("+", "-"), ("~",), ("*", "/", "//", "%"))

    def _binary(self, level: int) -> tuple:
        if level == len(self._LEVELS):
            return self._unary()
        at = self.tokens[self.token][2]
        if level == 2:
            return ("not", at, self._binary(2)) if self._take("not") else self._binary(3)
        left = self._binary(level + 1)
        while self._peek() in self._LEVELS[level]:
            at, mark = self.tokens[self.token][2], self._peek()
            self.token += 1
            if mark == "not":
                self._need("in")
                mark = "not in"
            left = ("binary", at, mark, left, self._binary(level + 1))
        return left

    def _unary(self) -> tuple:
        at = self.tokens[self.token][2]
        if self._take("-"):
            return "binary", at, "-", ("value", at, 0), self._unary()
        return self._postfix(self._primary())

    def _primary(self) -> tuple:
        kind, value, at = self.tokens[self.token]
        self.token += 1
        if kind == "text":
            return "value", at, re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[0]), value[1:-1], flags=re.S)
        if kind == "number":
            return "value", at, int(value)
        if kind == "name":
            known = {"true": True, "True": True, "false": False, "False": False, "none": None, "None": None}
            return ("value", at, known[value]) if value in known else ("name", at, value)
        if value == "(":
            inner = self.expression()
            self._need(")")
            return inner
        if value == "[":
            items = []
            while not self._take("]"):
                items.append(self.expression())
                if not self._take(","):
                    self._need("]")
                    break
            return "list", at, items
        self.fail(f"{value or 'The end of the tag'!r} is not understood", at)

    def _postfix(self, value: tuple) -> tuple:
        while True:
            at = self.tokens[self.token][2]
            if self._take("."):
                value = ("item", at, value, ("value", at, self._name()))
            elif self._take("["):
                start = None if self._peek() == ":" else self.expression()
                if self._take(":"):
                    stop = None if self._peek() == "]" else self.expression()
                    value = ("slice", at, value, start, stop)
                else:
                    value = ("item", at, value, start)
                self._need("]")
            elif self._take("("):
                value = ("call", at, value, *self._arguments())
            elif self._take("|"):
                name = self._name()
                value = ("filter", at, name, value, *(self._arguments() if self._take("(") else ([], {})))
            elif self._take("is"):
                negated = self._take("not")
                name = self._name()
                value = ("test", at, name, value)
                value = ("not", at, value) if negated else value
            else:
                return value

    def _arguments(self) -> tuple[list, dict]:
        values, named = [], {}
        while not self._take(")"):
            ahead = self.tokens[self.token + 1] if self.token + 1 < len(self.tokens) else ("end", "", 0)
            if self.tokens[self.token][0] == "name" and ahead[1] == "=":
                name = self._name()
                self._need("=")
                named[name] = self.expression()
            else:
                values.append(self.expression())
            if not self._take(","):
                self._need(")")
                break
        return values, named


# Working through a template


def _truth(value) -> bool | _Condition:
    if isinstance(value, _Condition):
        return value
    if isinstance(value, _Text):
        # What is printed may be "None", but a null is false.
        return _Condition(F.coalesce(value.column != "", F.lit(False)))
    return value is not UNDEFINED and bool(value)


def _negated(value: bool | _Condition) -> bool | _Condition:
    return _Condition(~value.column) if isinstance(value, _Condition) else not value


def _as_column(value) -> Column:
    """What a value prints."""
    if isinstance(value, _Text):
        return value.printed()
    if isinstance(value, _Condition):
        return F.when(value.column, "True").otherwise("False")
    return F.lit("" if value is UNDEFINED else str(value))


def _joined(parts: Sequence) -> str | _Text:
    """Texts one after the other; known ones become one."""
    merged: list = []
    for part in parts:
        known = not isinstance(part, _Text | _Condition)
        part = ("" if part is UNDEFINED else str(part)) if known else part
        if known and merged and isinstance(merged[-1], str):
            merged[-1] += part
        elif part != "" or not known:
            merged.append(part)
    if not merged:
        return ""
    if len(merged) == 1:
        return merged[0] if isinstance(merged[0], str) else _Text(_as_column(merged[0]))
    return _Text(F.concat(*map(_as_column, merged)))


class _Run:
    """One rendering of a template for messages of known roles."""

    def __init__(self, source: str, names: Mapping[str, object]) -> None:
        self.source, self.scopes = source, [dict(names)]
        # Under which conditions the template raises, and with what.
        self.errors: list[tuple[Column, str]] = []
        self.path: list[Column] = []

    def fail(self, what: str, at: int):
        raise TemplateError(what + _place(self.source, at))

    def body(self, statements: list) -> list:
        out: list = []
        for kind, at, *rest in statements:
            out += getattr(self, f"_{kind}")(at, *rest)
        return out

    def _text(self, at: int, text: str) -> list:
        return [text]

    def _print(self, at: int, expression: tuple) -> list:
        value = self.value(expression)
        if isinstance(value, list | dict | _Loop):
            self.fail("A list or mapping is not printed", at)
        return [value]

    def _set(self, at: int, target: list, expression: tuple) -> list:
        value = self.value(expression)
        if len(target) == 1:
            self.scopes[-1][target[0]] = value
            return []
        space = self._look_up(target[0])
        if not isinstance(space, _Namespace):
            self.fail(f"{target[0]!r} is no namespace", at)
        if self.path:
            self.fail("A namespace is not set under a condition on a text", at)
        space[target[1]] = value
        return []

    def _for(self, at: int, variable: str, values: tuple, condition: tuple | None, body: list) -> list:
        items = self.value(values)
        if items is UNDEFINED:
            items = []
        if not isinstance(items, list):
            self.fail("Only lists are looped over", at)
        if condition:
            chosen = []
            for item in items:
                self.scopes.append({variable: item})
                kept = _truth(self.value(condition))
                self.scopes.pop()
                if isinstance(kept, _Condition):
                    self.fail("A loop's condition depends on a text", at)
                chosen += [item] if kept else []
            items = chosen
        out: list = []
        for place, item in enumerate(items):
            self.scopes.append({variable: item, "loop": _Loop(place, len(items), items)})
            out += self.body(body)
            self.scopes.pop()
        return out

    def _if(self, at: int, branches: list, otherwise: list) -> list:
        for i, (condition, body) in enumerate(branches):
            truth = _truth(self.value(condition))
            if truth is False:
                continue
            if truth is True:
                return self.body(body)
            rest = branches[i + 1 :]
            return self._either(truth, body, [("if", at, rest, otherwise)] if rest else otherwise)
        return self.body(otherwise)

    def _either(self, truth: _Condition, body: list, other: list) -> list:
        """Both branches, each where the condition says; variables they set become choices."""
        before = dict(self.scopes[-1])
        texts, sets = [], []
        for condition, statements in ((truth.column, body), (~truth.column, other)):
            self.scopes[-1] = dict(before)
            self.path.append(condition)
            try:
                texts.append(_joined(self.body(statements)))
            except _Raised as raised:
                self.errors.append((functools.reduce(lambda a, b: a & b, self.path), str(raised)))
                texts.append("")
            self.path.pop()
            sets.append(self.scopes[-1])
        self.scopes[-1] = before
        for name in {*sets[0], *sets[1]}:
            one, two = (own.get(name, UNDEFINED) for own in sets)
            self.scopes[-1][name] = one if one is two else self._choice(truth, one, two)
        return [self._choice(truth, *texts)]

    def _choice(self, truth: _Condition, one, two):
        if isinstance(one, bool | _Condition) and isinstance(two, bool | _Condition):
            sides = [v.column if isinstance(v, _Condition) else F.lit(v) for v in (one, two)]
            return _Condition(F.when(truth.column, sides[0]).otherwise(sides[1]))
        return _Text(F.when(truth.column, _as_column(one)).otherwise(_as_column(two)))

    def _look_up(self, name: str):
        for scope in reversed(self.scopes):
            if name in scope:
                return scope[name]
        return UNDEFINED

    def value(self, expression: tuple):
        kind, at, *rest = expression
        return getattr(self, f"_{kind}_value")(at, *rest)

    def _value_value(self, at: int, value):
        return value

    def _name_value(self, at: int, name: str):
        return self._look_up(name)

    def _list_value(self, at: int, items: list) -> list:
        return [self.value(item) for item in items]

    def _choice_value(self, at: int, condition: tuple, one: tuple, two: tuple):
        truth = _truth(self.value(condition))
        if isinstance(truth, _Condition):
            return self._choice(truth, self.value(one), self.value(two))
        return self.value(one if truth else two)

    def _not_value(self, at: int, value: tuple):
        return _negated(_truth(self.value(value)))

    def _item_value(self, at: int, of: tuple, key: tuple):
        holder, key = self.value(of), self.value(key)
        if isinstance(holder, _Loop):
            return holder.get(key)
        if isinstance(holder, dict):
            return holder.get(key, UNDEFINED)
        if isinstance(holder, list | str) and isinstance(key, int):
            return holder[key] if -len(holder) <= key < len(holder) else UNDEFINED
        if isinstance(holder, str | _Text) and isinstance(key, str):
            return _Method(holder, key)
        if holder is UNDEFINED or isinstance(holder, _Text):
            self.fail(f"{key!r} of this value is not compiled", at)
        return UNDEFINED

    def _slice_value(self, at: int, of: tuple, start: tuple | None, stop: tuple | None):
        holder = self.value(of)
        if not isinstance(holder, list | str):
            self.fail("Only lists and known texts are sliced", at)
        return holder[self.value(start) if start else None : self.value(stop) if stop else None]

    def _binary_value(self, at: int, mark: str, left: tuple, right: tuple):
        one = self.value(left)
        if mark in ("and", "or"):
            truth = _truth(one)
            if not isinstance(truth, _Condition):
                return one if truth == (mark == "or") else self.value(right)
            other = _truth(self.value(right))
            if not isinstance(other, _Condition):
                return truth if other == (mark == "and") else other
            return _Condition(truth.column & other.column if mark == "and" else truth.column | other.column)
        two = self.value(right)
        if mark == "~":
            return _joined([one, two])
        if mark in ("in", "not in"):
            found = self._holds(at, two, one)
            return found if mark == "in" else _negated(found)
        if isinstance(one, _Text) or isinstance(two, _Text):
            if mark == "+":
                return _joined([one, two])
            if mark in ("==", "!="):
                return self._equal(one, two) if mark == "==" else _negated(self._equal(one, two))
            self.fail(f"{mark!r} of a text that is only known in the rows is not compiled", at)
        try:
            return _OPERATIONS[mark](one, two)
        except (TypeError, ZeroDivisionError):
            self.fail(f"{mark!r} does not fit these values", at)

    def _equal(self, one, two) -> bool | _Condition:
        if not all(isinstance(v, _Text | str) for v in (one, two)):
            text = one if isinstance(one, _Text) else two
            known = None in (one, two) and text.null is not None
            return _Condition(text.null) if known else False
        columns = [v.column if isinstance(v, _Text) else F.lit(v) for v in (one, two)]
        return _Condition(F.coalesce(columns[0] == columns[1], F.lit(False)))

    def _holds(self, at: int, holder, what) -> bool | _Condition:
        if isinstance(holder, list):
            if isinstance(what, _Text):
                self.fail("'in' of a text that is only known in the rows and a list is not compiled", at)
            return what in holder
        if isinstance(holder, dict):
            return what in holder
        if isinstance(holder, str) and isinstance(what, str):
            return what in holder
        if isinstance(holder, str | _Text) and isinstance(what, str | _Text):
            return _Condition(F.contains(_as_column(holder), _as_column(what)))
        self.fail("'in' does not fit these values", at)

    def _call_value(self, at: int, of: tuple, arguments: list, named: dict):
        values = [self.value(a) for a in arguments]
        if of[0] == "name" and of[2] == "raise_exception":
            raise _Raised(str(values[0]) if values else "")
        if of[0] == "name" and of[2] == "namespace":
            return _Namespace({name: self.value(value) for name, value in named.items()})
        method = self.value(of)
        if not isinstance(method, _Method) or named:
            self.fail("This call is not compiled", at)
        return self._text_function(at, method.name, method.of, values)

    def _filter_value(self, at: int, name: str, of: tuple, arguments: list, named: dict):
        value, values = self.value(of), [self.value(a) for a in arguments]
        if name in ("default", "d"):
            return values[0] if value is UNDEFINED and values else value
        if name in ("length", "count") and isinstance(value, list | str):
            return len(value)
        if name in ("first", "last") and isinstance(value, list):
            return value[0 if name == "first" else -1] if value else UNDEFINED
        if name == "list" and isinstance(value, list):
            return value
        if name == "join" and isinstance(value, list):
            between = values[0] if values else ""
            return _joined([part for item in value for part in (between, item)][1:])
        if name == "string":
            return _joined([value])
        names = {"trim": "strip", "upper": "upper", "lower": "lower", "replace": "replace"}
        if name in names and not named:
            return self._text_function(at, names[name], value, values)
        self.fail(f"The filter {name!r} is not compiled", at)

    def _text_function(self, at: int, name: str, text, values: list):
        if not all(isinstance(v, str) for v in values):
            self.fail(f"{name!r} is compiled with known texts only", at)
        if not isinstance(text, _Text):
            if name not in _TEXT_FUNCTIONS:
                self.fail(f"{name!r} is not compiled", at)
            return getattr("" if text is UNDEFINED else str(text), name)(*values)
        function = _TEXT_FUNCTIONS.get(name)
        if function is None or (name in ("strip", "lstrip", "rstrip") and len(values) > 1):
            self.fail(f"{name!r} of a text that is only known in the rows is not compiled", at)
        result = function(_as_column(text), *map(F.lit, values))
        return _Condition(result) if name in ("startswith", "endswith") else _Text(result)

    def _test_value(self, at: int, name: str, of: tuple):
        value = self.value(of)
        if name in ("defined", "undefined"):
            return (value is not UNDEFINED) == (name == "defined")
        if name == "none":
            if isinstance(value, _Text) and value.null is not None:
                return _Condition(value.null)
            return value is None
        if name == "string":
            return _Condition(~value.null) if isinstance(value, _Text) and value.null is not None else isinstance(value, str | _Text)
        if name in ("mapping", "iterable", "sequence"):
            return isinstance(value, dict) if name == "mapping" else isinstance(value, list | str | _Text | dict)
        if name in ("true", "false") and not isinstance(value, _Condition):
            return value is (name == "true")
        if name in ("even", "odd") and isinstance(value, int):
            return value % 2 == (name == "odd")
        self.fail(f"The test {name!r} is not compiled", at)


@dataclass(frozen=True)
class _Method:
    of: object
    name: str


@dataclass(frozen=True)
class _Loop:
    place: int
    count: int
    items: list

    def get(self, name: str):
        known = {
            "index": self.place + 1, "index0": self.place, "first": self.place == 0, "last": self.place == self.count - 1,
            "length": self.count, "revindex": self.count - self.place, "revindex0": self.count - self.place - 1,
        }
        if name == "previtem":
            return self.items[self.place - 1] if self.place else UNDEFINED
        if name == "nextitem":
            return self.items[self.place + 1] if self.place + 1 < self.count else UNDEFINED
        return known.get(name, UNDEFINED)


_OPERATIONS: dict[str, Callable] = {
    "+": lambda a, b: a + b, "-": lambda a, b: a - b, "*": lambda a, b: a * b, "/": lambda a, b: a / b,
    "//": lambda a, b: a // b, "%": lambda a, b: a % b, "==": lambda a, b: a == b, "!=": lambda a, b: a != b,
    "<": lambda a, b: a < b, ">": lambda a, b: a > b, "<=": lambda a, b: a <= b, ">=": lambda a, b: a >= b,
}
_TEXT_FUNCTIONS: dict[str, Callable] = {
    "strip": lambda c, *chars: F.btrim(c, *chars) if chars else stripped(c),
    "lstrip": lambda c, *chars: F.ltrim(c, *chars) if chars else F.regexp_replace(c, r"(?U)^\s+", ""),
    "rstrip": lambda c, *chars: F.rtrim(c, *chars) if chars else F.regexp_replace(c, r"(?U)\s+$", ""),
    "upper": F.upper,
    "lower": F.lower,
    "replace": lambda c, old, new: F.replace(c, old, new),
    "startswith": F.startswith,
    "endswith": F.endswith,
}


@dataclass(frozen=True)
class ChatTemplate:
    """A chat template as text, with the special tokens of its model.

    It stands wherever a `ChatLayout` does. Conversations are `[system?] user [assistant?]`; what a
    template raises for one of them becomes the error of the rows that have it.
    """

    source: str
    tokens: Mapping[str, str] = field(default_factory=lambda: {"bos_token": "<s>", "eos_token": "</s>"})
    # Whether white space around a user's text is left out: found by rendering one.
    trim_content: bool = field(init=False, default=False)

    def __post_init__(self) -> None:
        object.__setattr__(self, "_statements", _Reader(self.source).statements()[0])
        messages = [{"role": "user", "content": "\t\x00\t"}]
        run = _Run(self.source, {**self.tokens, "messages": messages, "add_generation_prompt": True})
        try:
            text = "".join("" if part is UNDEFINED else str(part) for part in run.body(self._statements))
        except (_Raised, TemplateError):
            return  # said again where the template is rendered
        object.__setattr__(self, "trim_content", "\x00" in text and "\t\x00\t" not in text)

    def _rendered(self, contents: Mapping[str, Column], generate: bool) -> tuple[Column, Column]:
        """Text and error for messages of these roles, in this order."""
        messages = [{"role": role, "content": _Text(c.cast("string"), c.isNull())} for role, c in contents.items()]
        run = _Run(self.source, {**self.tokens, "messages": messages, "add_generation_prompt": generate})
        try:
            text = _joined(run.body(self._statements))
        except _Raised as raised:
            return F.lit(None).cast("string"), F.lit(str(raised))
        error = F.lit(None).cast("string")
        for condition, message in reversed(run.errors):
            error = F.when(condition, message).otherwise(error)
        text = _as_column(text)
        return (F.when(error.isNull(), text) if run.errors else text), error

    def prompt_or_error(self, user: Column, system: Column | None = None) -> tuple[Column, Column]:
        """`[system?] user` rendered for generation, and what the template raises for it."""
        alone = self._rendered({"user": user}, True)
        if system is None:
            return alone
        system = present(optional_text(system))
        both = self._rendered({"system": system, "user": user}, True)
        return tuple(F.when(system.isNotNull(), b).otherwise(a) for b, a in zip(both, alone, strict=True))

    def prompt(self, user: Column, system: Column | None = None) -> Column:
        """As `prompt_or_error`; an error fails the job."""
        text, error = self.prompt_or_error(user, system)
        return F.when(error.isNotNull(), F.raise_error(error).cast("string")).otherwise(text)

    def render(self, messages: Column, generate: bool = True) -> Column:
        """A messages column of the form `[system?] user [assistant?]`; others fail the job."""
        shapes = (("user",), ("system", "user"), ("user", "assistant"), ("system", "user", "assistant"))
        roles = F.array_join(F.transform(messages, lambda m: m["role"]), " ")
        rendered = F.raise_error(F.concat(F.lit("No rendering for the roles "), roles)).cast("string")
        for shape in shapes:
            contents = {role: F.get(messages, F.lit(i))["content"] for i, role in enumerate(shape)}
            text, error = self._rendered(contents, generate)
            checked = F.when(error.isNotNull(), F.raise_error(error).cast("string")).otherwise(text)
            rendered = F.when(roles == " ".join(shape), checked).otherwise(rendered)
        return rendered

    def pieces(self, system: Column | None = None) -> Column:
        """What is written before and after the user's content, for templates that write it once as it is."""
        mark = "\x00\x01\x00"
        text = self.prompt(F.lit(mark), system)
        pieces = F.split(text, mark)
        wrong = F.raise_error(F.lit("The template does not write the user's text once")).cast("array<string>")
        return F.when(F.size(pieces) == 2, pieces).otherwise(wrong)


def is_template(text: str | None) -> bool:
    """Whether a `chat_template` is a template rather than the name of a layout."""
    return text is not None and ("{%" in text or "{{" in text)


def template_layouts(*texts: str | None, **tokens: str) -> dict[str, ChatTemplate]:
    """Layouts for those texts that are templates, by their text; compiled once, when the job is written."""
    options = {"tokens": tokens} if tokens else {}
    found = {}
    for text in filter(is_template, texts):
        try:
            found[text] = ChatTemplate(text, **options)
        except TemplateError as error:
            raise TemplateError(f"Unknown chat layout {text!r}: {error}") from error
    return found
