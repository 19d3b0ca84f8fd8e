"""Chat formatting by a template compiler.

A template is text with ``{{ expression }}`` and the tags ``for``, ``if``, ``elif``, ``else``, ``set`` and ``generation``.
It is parsed into a syntax tree, constant parts are folded, and the tree becomes Python closures. Expressions know names,
text and whole numbers, fields of a message, ``loop.first``, ``loop.index``, comparison, ``and``, ``or``, ``not``, ``in``,
``+`` and ``~``, and the listed filters; nothing else can be reached, so a template cannot run code. What stands between
``generation`` and ``endgeneration`` is marked as the part that a model learns.

The default template marks turns by control strings; the filter ``escape`` breaks up such strings inside texts and can
be undone, so conversations can be read back from the output alone.

A template whose messages are rendered one after another needs no whole conversation in memory: ``segments`` renders
each row by itself, and the formatted conversation is its segments in order.

Defined cases: null roles and texts are empty; equal turn numbers are ordered by role, then text; a null conversation id
is a conversation of its own; repeated rows are repeated turns; an empty table has no conversations. A text of any length
is one turn, rendered whole; a conversation of any number of turns is read back one turn at a time, in one task. Other
columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CONTROL = ("<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
CHATML = (
    "{% for m in messages %}{{ '<|im_start|>' ~ m.role|escape_line }}\n"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text|escape }}{% endgeneration %}{% else %}{{ m.text|escape }}{% endif %}"
    "<|im_end|>\n{% endfor %}"
)

_BREAK = re.compile("|".join([r"\\", *(rf"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in CONTROL)]))
_JOIN = re.compile(r"\\(.)", re.S)


def escape(text: str) -> str:
    """No control string is left in the result; ``unescape`` gives the text back."""
    return _BREAK.sub(lambda m: m[0] + "\\", text)


def escape_line(text: str) -> str:
    """As ``escape``, with every line end behind a backslash."""
    return escape(text).replace("\n", "\\\n")


def unescape(text: str) -> str:
    return _JOIN.sub(r"\1", text)


FILTERS: dict[str, Callable[[str], str]] = {
    "escape": escape,
    "escape_line": escape_line,
    "trim": lambda v: v.strip(" \t\r\n"),
    "upper": lambda v: v.upper(),
    "lower": lambda v: v.lower(),
}


class TemplateError(ValueError):
    """The template is not in the language."""


# --- syntax tree -------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Const:
    value: Any


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Field:
    of: Any
    name: str


@dataclass(frozen=True)
class Apply:
    """An operator or a filter over its arguments."""

    op: str
    args: tuple


@dataclass(frozen=True)
class Emit:
    value: Any


@dataclass(frozen=True)
class Assign:
    name: str
    value: Any


@dataclass(frozen=True)
class Choice:
    #: (condition, body) in order; the condition of ``else`` is Const(True)
    cases: tuple


@dataclass(frozen=True)
class Loop:
    name: str
    over: Any
    body: tuple


@dataclass(frozen=True)
class Generation:
    body: tuple


_LEXEME = re.compile(r"\s*(?:(\d+)|'((?:[^'\\]|\\.)*)'|\"((?:[^\"\\]|\\.)*)\"|([A-Za-z_]\w*)|(==|!=|<=|>=|[-+~|.()\[\]<>]))")
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}
_OPS = {
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "<": lambda a, b: a < b,
    ">": lambda a, b: a > b,
    "<=": lambda a, b: a <= b,
    ">=": lambda a, b: a >= b,
    "in": lambda a, b: a in b,
    "+": lambda a, b: a + b,
    "-": lambda a, b: a - b,
    "~": lambda a, b: f"{a}{b}",
    "not": lambda a: not a,
}


class _Expression:
    """Recursive descent over one expression."""

    def __init__(self, source: str):
        self.tokens, at = [], 0
        source = source.rstrip()
        while at < len(source):
            m = _LEXEME.match(source, at)
            if not m:
                raise TemplateError(f"cannot read {source[at:]!r}")
            number, single, double, word, sign = m.groups()
            if number is not None:
                self.tokens.append(("const", int(number)))
            elif word is not None:
                self.tokens.append(("word", word))
            elif sign is not None:
                self.tokens.append(("sign", sign))
            else:
                raw = single if single is not None else double
                self.tokens.append(("const", re.sub(r"\\(.)", lambda e: _ESCAPES.get(e[1], e[1]), raw, flags=re.S)))
            at = m.end()
        self.at = 0

    def _peek(self, *values: str) -> bool:
        return self.at < len(self.tokens) and self.tokens[self.at][0] != "const" and self.tokens[self.at][1] in values

    def _take(self) -> tuple[str, Any]:
        if self.at == len(self.tokens):
            raise TemplateError("an expression ends too early")
        self.at += 1
        return self.tokens[self.at - 1]

    def _need(self, value: str) -> None:
        if not self._peek(value):
            raise TemplateError(f"{value!r} is missing")
        self.at += 1

    def whole(self) -> Any:
        out = self._chain(("or",), lambda: self._chain(("and",), self._negation))
        if self.at != len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return out

    def _chain(self, ops: tuple[str, ...], below: Callable[[], Any]) -> Any:
        left = below()
        while self._peek(*ops):
            left = Apply(self._take()[1], (left, below()))
        return left

    def _negation(self) -> Any:
        if self._peek("not"):
            self.at += 1
            return Apply("not", (self._negation(),))
        joined = lambda: self._chain(("~",), lambda: self._chain(("+", "-"), self._postfix))
        return self._chain(("==", "!=", "<", ">", "<=", ">=", "in"), joined)

    def _postfix(self) -> Any:
        kind, value = self._take()
        if kind == "const":
            out: Any = Const(value)
        elif kind == "word":
            if value in ("and", "or", "not", "in"):
                raise TemplateError(f"unexpected {value!r}")
            out = Const({"true": True, "false": False}[value]) if value in ("true", "false") else Name(value)
        elif value == "(":
            out = self._chain(("or",), lambda: self._chain(("and",), self._negation))
            self._need(")")
        else:
            raise TemplateError(f"unexpected {value!r}")
        while self._peek(".", "[", "|"):
            sign = self._take()[1]
            kind, name = self._take()
            if sign == "|":
                if name not in FILTERS:
                    raise TemplateError(f"no filter {name!r}")
                out = Apply(f"|{name}", (out,))
                continue
            if not isinstance(name, str) or name.startswith("_"):
                raise TemplateError(f"no field {name!r}")
            out = Field(out, name)
            if sign == "[":
                self._need("]")
        return out


_TAG = re.compile(r"\{\{(-?)(.*?)(-?)\}\}|\{%(-?)\s*(\w+)(.*?)(-?)%\}|\{#.*?#\}", re.S)


def parse(source: str) -> tuple:
    """The syntax tree of a template."""
    pieces: list[tuple[str, str]] = []
    at, cut = 0, False
    for m in _TAG.finditer(source):
        text = source[at : m.start()]
        text = text.lstrip() if cut else text
        text = text.rstrip() if m[1] or m[4] else text
        pieces.append(("text", text))
        if m[2] is not None:
            pieces.append(("emit", m[2]))
        elif m[5]:
            pieces.append((m[5], m[6].strip()))
        at, cut = m.end(), bool(m[3] or m[7])
    pieces.append(("text", source[at:].lstrip() if cut else source[at:]))
    pieces = [p for p in pieces if p != ("text", "")]
    body, rest = _block(pieces, 0, ())
    if rest != len(pieces):
        raise TemplateError(f"unexpected tag {pieces[rest][0]!r}")
    return body


def _block(pieces: list[tuple[str, str]], at: int, ends: tuple[str, ...]) -> tuple[tuple, int]:
    out: list[Any] = []
    while at < len(pieces):
        kind, value = pieces[at]
        if kind in ends:
            return tuple(out), at
        at += 1
        if kind == "text":
            out.append(Emit(Const(value)))
        elif kind == "emit":
            out.append(Emit(_Expression(value).whole()))
        elif kind == "set":
            m = re.fullmatch(r"([A-Za-z]\w*)\s*=(?!=)(.*)", value, re.S)
            if not m:
                raise TemplateError(f"cannot read set {value!r}")
            out.append(Assign(m[1], _Expression(m[2]).whole()))
        elif kind == "for":
            m = re.fullmatch(r"([A-Za-z]\w*)\s+in\s+(.*)", value, re.S)
            if not m:
                raise TemplateError(f"cannot read for {value!r}")
            body, at = _block(pieces, at, ("endfor",))
            out.append(Loop(m[1], _Expression(m[2]).whole(), body))
            at = _past(pieces, at, "endfor")
        elif kind == "generation":
            body, at = _block(pieces, at, ("endgeneration",))
            out.append(Generation(body))
            at = _past(pieces, at, "endgeneration")
        elif kind == "if":
            cases, test = [], _Expression(value).whole()
            while True:
                body, at = _block(pieces, at, ("elif", "else", "endif"))
                cases.append((test, body))
                if at == len(pieces):
                    raise TemplateError("endif is missing")
                kind, value = pieces[at]
                at += 1
                if kind == "endif":
                    break
                test = Const(True) if kind == "else" else _Expression(value).whole()
            out.append(Choice(tuple(cases)))
        else:
            raise TemplateError(f"no tag {kind!r}")
    if ends:
        raise TemplateError(f"{ends[0]} is missing")
    return tuple(out), at


def _past(pieces: list[tuple[str, str]], at: int, end: str) -> int:
    if at == len(pieces):
        raise TemplateError(f"{end} is missing")
    return at + 1


def fold(node: Any) -> Any:
    """The tree with constant expressions worked out, settled choices taken and neighbouring texts joined."""
    if isinstance(node, tuple):
        out: list[Any] = []
        for x in map(fold, node):
            if isinstance(x, Choice) and x.cases and isinstance(x.cases[0][0], Const):
                more = x.cases[0][1] if x.cases[0][0].value else ()
            elif isinstance(x, Choice) and not x.cases:
                more = ()
            else:
                more = (x,)
            for y in more:
                if isinstance(y, Emit) and isinstance(y.value, Const):
                    y = Emit(Const(_shown(y.value.value)))
                    if out and isinstance(out[-1], Emit) and isinstance(out[-1].value, Const):
                        out[-1] = Emit(Const(out[-1].value.value + y.value.value))
                        continue
                out.append(y)
        return tuple(x for x in out if x != Emit(Const("")))
    if isinstance(node, Apply):
        args = tuple(map(fold, node.args))
        if all(isinstance(a, Const) for a in args):
            return Const(_function(Apply(node.op, args))({}))
        return Apply(node.op, args)
    if isinstance(node, Field):
        return Field(fold(node.of), node.name)
    if isinstance(node, Emit):
        return Emit(fold(node.value))
    if isinstance(node, Assign):
        return Assign(node.name, fold(node.value))
    if isinstance(node, Loop):
        return Loop(node.name, fold(node.over), fold(node.body))
    if isinstance(node, Generation):
        return Generation(fold(node.body))
    if isinstance(node, Choice):
        cases = []
        for test, body in ((fold(t), fold(b)) for t, b in node.cases):
            if isinstance(test, Const) and not test.value:
                continue
            cases.append((test, body))
            if isinstance(test, Const):
                break
        return Choice(tuple(cases))
    return node


def _shown(value: Any) -> str:
    return "" if value is None else str(value)


def _function(node: Any) -> Callable[[dict], Any]:
    """A closure that gives the value of an expression."""
    if isinstance(node, Const):
        return lambda scope, v=node.value: v
    if isinstance(node, Name):
        return lambda scope, k=node.name: scope.get(k)
    if isinstance(node, Field):
        of = _function(node.of)

        def field_of(scope: dict, k: str = node.name) -> Any:
            value = of(scope)
            return value.get(k) if isinstance(value, dict) else None

        return field_of
    args = [_function(a) for a in node.args]
    if node.op == "and":
        return lambda scope: args[0](scope) and args[1](scope)
    if node.op == "or":
        return lambda scope: args[0](scope) or args[1](scope)
    if node.op.startswith("|"):
        apply = FILTERS[node.op[1:]]
        return lambda scope: apply(_shown(args[0](scope)))
    op = _OPS[node.op]
    if len(args) == 1:
        return lambda scope: op(args[0](scope))
    return lambda scope: op(args[0](scope), args[1](scope))


@dataclass
class Output:
    """What is rendered so far: its parts, its length, and the spans (code points) that a model learns."""

    parts: list[str] = field(default_factory=list)
    size: int = 0
    spans: list[tuple[int, int]] = field(default_factory=list)

    def add(self, text: str) -> None:
        self.parts.append(text)
        self.size += len(text)


def _writer(body: tuple) -> Callable[[dict, Output], None]:
    """A closure that renders a list of nodes."""
    steps = [_step(x) for x in body]

    def write(scope: dict, out: Output) -> None:
        for s in steps:
            s(scope, out)

    return write


def _step(node: Any) -> Callable[[dict, Output], None]:
    if isinstance(node, Emit):
        if isinstance(node.value, Const):
            return lambda scope, out, v=node.value.value: out.add(v)
        value = _function(node.value)
        return lambda scope, out: out.add(_shown(value(scope)))
    if isinstance(node, Assign):
        value = _function(node.value)
        return lambda scope, out, k=node.name: scope.__setitem__(k, value(scope))
    if isinstance(node, Generation):
        write = _writer(node.body)

        def marked(scope: dict, out: Output) -> None:
            start = out.size
            write(scope, out)
            out.spans.append((start, out.size))

        return marked
    if isinstance(node, Loop):
        over, write = _function(node.over), _writer(node.body)

        def loop(scope: dict, out: Output, k: str = node.name) -> None:
            for i, item in enumerate(over(scope) or ()):
                write(scope | {k: item, "loop": {"first": i == 0, "index": i + 1, "index0": i}}, out)

        return loop
    cases = [(_function(t), _writer(b)) for t, b in node.cases]

    def choose(scope: dict, out: Output) -> None:
        for test, write in cases:
            if test(scope):
                write(scope, out)
                return

    return choose


class Template:
    """A compiled template. ``messages`` are dicts with ``role`` and ``text``."""

    def __init__(self, source: str):
        self.tree = fold(parse(source))
        self._write = _writer(self.tree)
        loops = [i for i, x in enumerate(self.tree) if isinstance(x, Loop)]
        #: Rendered message by message: before the only loop, the loop, after it.
        self.by_turn = len(loops) == 1 and not any(isinstance(x, Assign) for x in self.tree)
        if self.by_turn:
            i = loops[0]
            self.by_turn = self.tree[i].over == Name("messages") and "messages" not in repr(self.tree[i].body)
            self._before, self._after = _writer(self.tree[:i]), _writer(self.tree[i + 1 :])
            self._turn = _step(Loop(self.tree[i].name, Name("messages"), self.tree[i].body))
            self._name, self._body = self.tree[i].name, _writer(self.tree[i].body)

    def render(self, messages: list[dict]) -> tuple[str, list[tuple[int, int]]]:
        out = Output()
        self._write({"messages": messages}, out)
        return "".join(out.parts), out.spans

    def segment(self, message: dict, index: int, last: bool) -> tuple[str, list[tuple[int, int]]]:
        """One message's part of the conversation, with what stands before the first and after the last."""
        if not self.by_turn:
            raise TemplateError("the template needs whole conversations")
        out = Output()
        if index == 0:
            self._before({}, out)
        self._body({self._name: message, "loop": {"first": index == 0, "index": index + 1, "index0": index}}, out)
        if last:
            self._after({}, out)
        return "".join(out.parts), out.spans


# --- reading back ------------------------------------------------------------------------------------------------

_TURN = re.compile(r"<\|im_start\|>((?:[^\\\n]|\\.)*+)\n(.*?)<\|im_end\|>\n", re.S)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a conversation in the default template."""
    out, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if not m:
            raise ValueError(f"not a turn at {at}: {formatted[at : at + 60]!r}")
        out.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    return out


# --- on tables ---------------------------------------------------------------------------------------------------


def segments(turns: DataFrame, template: str = CHATML) -> DataFrame:
    """Columns ``conv_id``, ``position`` (from 0), ``formatted`` and ``spans`` (code points in ``formatted``), one row per
    turn. The conversation is its segments in order."""
    spec = Template(template)
    if not spec.by_turn:
        raise TemplateError("the template needs whole conversations")
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = turns.select(
        "conv_id",
        F.col("turn").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).select(
        "conv_id",
        (F.row_number().over(order).cast("long") - 1).alias("position"),
        F.lead(F.lit(True)).over(order).isNull().alias("last"),
        "role",
        "text",
    )
    kind = rows.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            position, last, role, text = (batch.column(i).to_pylist() for i in range(1, 5))
            made = [spec.segment({"role": r, "text": t}, p, e) for p, e, r, t in zip(position, last, role, text)]
            spans = [[{"start": a, "end": b} for a, b in s] for _, s in made]
            pair = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            arrays = [batch.column(0), batch.column(1), pa.array([f for f, _ in made], pa.string()), pa.array(spans, pair)]
            yield pa.RecordBatch.from_arrays(arrays, ["conv_id", "position", "formatted", "spans"])

    schema = f"conv_id {kind}, position bigint, formatted string, spans array<struct<start: bigint, end: bigint>>"
    return rows.mapInArrow(run, schema)


def digests(parts: DataFrame) -> DataFrame:
    """What is read back from segments in the default template: counts and checksums of each conversation. A task reads a
    conversation's segments in order and holds one at a time."""
    kind = parts.schema["conv_id"].dataType.simpleString()
    dealt = parts.repartition("conv_id").sortWithinPartitions("conv_id", "position")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = object()
        conv, state = none, None

        def row() -> tuple:
            n, turns, chars, loss, size = state
            return (conv, n, turns.hexdigest(), chars, loss.hexdigest(), size)

        for batch in batches:
            done = []
            columns = (batch.column(batch.schema.names.index(c)).to_pylist() for c in ("conv_id", "formatted", "spans"))
            for key, formatted, spans in zip(*columns):
                if key != conv or conv is none:
                    if conv is not none:
                        done.append(row())
                    conv, state = key, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text in read_turns(formatted):
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode())
                for span in spans:
                    text = unescape(formatted[span["start"] : span["end"]])
                    state[2] += len(text)
                    state[3].update(text.encode())
                state[4] += len(formatted)
            if done:
                yield _digest_batch(done, batch.schema.field("conv_id").type)
        if conv is not none:
            yield _digest_batch([row()], dealt_type)

    from pyspark.sql.pandas.types import to_arrow_type

    dealt_type = to_arrow_type(parts.schema["conv_id"].dataType)
    schema = f"conv_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    return dealt.mapInArrow(run, schema)


def _digest_batch(rows: list[tuple], key: pa.DataType) -> pa.RecordBatch:
    types = [key, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
