"""Chat formatting by a compiled template.

The template language is a closed one: text, ``{{ value }}``, ``{% for m in messages %}``,
``{% if %}``/``{% elif %}``/``{% else %}``, ``{% set name = value %}`` and
``{% generation %}`` (the span a loss is taken on). Values are literals, names, fields
(``m.role``), ``loop.first``/``loop.index``/``loop.index0``, comparisons, ``and``, ``or``,
``not``, ``+`` and the filters ``escape``, ``trim``, ``upper``, ``lower``. There are no
calls, no attributes of Python objects and no imports, so a template can do nothing
else. It is parsed into a tree, constants are folded (joined texts, decided branches),
and every node becomes a Python closure.

The default template marks every turn, and what is generated by ``[GEN]`` and ``[/GEN]``,
so turns and loss mask are read back from the formatted text alone.

A template's control strings are escaped inside texts: a backslash goes in after the
first character of a control string, behind any backslashes already there, and
``unescape`` takes one away again, so every text survives.

Conversations stream: rows are sorted by (conv_id, turn) within a partition and rendered
one message at a time, so memory holds one message however long a conversation is. Null
texts and roles are empty; rows without conv_id form one conversation; null turns come
first, and ties of turn are ordered by role and text. Repeated rows are turns of their own.
Other columns, whatever their names, are not read; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import table

CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "[GEN]", "[/GEN]")

TEMPLATE = (
    "{% for m in messages %}<s>[INST] {{ m.role | escape }} [/INST]"
    "{% if m.role == 'assistant' %}[GEN]{% generation %}{{ m.text | escape }}{% endgeneration %}[/GEN]"
    "{% else %}{{ m.text | escape }}{% endif %}</s>{% endfor %}"
)


def _control_pattern(controls, slashes: str) -> re.Pattern:
    heads: dict[str, list[str]] = {}
    for c in controls:
        heads.setdefault(c[0], []).append(re.escape(c[1:]))
    return re.compile("|".join(f"{re.escape(h)}{slashes}(?={'|'.join(t)})" for h, t in heads.items()))


def escaper(controls=CONTROLS) -> tuple[Callable[[str], str], Callable[[str], str]]:
    """(escape, unescape) for control strings of at least two characters."""
    into, out = _control_pattern(controls, r"\\*"), _control_pattern(controls, r"\\+")
    return (lambda s: into.sub(lambda m: m.group() + "\\", s)), (lambda s: out.sub(lambda m: m.group()[:-1], s))


# --- syntax tree -------------------------------------------------------------------


@dataclass(frozen=True)
class Const:
    value: object


@dataclass(frozen=True)
class Name:
    path: tuple[str, ...]


@dataclass(frozen=True)
class Apply:
    op: str
    args: tuple


@dataclass(frozen=True)
class Text:
    value: str


@dataclass(frozen=True)
class Output:
    value: object


@dataclass(frozen=True)
class Choice:
    branches: tuple  # (condition, body) pairs; the last condition may be Const(True)


@dataclass(frozen=True)
class Loop:
    name: str
    body: tuple


@dataclass(frozen=True)
class Bind:
    name: str
    value: object


@dataclass(frozen=True)
class Generation:
    body: tuple


_TAG = re.compile(r"\{%-?\s*(.*?)\s*-?%\}|\{\{\s*(.*?)\s*\}\}|\{#.*?#\}", re.S)
_TOKEN = re.compile(r"""\s*(?:('(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(\d+)|([A-Za-z_]\w*)|(==|!=|[|.+()]))""")
FILTERS = {"trim": str.strip, "upper": str.upper, "lower": str.lower}


class TemplateError(ValueError):
    pass


def _expression(source: str):
    tokens, at = [], 0
    while source[at:].strip():
        m = _TOKEN.match(source, at)
        if not m:
            raise TemplateError(f"cannot read {source[at:]!r}")
        tokens.append(m.groups())
        at = m.end()
    tokens.append((None, None, None, "end"))
    i = 0

    def peek() -> str:
        return tokens[i][3] or tokens[i][2] or ""

    def take(word: str | None = None):
        nonlocal i
        if word and peek() != word:
            raise TemplateError(f"expected {word!r} in {source!r}")
        i += 1
        return tokens[i - 1]

    def either():
        left = both()
        while peek() == "or":
            take()
            left = Apply("or", (left, both()))
        return left

    def both():
        left = negated()
        while peek() == "and":
            take()
            left = Apply("and", (left, negated()))
        return left

    def negated():
        if peek() == "not":
            take()
            return Apply("not", (negated(),))
        left = added()
        if peek() in ("==", "!="):
            op = take()[3]
            left = Apply(op, (left, added()))
        return left

    def added():
        left = filtered()
        while peek() == "+":
            take()
            left = Apply("+", (left, filtered()))
        return left

    def filtered():
        left = atom()
        while peek() == "|":
            take()
            name = take()[2]
            if name != "escape" and name not in FILTERS:
                raise TemplateError(f"unknown filter {name!r}")
            left = Apply(name, (left,))
        return left

    def atom():
        text, number, name, sign = take()
        if text is not None:
            return Const(re.sub(r"\\(.)", lambda m: {"n": "\n", "t": "\t"}.get(m[1], m[1]), text[1:-1]))
        if number is not None:
            return Const(int(number))
        if sign == "(":
            inner = either()
            take(")")
            return inner
        if name in ("true", "false"):
            return Const(name == "true")
        if name is None:
            raise TemplateError(f"cannot read {source!r}")
        path = [name]
        while peek() == ".":
            take()
            path.append(take()[2] or "")
        return Name(tuple(path))

    tree = either()
    take("end")
    return tree


def parse(source: str) -> tuple:
    """The template's syntax tree."""
    items, at = [], 0
    for m in _TAG.finditer(source):
        if m.start() > at:
            items.append(("text", source[at : m.start()]))
        if m[1] is not None:
            items.append(("tag", m[1]))
        elif m[2] is not None:
            items.append(("out", m[2]))
        at = m.end()
    if at < len(source):
        items.append(("text", source[at:]))
    i = 0

    def body(stops: tuple[str, ...]) -> tuple:
        nonlocal i
        out = []
        while i < len(items):
            kind, value = items[i]
            word = value.split(None, 1)[0] if kind == "tag" and value else ""
            if word in stops:
                return tuple(out)
            i += 1
            if kind == "text":
                out.append(Text(value))
            elif kind == "out":
                out.append(Output(_expression(value)))
            elif word == "for":
                m = re.fullmatch(r"for\s+(\w+)\s+in\s+messages", value)
                if not m:
                    raise TemplateError(f"cannot read {value!r}")
                out.append(Loop(m[1], body(("endfor",))))
                i += 1
            elif word == "generation":
                out.append(Generation(body(("endgeneration",))))
                i += 1
            elif word == "set":
                name, _, expr = value[3:].partition("=")
                out.append(Bind(name.strip(), _expression(expr)))
            elif word == "if":
                branches, condition = [], _expression(value[2:])
                while True:
                    branches.append((condition, body(("elif", "else", "endif"))))
                    if i >= len(items):
                        raise TemplateError("if without endif")
                    stop = items[i][1]
                    i += 1
                    if stop.startswith("endif"):
                        break
                    condition = Const(True) if stop.startswith("else") else _expression(stop[4:])
                out.append(Choice(tuple(branches)))
            else:
                raise TemplateError(f"unknown tag {value!r}")
        if stops:
            raise TemplateError(f"missing {stops[-1]}")
        return tuple(out)

    return body(())


def _apply(op: str, args: list, escape):
    if op == "==":
        return args[0] == args[1]
    if op == "!=":
        return args[0] != args[1]
    if op == "not":
        return not args[0]
    if op == "+":
        return args[0] + args[1] if isinstance(args[0], type(args[1])) else f"{args[0]}{args[1]}"
    return escape(str(args[0])) if op == "escape" else FILTERS[op](str(args[0]))


def fold(node, escape):
    """The tree with constant values computed, constant branches decided and neighbouring texts joined."""
    if isinstance(node, tuple):
        out: list = []
        for x in node:
            for y in (z if isinstance(z := fold(x, escape), tuple) else (z,)):
                if isinstance(y, Text) and out and isinstance(out[-1], Text):
                    out[-1] = Text(out[-1].value + y.value)
                elif not (isinstance(y, Text) and not y.value):
                    out.append(y)
        return tuple(out)
    if isinstance(node, Apply):
        args = [fold(a, escape) for a in node.args]
        if node.op in ("and", "or"):
            if isinstance(args[0], Const):
                return args[1] if bool(args[0].value) == (node.op == "and") else args[0]
        elif all(isinstance(a, Const) for a in args):
            return Const(_apply(node.op, [a.value for a in args], escape))
        return Apply(node.op, tuple(args))
    if isinstance(node, Output):
        value = fold(node.value, escape)
        return Text(str(value.value)) if isinstance(value, Const) else Output(value)
    if isinstance(node, Choice):
        left = []
        for condition, body in node.branches:
            condition = fold(condition, escape)
            if isinstance(condition, Const):
                if condition.value:
                    left.append((condition, fold(body, escape)))
                    break
            else:
                left.append((condition, fold(body, escape)))
        if left and isinstance(left[0][0], Const):
            return left[0][1]
        return Choice(tuple(left)) if left else Text("")
    if isinstance(node, Bind):
        return Bind(node.name, fold(node.value, escape))
    if isinstance(node, Loop):
        return Loop(node.name, fold(node.body, escape))
    if isinstance(node, Generation):
        return Generation(fold(node.body, escape))
    return node


class Compiled:
    """Closures of a template: ``start``, ``message`` and ``finish`` append (text, under the mask) pieces to a list."""

    def __init__(self, source: str = TEMPLATE, controls=CONTROLS):
        self.escape, self.unescape = escaper(controls)
        self.tree = fold(parse(source), self.escape)
        loops = [i for i, n in enumerate(self.tree) if isinstance(n, Loop)]
        if len(loops) != 1:
            raise TemplateError("a template has one loop over messages at its top level")
        at = loops[0]
        self._head, self._tail = self._block(self.tree[:at]), self._block(self.tree[at + 1 :])
        self._name, self._body = self.tree[at].name, self._block(self.tree[at].body)

    def start(self, names: dict, out: list) -> None:
        self._head(names, out, False)

    def message(self, names: dict, m: dict, index: int, out: list) -> None:
        names[self._name] = m
        names["loop"] = {"first": index == 0, "index": index + 1, "index0": index}
        self._body(names, out, False)

    def finish(self, names: dict, out: list) -> None:
        self._tail(names, out, False)

    def render(self, messages) -> list[tuple[str, bool]]:
        names, out = {}, []
        self.start(names, out)
        for i, m in enumerate(messages):
            self.message(names, m, i, out)
        self.finish(names, out)
        return out

    def _value(self, node) -> Callable[[dict], object]:
        if isinstance(node, Const):
            value = node.value
            return lambda names: value
        if isinstance(node, Name):
            head, rest = node.path[0], node.path[1:]

            def look(names):
                x = names.get(head, "")
                for part in rest:
                    x = x.get(part, "") if isinstance(x, dict) else ""
                return "" if x is None else x

            return look
        args, op, escape = [self._value(a) for a in node.args], node.op, self.escape
        if op == "and":
            return lambda names: args[0](names) and args[1](names)
        if op == "or":
            return lambda names: args[0](names) or args[1](names)
        return lambda names: _apply(op, [a(names) for a in args], escape)

    def _block(self, nodes) -> Callable:
        steps = [self._step(n) for n in nodes]

        def run(names, out, mask):
            for step in steps:
                step(names, out, mask)

        return run

    def _step(self, node) -> Callable:
        if isinstance(node, Text):
            text = node.value
            return lambda names, out, mask: out.append((text, mask))
        if isinstance(node, Output):
            value = self._value(node.value)
            return lambda names, out, mask: out.append((str(value(names)), mask))
        if isinstance(node, Bind):
            name, value = node.name, self._value(node.value)
            return lambda names, out, mask: names.__setitem__(name, value(names))
        if isinstance(node, Generation):
            body = self._block(node.body)
            return lambda names, out, mask: body(names, out, True)
        if isinstance(node, Choice):
            branches = [(self._value(c), self._block(b)) for c, b in node.branches]

            def choose(names, out, mask):
                for condition, body in branches:
                    if condition(names):
                        return body(names, out, mask)

            return choose
        raise TemplateError("loops over messages don't nest")


_TURN = re.compile(r"<s>\[INST\] (.*?) \[/INST\](\[GEN\])?(.*?)(?(2)\[/GEN\])</s>", re.S)


class Reader:
    """Reads formatted text with the marks of TEMPLATE back into digests, from the text alone, as it comes; what lies between turns counts as characters only."""

    def __init__(self, unescape):
        self.unescape = unescape
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = 0
        self.rest = ""  # begun but not ended

    def feed(self, text: str) -> None:
        self.chars += len(text)
        self.rest += text
        end = 0
        for m in _TURN.finditer(self.rest):
            end = m.end()
            said = self.unescape(m[3])
            self.turns.update(f"{self.unescape(m[1])}\n{said}\n".encode())
            self.n_turns += 1
            if m[2]:
                self.loss.update(said.encode())
                self.loss_chars += len(said)
        self.rest = self.rest[end:]

    def row(self, conv) -> tuple:
        return conv, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def _stream(batches, each: Callable[[Compiled, object, Iterator], Iterator], source: str, controls) -> Iterator:
    compiled = Compiled(source, controls)
    rows = ((c, r or "", t or "") for b in batches for c, r, t in zip(*(b.column(i).to_pylist() for i in (0, 1, 2)), strict=True))
    yield from each(compiled, rows)


def _sorted(conversations: DataFrame) -> DataFrame:
    rows = conversations.selectExpr("cast(conv_id as long) conv_id", "cast(role as string) role", "cast(text as string) text", "cast(turn as long) turn")
    order = ("conv_id", "turn", "role", "text")
    return rows.repartition("conv_id").sortWithinPartitions(*order).select("conv_id", "role", "text")


_DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def digests(conversations: DataFrame, source: str = TEMPLATE, controls=CONTROLS) -> DataFrame:
    """Format every conversation and read the formatted text back: counts and digests, one row a conversation. The template has the marks of TEMPLATE."""

    def each(compiled, rows):
        reader, conv, index, names, out = None, None, 0, {}, []

        def ended():
            pieces: list = []
            compiled.finish(names, pieces)
            reader.feed("".join(p for p, _ in pieces))
            return reader.row(conv)

        for c, role, text in rows:
            if reader is None or c != conv:
                if reader is not None:
                    out.append(ended())
                    if len(out) == 4096:
                        yield out
                        out = []
                reader, conv, index, names = Reader(compiled.unescape), c, 0, {}
                pieces: list = []
                compiled.start(names, pieces)
                reader.feed("".join(p for p, _ in pieces))
            pieces = []
            compiled.message(names, {"role": role, "text": text}, index, pieces)
            reader.feed("".join(p for p, _ in pieces))
            index += 1
        if reader is not None:
            out.append(ended())
        if out:
            yield out

    def run(batches):
        for out in _stream(batches, each, source, controls):
            columns = list(zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string() if i in (2, 4) else pa.int64()) for i, c in enumerate(columns)], names=[x.split()[0] for x in _DIGEST.split(", ")])

    return _sorted(conversations).mapInArrow(run, _DIGEST)


_PIECE = "conv_id long, turn_index long, text string, loss array<struct<start:int,end:int>>"


def formatted(conversations: DataFrame, source: str = TEMPLATE, controls=CONTROLS) -> DataFrame:
    """The formatted text of every message in order (joined, that of the conversation), with the spans under the loss mask in code points; the template's head is of the first message, its tail of the last."""

    def each(compiled, rows):
        conv, index, names, pieces = None, -1, {}, []

        def row():
            at, spans = 0, []
            for p, mask in pieces:
                if mask:
                    spans.append({"start": at, "end": at + len(p)})
                at += len(p)
            return conv, index, "".join(p for p, _ in pieces), spans

        for c, role, text in rows:
            if index >= 0 and c == conv:
                yield row()
                index, pieces = index + 1, []
            else:
                if index >= 0:
                    compiled.finish(names, pieces)
                    yield row()
                conv, index, names, pieces = c, 0, {}, []
                compiled.start(names, pieces)
            compiled.message(names, {"role": role, "text": text}, index, pieces)
        if index >= 0:
            compiled.finish(names, pieces)
            yield row()

    def run(batches):
        rows: list = []
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))]

        def out():
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["conv_id", "turn_index", "text", "loss"])

        for row in _stream(batches, each, source, controls):
            rows.append(row)
            if len(rows) == 2048:
                yield out()
                rows.clear()
        if rows:
            yield out()

    return _sorted(conversations).mapInArrow(run, _PIECE)


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").selectExpr("cast(conv_id as long) conv_id", "cast(turn as long) turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    return digests(given.unionByName(probe))
