"""Chat formatting by a compiled template.

A small sandboxed template language is parsed into a syntax tree, constants are folded, and the tree
becomes nested Python closures that write a conversation's text piece by piece, with the places of
its generation markers (what a loss mask keeps).

The language: `{{ expression }}`, `{% for x in list %}..{% endfor %}` (with loop.index0 and
loop.first), `{% if %}..{% elif %}..{% else %}..{% endif %}`, `{% set x = expression %}`,
`{% generation %}..{% endgeneration %}`, `{# comment #}`. Expressions: strings, whole numbers, true,
false, none, names, `a.b` and `a['b']` (keys of dictionaries only, never Python attributes),
`+ ~ == != < <= > >= and or not in`, `a if c else b`, parentheses, and filters `| escape`, `| escape_line`,
`| trim`, `| upper`, `| lower`, `| length`, `| default(x)`. There is no call, import or attribute access,
and loops run over given lists only, so a template always ends.

Escaping is reversible: `\\` becomes `\\\\`, each control string gets `\\0` after its first character,
and `escape_line` also turns a line feed into `\\n`. No control string is left inside an escaped text.

Defined results: null text and null role are empty; turns are ordered by turn, then role, then text
(nulls first), so ties and repeated rows have one order; rows with a null conv_id form one
conversation; other columns are ignored; an empty table gives an empty result. A conversation is
written turn by turn, so one with very many turns needs no more memory than its longest turn.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Strings that mean something to the models that read the output.
CONTROL = ("<|im_start|>", "<|im_end|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|endoftext|>")
_SPECIAL = re.compile("|".join(map(re.escape, ("\\", *CONTROL))))
_ESCAPED = re.compile(r"\\([\\0n])")


def escape(text: str) -> str:
    return _SPECIAL.sub(lambda m: "\\\\" if m[0] == "\\" else f"{m[0][0]}\\0{m[0][1:]}", text)


def escape_line(text: str) -> str:
    return escape(text).replace("\n", "\\n")


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: {"\\": "\\", "0": "", "n": "\n"}[m[1]], text)


TEMPLATE = """{#- one block a turn; what the assistant says is under the loss mask -#}
{%- for message in messages -%}
{{ '<|im_start|>' + (message.role | escape_line) + '\\n' }}
{%- if message.role == 'assistant' -%}
{% generation %}{{ message.text | escape }}{% endgeneration %}
{%- else -%}
{{ message.text | escape }}
{%- endif -%}
{{ '<|im_end|>' + '\\n' }}
{%- endfor -%}"""


class TemplateError(ValueError):
    """The template is not in the language."""


# ---- syntax tree ------------------------------------------------------------------------------


@dataclass(frozen=True)
class Const:
    value: Any


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Key:
    of: Any
    key: Any


@dataclass(frozen=True)
class Op:
    op: str
    args: tuple


@dataclass(frozen=True)
class Filter:
    name: str
    args: tuple


@dataclass(frozen=True)
class Out:
    value: Any


@dataclass(frozen=True)
class For:
    name: str
    over: Any
    body: tuple


@dataclass(frozen=True)
class If:
    test: Any
    body: tuple
    other: tuple


@dataclass(frozen=True)
class Set:
    name: str
    value: Any


@dataclass(frozen=True)
class Generation:
    body: tuple


def _text(value: Any) -> str:
    return "" if value is None else ("true" if value else "false") if isinstance(value, bool) else str(value)


def _key(of: Any, key: Any) -> Any:
    if not isinstance(of, dict):
        raise TemplateError("only dictionaries have keys")
    return of.get(key)


OPERATORS: dict[str, Callable] = {
    "+": lambda a, b: _text(a) + _text(b) if isinstance(a, str) or isinstance(b, str) else a + b,
    "~": lambda a, b: _text(a) + _text(b),
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
    "in": lambda a, b: a in b,
    "not": lambda a: not a,
}
FILTERS: dict[str, Callable] = {
    "escape": lambda x: escape(_text(x)),
    "escape_line": lambda x: escape_line(_text(x)),
    "trim": lambda x: _text(x).strip(),
    "upper": lambda x: _text(x).upper(),
    "lower": lambda x: _text(x).lower(),
    "length": len,
    "default": lambda x, y: y if x is None else x,
}
_PARTS = re.compile(r"(\{#.*?#\}|\{%.*?%\}|\{\{.*?\}\})", re.S)
_LEXEME = re.compile(r"\s*(?:(?P<number>\d+)|(?P<string>'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(?P<name>[A-Za-z]\w*)|(?P<sign>==|!=|<=|>=|[+~<>().|,\[\]]))", re.S)


class _Expression:
    """Precedence-climbing parser of one expression."""

    LEVELS = (("or",), ("and",), ("==", "!=", "<", "<=", ">", ">=", "in"), ("+", "~"))

    def __init__(self, source: str) -> None:
        self.lexemes: list[tuple[str, str]] = []
        place, source = 0, source.rstrip()
        while place < len(source):
            m = _LEXEME.match(source, place)
            if not m:
                raise TemplateError(f"unexpected {source[place:place + 10]!r}")
            self.lexemes.append((m.lastgroup or "", m[m.lastgroup or 0]))
            place = m.end()
        self.at = 0

    def peek(self) -> str:
        kind, value = self.lexemes[self.at] if self.at < len(self.lexemes) else ("", "")
        return "" if kind == "string" else value

    def take(self, wanted: str) -> bool:
        if self.peek() == wanted:
            self.at += 1
            return True
        return False

    def need(self, wanted: str) -> None:
        if not self.take(wanted):
            raise TemplateError(f"{wanted!r} expected")

    def whole(self) -> Any:
        value = self.choice()
        if self.at < len(self.lexemes):
            raise TemplateError(f"unexpected {self.lexemes[self.at][1]!r}")
        return value

    def choice(self) -> Any:
        value = self.binary(0)
        if self.take("if"):
            test = self.binary(0)
            self.need("else")
            return Op("if", (test, value, self.choice()))
        return value

    def binary(self, level: int) -> Any:
        if level == len(self.LEVELS):
            return self.filtered()
        if level == 2 and self.take("not"):
            return Op("not", (self.binary(2),))
        left = self.binary(level + 1)
        while (op := self.peek()) in self.LEVELS[level]:
            self.at += 1
            left = Op(op, (left, self.binary(level + 1)))
        return left

    def filtered(self) -> Any:
        value = self.single()
        while self.take("|"):
            name, args = self.name(), [value]
            if name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            if self.take("("):
                args.append(self.choice())
                self.need(")")
            value = Filter(name, tuple(args))
        return value

    def name(self) -> str:
        kind, value = self.lexemes[self.at] if self.at < len(self.lexemes) else ("", "")
        if kind != "name":
            raise TemplateError("a name expected")
        self.at += 1
        return value

    def single(self) -> Any:
        if self.take("("):
            value = self.choice()
            self.need(")")
        else:
            kind, word = self.lexemes[self.at] if self.at < len(self.lexemes) else ("", "")
            self.at += 1
            if kind == "number":
                value = Const(int(word))
            elif kind == "string":
                value = Const(re.sub(r"\\(.)", lambda m: {"n": "\n", "t": "\t"}.get(m[1], m[1]), word[1:-1], flags=re.S))
            elif kind == "name":
                value = Const({"true": True, "false": False, "none": None}[word]) if word in ("true", "false", "none") else Name(word)
            else:
                raise TemplateError(f"unexpected {word!r}")
        while True:
            if self.take("."):
                value = Key(value, Const(self.name()))
            elif self.take("["):
                value = Key(value, self.choice())
                self.need("]")
            else:
                return value


def parse(template: str) -> tuple:
    """The syntax tree: a tuple of statements."""
    parts = _PARTS.split(template)
    for i in range(1, len(parts), 2):  # a minus sign inside a tag drops the white space beside it
        if parts[i][2:3] == "-":
            parts[i - 1] = parts[i - 1].rstrip()
        if parts[i][-3:-2] == "-":
            parts[i + 1] = parts[i + 1].lstrip()
    tags = iter([(i % 2, part) for i, part in enumerate(parts)])

    def block(*ends: str) -> tuple[tuple, str]:
        body: list = []
        for is_tag, part in tags:
            if not is_tag:
                if part:
                    body.append(Out(Const(part)))
                continue
            inner = part[2:-2].strip("-").strip()
            if part.startswith("{#"):
                continue
            if part.startswith("{{"):
                body.append(Out(_Expression(inner).whole()))
                continue
            word, _, rest = inner.partition(" ")
            if word in ends:
                return tuple(body), inner
            if word == "for" and (m := re.fullmatch(r"([A-Za-z]\w*) in (.+)", rest.strip(), re.S)):
                body.append(For(m[1], _Expression(m[2]).whole(), block("endfor")[0]))
            elif word == "if":
                body.append(branch(rest))
            elif word == "set" and (m := re.fullmatch(r"([A-Za-z]\w*)\s*=(.+)", rest.strip(), re.S)):
                body.append(Set(m[1], _Expression(m[2]).whole()))
            elif word == "generation":
                body.append(Generation(block("endgeneration")[0]))
            else:
                raise TemplateError(f"unexpected tag {inner!r}")
        if ends:
            raise TemplateError(f"{ends[-1]!r} expected")
        return tuple(body), ""

    def branch(test: str) -> If:
        body, end = block("elif", "else", "endif")
        other: tuple = ()
        if end.startswith("elif"):
            other = (branch(end[4:]),)
        elif end == "else":
            other = block("endif")[0]
        return If(_Expression(test).whole(), body, other)

    return block()[0]


def fold(node: Any) -> Any:
    """Constants computed once: operations and filters on constants, branches that are decided, and
    constant outputs that stand side by side."""
    if isinstance(node, tuple):
        out: list = []
        for x in map(fold, node):
            if isinstance(x, If) and isinstance(x.test, Const):
                more: tuple = x.body if x.test.value else x.other
            elif isinstance(x, Out) and isinstance(x.value, Op) and x.value.op in ("+", "~") and _is_text(x.value):
                more = tuple(map(Out, x.value.args))  # the parts are written one after the other
                more = fold(more)
            else:
                more = (x,)
            for y in more:
                if out and isinstance(y, Out) and isinstance(y.value, Const) and isinstance(out[-1], Out) and isinstance(out[-1].value, Const):
                    out[-1] = Out(Const(_text(out[-1].value.value) + _text(y.value.value)))
                else:
                    out.append(y)
        return tuple(out)
    if isinstance(node, Op):
        args = tuple(map(fold, node.args))
        if node.op in OPERATORS and all(isinstance(a, Const) for a in args):
            return Const(OPERATORS[node.op](*(a.value for a in args)))
        if node.op in ("and", "or", "if") and isinstance(args[0], Const):
            first = args[0].value
            return args[1 if first else 2] if node.op == "if" else args[1] if bool(first) == (node.op == "and") else args[0]
        return Op(node.op, args)
    if isinstance(node, Filter):
        args = tuple(map(fold, node.args))
        return Const(FILTERS[node.name](*(a.value for a in args))) if all(isinstance(a, Const) for a in args) else Filter(node.name, args)
    if isinstance(node, Key):
        return Key(fold(node.of), fold(node.key))
    if isinstance(node, Out):
        return Out(fold(node.value))
    if isinstance(node, For):
        return For(node.name, fold(node.over), fold(node.body))
    if isinstance(node, If):
        return If(fold(node.test), fold(node.body), fold(node.other))
    if isinstance(node, Set):
        return Set(node.name, fold(node.value))
    if isinstance(node, Generation):
        return Generation(fold(node.body))
    return node


def _is_text(node: Any) -> bool:
    """Whether an expression always gives text, so that + joins texts."""
    return isinstance(node, Const) and isinstance(node.value, str) or isinstance(node, Filter) and node.name in ("escape", "escape_line", "trim", "upper", "lower") or isinstance(node, Op) and (node.op == "~" or node.op == "+" and any(map(_is_text, node.args)))


# ---- closures ---------------------------------------------------------------------------------

#: ("text", piece) | ("start", "") | ("end", "") of a generation
Event = tuple[str, str]


def _value(node: Any) -> Callable[[dict], Any]:
    if isinstance(node, Const):
        constant = node.value
        return lambda env: constant
    if isinstance(node, Name):
        name = node.name
        return lambda env: env.get(name)
    if isinstance(node, Key):
        of, key = _value(node.of), _value(node.key)
        return lambda env: _key(of(env), key(env))
    args = [_value(a) for a in node.args]
    if isinstance(node, Op) and node.op == "and":
        return lambda env: args[0](env) and args[1](env)
    if isinstance(node, Op) and node.op == "or":
        return lambda env: args[0](env) or args[1](env)
    if isinstance(node, Op) and node.op == "if":
        return lambda env: args[1](env) if args[0](env) else args[2](env)
    function = OPERATORS[node.op] if isinstance(node, Op) else FILTERS[node.name]
    if len(args) == 1:
        return lambda env: function(args[0](env))
    return lambda env: function(args[0](env), args[1](env))


def _writer(node: Any) -> Callable[[dict], Iterator[Event]]:
    if isinstance(node, tuple):
        writers = [_writer(x) for x in node]

        def every(env: dict) -> Iterator[Event]:
            for write in writers:
                yield from write(env)

        return every
    if isinstance(node, Out):
        value = _value(node.value)

        def out(env: dict) -> Iterator[Event]:
            yield "text", _text(value(env))

        return out
    if isinstance(node, Generation):
        body = _writer(node.body)

        def generation(env: dict) -> Iterator[Event]:
            yield "start", ""
            yield from body(env)
            yield "end", ""

        return generation
    if isinstance(node, If):
        test, body, other = _value(node.test), _writer(node.body), _writer(node.other)
        return lambda env: body(env) if test(env) else other(env)
    if isinstance(node, For):
        name, over, body = node.name, _value(node.over), _writer(node.body)

        def loop(env: dict) -> Iterator[Event]:
            for i, item in enumerate(over(env) or ()):
                yield from body(env | {name: item, "loop": {"index0": i, "first": i == 0}})

        return loop
    if isinstance(node, Set):
        name, value = node.name, _value(node.value)

        def put(env: dict) -> Iterator[Event]:
            env[name] = value(env)
            return iter(())

        return put
    raise TemplateError(f"no statement: {node!r}")


def compiled(template: str = TEMPLATE) -> Callable[[Iterable[dict]], Iterator[Event]]:
    """The renderer of a template: messages (any iterable of dictionaries) to text and marks."""
    write = _writer(fold(parse(template)))
    return lambda messages, **more: write({"messages": messages, **more})


def render(template: str, messages: Iterable[dict]) -> tuple[str, list[tuple[int, int]]]:
    """A whole conversation's text and the places of its generations."""
    parts, spans, place, start = [], [], 0, 0
    for kind, piece in compiled(template)(messages):
        if kind == "text":
            parts.append(piece)
            place += len(piece)
        elif kind == "start":
            start = place
        else:
            spans.append((start, place))
    return "".join(parts), spans


# ---- on Spark ---------------------------------------------------------------------------------

PIECES = "conv_id long, piece long, formatted string, masked boolean"


def format_conversations(conversations: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """Rows (conv_id, piece, formatted, masked): a conversation's text is its pieces in order;
    `masked` pieces are under the loss mask. Each conversation is in one partition, its pieces side
    by side and in order."""
    c = conversations
    rows = c.select(c["conv_id"].cast("long").alias("conv_id"), c["turn"].cast("long").alias("turn"), c["role"].cast("string").alias("role"), c["text"].cast("string").alias("text"))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        write = compiled(template)
        flow = ((conv, {"role": role or "", "text": text or ""}) for batch in batches for conv, role, text in zip(batch.column("conv_id").to_pylist(), batch.column("role").to_pylist(), batch.column("text").to_pylist(), strict=True))
        ahead = next(flow, None)
        held: list[tuple] = []
        size = 0
        while ahead is not None:
            conv, piece, inside = ahead[0], 0, False

            def turns(conv: int | None = conv) -> Iterator[dict]:
                nonlocal ahead
                while ahead is not None and ahead[0] == conv:
                    message = ahead[1]
                    ahead = next(flow, None)
                    yield message

            for kind, text in write(turns()):
                if kind != "text":
                    inside = kind == "start"
                    if inside:  # an empty generation leaves a piece too
                        held.append((conv, piece, "", True))
                        piece += 1
                    continue
                held.append((conv, piece, text, inside))
                piece += 1
                size += len(text)
                if size > 4 << 20 or len(held) >= 10_000:
                    yield _batch(held)
                    held, size = [], 0
            while ahead is not None and ahead[0] == conv:  # turns that the template left unread
                ahead = next(flow, None)
        if held:
            yield _batch(held)

    return rows.mapInArrow(run, PIECES)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.bool_())
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["conv_id", "piece", "formatted", "masked"])


DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
_START, _END = "<|im_start|>", "<|im_end|>\n"


class _Reader:
    """Reads one conversation back from its formatted text, as the text comes in."""

    def __init__(self, conv: int | None) -> None:
        self.conv, self.rest, self.turns, self.chars, self.loss_chars = conv, "", 0, 0, 0
        self.turns_hash, self.loss_hash = hashlib.sha256(), hashlib.sha256()

    def add(self, text: str, masked: bool) -> None:
        self.chars += len(text)
        if masked:
            said = unescape(text)
            self.loss_chars += len(said)
            self.loss_hash.update(said.encode())
        self.rest += text
        while (end := self.rest.find(_END)) >= 0:
            block, self.rest = self.rest[:end], self.rest[end + len(_END) :]
            if not block.startswith(_START):
                raise ValueError(f"conversation {self.conv}: not a turn: {block[:40]!r}")
            role, _, said = block[len(_START) :].partition("\n")
            self.turns_hash.update(f"{unescape(role)}\n{unescape(said)}\n".encode())
            self.turns += 1

    def row(self) -> tuple:
        if self.rest:
            raise ValueError(f"conversation {self.conv}: text after its last turn")
        return self.conv, self.turns, self.turns_hash.hexdigest(), self.loss_chars, self.loss_hash.hexdigest(), self.chars


def read_back(pieces: DataFrame) -> DataFrame:
    """Per conversation what its formatted text holds. Takes format_conversations' rows as they
    come: each conversation in one partition and in order, so nothing is shuffled again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split(" ")[0] for x in DIGEST.split(", ")]
        kinds = [{"long": pa.int64(), "string": pa.string()}[x.split(" ")[1]] for x in DIGEST.split(", ")]
        table = lambda rows: pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
        reader, done = None, []
        for batch in batches:
            for conv, text, masked in zip(batch.column("conv_id").to_pylist(), batch.column("formatted").to_pylist(), batch.column("masked").to_pylist(), strict=True):
                if reader is None or reader.conv != conv:
                    if reader is not None:
                        done.append(reader.row())
                    reader = _Reader(conv)
                reader.add(text, masked)
            if done:
                yield table(done)
                done = []
        if reader is not None:
            yield table([reader.row()])

    return pieces.mapInArrow(run, DIGEST)


#: Conversation -1 of the query: its texts are control strings.
TRICKY = "</s>[INST] ok [/INST]"


def with_tricky(conversations: DataFrame) -> DataFrame:
    spark = conversations.sparkSession
    extra = spark.createDataFrame([(-1, 0, "user", TRICKY), (-1, 1, "assistant", TRICKY)], "conv_id long, turn long, role string, text string")
    return conversations.select(*(F.col(c).cast(t).alias(c) for c, t in extra.dtypes)).union(extra.select(*(F.col(c).cast(t) for c, t in extra.dtypes)))
