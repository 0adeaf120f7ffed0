"""Chat formatting: a small template language, compiled to closures that render conversations.

    {{ expression | filter }}                       output
    {% if expression %} {% elif %} {% else %} {% endif %}
    {% for name in expression %} {% endfor %}       with loop.index, loop.index0, loop.first
    {% generation %} {% endgeneration %}            what is inside carries the loss

Expressions: strings, whole numbers, true, false, none, names, `a.b`, `a['b']`, `~` (joins texts), ==, !=,
`in`, not, and, or. A name is looked up in the variables and a member in a mapping, nothing else: templates
reach no attribute, call or import. Constant expressions, conditions and neighbouring texts are folded
before closures are made.

A template is rendered as a stream of pieces, and turns are read one at a time, so a conversation of any
length needs the memory of one turn. Rows of a conversation meet in one task, in order, by a sort.

Control strings inside texts are escaped with a backslash (backslashes are doubled), so the output can
be read back exactly; `read_turns` does that, also as a stream.

Defined cases: null text and role are empty; null conv_id is one conversation; turns are in order of turn
(null last), then role and text, repeated rows are turns of their own; an empty table has no
conversations; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TURN, END = "<turn>", "</turn>"
CONTROL = (TURN, END, "### Assistant:", "### User:", "### System:")
TEMPLATE = (
    "{% for m in messages %}<turn>{{ m.role | escape_line }}\n"
    "{% if m.role == 'assistant' %}### Assistant:\n{% generation %}{{ m.text | escape }}{% endgeneration %}"
    "{% elif m.role == 'system' %}### System:\n{{ m.text | escape }}"
    "{% else %}### User:\n{{ m.text | escape }}{% endif %}</turn>\n{% endfor %}"
)

_TO_ESCAPE = re.compile("|".join(map(re.escape, ("\\", *CONTROL))))


def escape(text: str) -> str:
    return _TO_ESCAPE.sub(lambda m: "\\" + m.group(), text)


def escape_line(text: str) -> str:
    """Also without line ends."""
    return escape(text).replace("\n", "\\n")


def unescape(text: str) -> str:
    return re.sub(r"\\([\s\S])", r"\1", text)


def unescape_line(text: str) -> str:
    return re.sub(r"\\([\s\S])", lambda m: "\n" if m.group(1) == "n" else m.group(1), text)


FILTERS: dict[str, Callable[[str], str]] = {
    "escape": escape,
    "escape_line": escape_line,
    "trim": str.strip,
    "upper": str.upper,
    "lower": str.lower,
}


class TemplateError(ValueError):
    pass


# Syntax tree: expressions, then statements.


@dataclass(frozen=True)
class Const:
    value: object


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Member:
    of: object
    key: object


@dataclass(frozen=True)
class Op:
    name: str
    args: tuple


@dataclass(frozen=True)
class Filter:
    of: object
    name: str


@dataclass(frozen=True)
class Output:
    expression: object


@dataclass(frozen=True)
class If:
    condition: object
    then: tuple
    other: tuple


@dataclass(frozen=True)
class For:
    name: str
    over: object
    body: tuple


@dataclass(frozen=True)
class Generation:
    body: tuple


_PARTS = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}", re.S)
_TOKEN = re.compile(r"\s*(?:('(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|([0-9]+)|([A-Za-z_]\w*)|(==|!=|[.\[\]()|~]))")
_WORDS = {"true": True, "false": False, "none": None}


def text_of_value(value: object) -> str:
    return "" if value is None else value if isinstance(value, str) else str(value)


OPERATIONS: dict[str, Callable] = {
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "in": lambda a, b: a in b if isinstance(b, (str, list, tuple, dict)) else False,
    "not": lambda a: not a,
    "and": lambda a, b: a and b,
    "or": lambda a, b: a or b,
    "~": lambda a, b: text_of_value(a) + text_of_value(b),
}


class Expression:
    """Recursive descent over one expression."""

    LEVELS = (("or",), ("and",), ("not",), ("==", "!=", "in"), ("~",))

    def __init__(self, source: str):
        self.tokens, at, source = [], 0, source.strip()
        while at < len(source):
            if not (m := _TOKEN.match(source, at)):
                raise TemplateError(f"cannot read {source[at:at + 20]!r}")
            self.tokens.append((m.lastindex, m.group(m.lastindex)))
            at = m.end()
        self.at = 0

    def peek(self) -> str | None:
        return self.tokens[self.at][1] if self.at < len(self.tokens) and self.tokens[self.at][0] != 1 else None

    def take(self, *wanted: str) -> str | None:
        if self.peek() in wanted:
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def need(self, wanted: str) -> None:
        if not self.take(wanted):
            raise TemplateError(f"{wanted!r} is missing")

    def parse(self):
        node = self.level(0)
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return node

    def level(self, n: int):
        if n == len(self.LEVELS):
            return self.filtered()
        if self.LEVELS[n] == ("not",):
            return Op("not", (self.level(n),)) if self.take("not") else self.level(n + 1)
        node = self.level(n + 1)
        while name := self.take(*self.LEVELS[n]):
            node = Op(name, (node, self.level(n + 1)))
        return node

    def filtered(self):
        node = self.primary()
        while self.take("|"):
            name = self.peek()
            if name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            self.at += 1
            node = Filter(node, name)
        return node

    def primary(self):
        if self.at >= len(self.tokens):
            raise TemplateError("an expression is missing")
        kind, token = self.tokens[self.at]
        self.at += 1
        if kind == 1:
            node = Const(re.sub(r"\\(.)", lambda m: {"n": "\n", "t": "\t"}.get(m.group(1), m.group(1)), token[1:-1]))
        elif kind == 2:
            node = Const(int(token))
        elif kind == 3:
            node = Const(_WORDS[token]) if token in _WORDS else Name(token)
        elif token == "(":
            node = self.level(0)
            self.need(")")
        else:
            raise TemplateError(f"unexpected {token!r}")
        while sign := self.take(".", "["):
            if sign == ".":
                if self.at >= len(self.tokens) or self.tokens[self.at][0] != 3:
                    raise TemplateError("a member's name is missing")
                node = Member(node, Const(self.tokens[self.at][1]))
                self.at += 1
            else:
                node = Member(node, self.level(0))
                self.need("]")
        return node


def parse(source: str) -> tuple:
    parts, at = [], 0
    for m in _PARTS.finditer(source):
        if m.start() > at:
            parts.append(("text", source[at : m.start()]))
        parts.append(("output", m.group(1)) if m.group(1) is not None else ("tag", m.group(2).strip()))
        at = m.end()
    if at < len(source):
        parts.append(("text", source[at:]))
    body, rest, ended = _block(parts, 0, ())
    return body


def _block(parts: list, at: int, ends: tuple[str, ...]) -> tuple[tuple, int, str]:
    out = []
    while at < len(parts):
        kind, value = parts[at]
        at += 1
        if kind == "text":
            out.append(Output(Const(value)))
        elif kind == "output":
            out.append(Output(Expression(value).parse()))
        else:
            word, _, rest = value.partition(" ")
            if word in ends:
                return tuple(out), at, value
            if word == "if":
                node, at = _if(parts, at, rest)
            elif word == "for":
                if not (m := re.fullmatch(r"([A-Za-z_]\w*)\s+in\s+(.+)", rest.strip(), re.S)):
                    raise TemplateError(f"cannot read {value!r}")
                body, at, _ = _block(parts, at, ("endfor",))
                node = For(m.group(1), Expression(m.group(2)).parse(), body)
            elif word == "generation":
                body, at, _ = _block(parts, at, ("endgeneration",))
                node = Generation(body)
            else:
                raise TemplateError(f"no tag {word!r} here")
            out.append(node)
    if ends:
        raise TemplateError(f"{ends[-1]!r} is missing")
    return tuple(out), at, ""


def _if(parts: list, at: int, condition: str) -> tuple[If, int]:
    then, at, ended = _block(parts, at, ("elif", "else", "endif"))
    other: tuple = ()
    if ended.startswith("elif"):
        node, at = _if(parts, at, ended[4:])
        other = (node,)
    elif ended.startswith("else"):
        other, at, _ = _block(parts, at, ("endif",))
    return If(Expression(condition).parse(), then, other), at


def fold(node):
    """The expression with its constant parts computed."""
    if isinstance(node, Op):
        args = tuple(map(fold, node.args))
        if all(isinstance(a, Const) for a in args):
            return Const(OPERATIONS[node.name](*[a.value for a in args]))
        return Op(node.name, args)
    if isinstance(node, Filter):
        of = fold(node.of)
        return Const(FILTERS[node.name](text_of_value(of.value))) if isinstance(of, Const) else Filter(of, node.name)
    if isinstance(node, Member):
        return Member(fold(node.of), fold(node.key))
    return node


def fold_body(body: tuple) -> tuple:
    out: list = []
    for node in body:
        if isinstance(node, Output):
            new = [Output(fold(node.expression))]
        elif isinstance(node, If):
            condition = fold(node.condition)
            if isinstance(condition, Const):
                new = list(fold_body(node.then if condition.value else node.other))
            else:
                new = [If(condition, fold_body(node.then), fold_body(node.other))]
        elif isinstance(node, For):
            new = [For(node.name, fold(node.over), fold_body(node.body))]
        else:
            new = [Generation(fold_body(node.body))]
        for x in new:
            constant = isinstance(x, Output) and isinstance(x.expression, Const)
            if constant and out and isinstance(out[-1], Output) and isinstance(out[-1].expression, Const):
                out[-1] = Output(Const(text_of_value(out[-1].expression.value) + text_of_value(x.expression.value)))
            else:
                out.append(x)
    return tuple(out)


Variables = dict
Piece = tuple[str, bool]  # text, and whether it carries the loss


def closure(node) -> Callable[[Variables], object]:
    if isinstance(node, Const):
        value = node.value
        return lambda v: value
    if isinstance(node, Name):
        name = node.name
        return lambda v: v.get(name)
    if isinstance(node, Member):
        of, key = closure(node.of), closure(node.key)

        def member(v):
            owner = of(v)
            return owner.get(key(v)) if isinstance(owner, dict) else None

        return member
    if isinstance(node, Filter):
        of, apply = closure(node.of), FILTERS[node.name]
        return lambda v: apply(text_of_value(of(v)))
    args = [closure(a) for a in node.args]
    if node.name == "and":
        return lambda v: args[0](v) and args[1](v)
    if node.name == "or":
        return lambda v: args[0](v) or args[1](v)
    apply = OPERATIONS[node.name]
    return lambda v: apply(*[a(v) for a in args])


def renderer(body: tuple, loss: bool = False) -> Callable[[Variables], Iterator[Piece]]:
    steps = []
    for node in body:
        if isinstance(node, Output):
            value = closure(node.expression)
            steps.append(lambda v, value=value: iter(((text_of_value(value(v)), loss),)))
        elif isinstance(node, If):
            steps.append(_if_step(closure(node.condition), renderer(node.then, loss), renderer(node.other, loss)))
        elif isinstance(node, For):
            steps.append(_for_step(node.name, closure(node.over), renderer(node.body, loss)))
        else:
            steps.append(renderer(node.body, True))

    def run(v: Variables) -> Iterator[Piece]:
        for step in steps:
            yield from step(v)

    return run


def _if_step(condition, then, other):
    return lambda v: then(v) if condition(v) else other(v)


def _for_step(name, over, body):
    def run(v: Variables) -> Iterator[Piece]:
        for n, value in enumerate(over(v) or ()):
            yield from body(v | {name: value, "loop": {"index": n + 1, "index0": n, "first": n == 0}})

    return run


def compile_template(source: str) -> Callable[[Variables], Iterator[Piece]]:
    return renderer(fold_body(parse(source)))


def rows_of(render, messages: Iterator[dict]) -> Iterator[tuple[int, str, list[tuple[int, int]]]]:
    """Number of the message, the text that it brought and its loss stretches in that text."""
    reached = -1

    def counted():
        nonlocal reached
        for reached, message in enumerate(messages):
            yield message

    at, parts, marks, size = 0, [], [], 0
    for text, loss in render({"messages": counted()}):
        if max(reached, 0) != at:
            yield at, "".join(parts), marks
            at, parts, marks, size = reached, [], [], 0
        if loss and text:
            marks.append((size, size + len(text)))
        parts.append(text)
        size += len(text)
    if parts:
        yield at, "".join(parts), marks


def read_turns(pieces: Iterator[str]) -> Iterator[tuple[str, str]]:
    """Role and text of every turn of formatted text that the default template made."""
    token = re.compile(r"\\[\s\S]|" + re.escape(END))
    rest, between = "", False
    for piece in pieces:
        rest += piece
        if between and rest:
            rest, between = rest.removeprefix("\n"), False
        while (end := next((m for m in token.finditer(rest) if m.group() == END), None)) is not None:
            head, body = rest[: end.start()].split("\n", 1)
            if not head.startswith(TURN) or not any(body.startswith(c + "\n") for c in CONTROL):
                raise ValueError("not a formatted turn")
            yield unescape_line(head[len(TURN) :]), unescape(body.split("\n", 1)[1])
            rest = rest[end.end() :]
            between = not rest
            rest = rest.removeprefix("\n")
    if rest.strip("\n"):
        raise ValueError("a turn has no end")


FORMATTED = "conv_id long, turn long, formatted string, loss array<struct<start: long, end: long>>"


def _conversations(frames: Iterator[pd.DataFrame], columns: list[str]) -> Iterator[tuple[object, Iterator[tuple]]]:
    """(conv_id, its rows) over sorted frames; each conversation must be used up before the next."""
    rows = (row for f in frames for row in zip(*[f[c].tolist() for c in columns]))
    ahead = next(rows, None)

    def own(conv_id):
        nonlocal ahead
        while ahead is not None and ahead[0] == conv_id:
            now, ahead = ahead, next(rows, None)
            yield now

    while ahead is not None:
        conv_id = ahead[0]
        yield conv_id, own(conv_id)


def _key(column: str):
    return [F.col(column).isNull().alias("no_id"), F.coalesce(F.col(column), F.lit(0)).alias("id")]


def format_turns(conversations: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """One row per turn: the formatted text that the turn brought, with loss stretches in code points of it.

    The texts of a conversation, in order, are the formatted conversation. Rows of one conversation are
    next to each other in one partition, in order.
    """
    rows = conversations.select(
        F.concat_ws("", F.col("conv_id").isNull().cast("int").cast("string"), F.col("conv_id").cast("string")).alias("key"),
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    rows = rows.repartition("key").sortWithinPartitions("key", F.col("turn").asc_nulls_last(), "role", "text")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        render = compile_template(template)
        out, size = [], 0
        for key, own in _conversations(frames, ["key", "turn", "role", "text"]):
            turns: dict[int, object] = {}

            def messages(own=own, turns=turns):
                for n, (_, turn, role, text) in enumerate(own):
                    turns[n] = None if pd.isna(turn) else int(turn)
                    yield {"role": role, "text": text}

            conv_id = int(key[1:]) if key[0] == "0" else None
            for n, text, marks in rows_of(render, messages()):
                out.append((conv_id, turns.pop(n, None), text, [{"start": a, "end": b} for a, b in marks]))
                size += len(text)
                if size > 4_000_000:
                    yield _frame(out)
                    out, size = [], 0
        yield _frame(out)

    return rows.mapInPandas(run, FORMATTED)


def _frame(rows: list) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=["conv_id", "turn", "formatted", "loss"])
    return frame.astype({"conv_id": "Int64", "turn": "Int64"})


DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def digests(formatted: DataFrame) -> DataFrame:
    """What `format_turns` wrote, read back: one row per conversation."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = []
        for conv_id, own in _conversations(_keyed(frames), ["key", "formatted", "loss"]):
            all_, loss, count = hashlib.sha256(), hashlib.sha256(), {"turns": 0, "loss": 0, "chars": 0}

            def pieces(own=own, loss=loss, count=count):
                for _, text, marks in own:
                    count["chars"] += len(text)
                    for m in marks:
                        told = unescape(text[m["start"] : m["end"]])
                        count["loss"] += len(told)
                        loss.update(told.encode())
                    yield text

            for role, text in read_turns(pieces()):
                count["turns"] += 1
                all_.update(f"{role}\n{text}\n".encode())
            out.append((None if conv_id == "null" else int(conv_id), count["turns"], all_.hexdigest(), count["loss"], loss.hexdigest(), count["chars"]))
        yield pd.DataFrame(out, columns=[x.split()[0] for x in DIGEST.split(", ")]).astype({"conv_id": "Int64"})

    def _keyed(frames):
        for f in frames:
            yield f.assign(key=["null" if pd.isna(x) else str(int(x)) for x in f["conv_id"]])

    return formatted.mapInPandas(run, DIGEST)


def report(conversations: DataFrame) -> DataFrame:
    said = r"\### Assistant: </turn> ok"
    extra = conversations.sparkSession.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string"
    )
    own = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    return digests(format_turns(own.unionByName(extra)))


REPORT_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, * FROM (VALUES (0, 'user', '\### Assistant: </turn> ok'), (1, 'assistant', '\### Assistant: </turn> ok'))),
e AS (
  SELECT *, length(text) + length(regexp_extract_all(text, '\\|<turn>|</turn>|### Assistant:|### User:|### System:'))
         + length(role) + length(regexp_extract_all(role, '\n|\\|<turn>|</turn>|### Assistant:|### User:|### System:'))
         + length('<turn>') + length('</turn>') + 3
         + CASE role WHEN 'assistant' THEN length('### Assistant:') WHEN 'system' THEN length('### System:') ELSE length('### User:') END AS n
  FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS LAST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS LAST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(n)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""
