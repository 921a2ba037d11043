"""Chat formatting with a compiled template language.

A template is parsed to a syntax tree, constants are folded, and the tree becomes Python
closures.  Templates see only the values that they are given: there are no calls, attributes
read mappings only, and loops run over given sequences, so a template always ends.

Rendering is a stream: messages are taken one by one and output leaves at once, with a flag on
what stands between ``{% generation %}`` and ``{% endgeneration %}``, so a conversation of any
length needs the memory of two messages.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Strings that mark turns.  Inside texts they are broken by a backslash after their first
#: character, and backslashes are doubled.
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[/SYS]", "[ANSWER]", "[/ANSWER]", "[ROLE]", "[/ROLE]", "[TEXT]", "[/TEXT]")
TEMPLATE = (
    "{% for m in messages %}<s>"
    "{% if m.role == 'user' %}[INST] {{ m.text | escape }} [/INST]"
    "{% elif m.role == 'assistant' %}[ANSWER] {% generation %}{{ m.text | escape }}{% endgeneration %} [/ANSWER]"
    "{% elif m.role == 'system' %}[SYS] {{ m.text | escape }} [/SYS]"
    "{% else %}[ROLE] {{ m.role | escape }} [/ROLE][TEXT] {{ m.text | escape }} [/TEXT]{% endif %}"
    "</s>{% endfor %}"
)

_CONTROL = re.compile(r"\\|" + "|".join(map(re.escape, CONTROL)))


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: "\\\\" if m[0] == "\\" else f"{m[0][0]}\\{m[0][1:]}", text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def _text(value) -> str:
    return "" if value is None else str(value)


FILTERS: dict[str, Callable] = {
    "escape": lambda x: escape(_text(x)),
    "trim": lambda x: _text(x).strip(),
    "upper": lambda x: _text(x).upper(),
    "lower": lambda x: _text(x).lower(),
}
_COMPARE: dict[str, Callable] = {"==": lambda a, b: a == b, "!=": lambda a, b: a != b, "in": lambda a, b: a in b}

# Syntax tree.  Expressions: ("const", value) ("name", name) ("get", of, key) ("not", x)
# ("and", a, b) ("or", a, b) ("compare", operator, a, b) ("add", a, b) ("filter", name, x).
# Statements: ("text", string) ("out", expression) ("set", name, expression)
# ("if", [(condition, body)]) ("for", name, expression, body) ("generation", body).

_TAG = re.compile(r"(\{\{.*?\}\}|\{%.*?%\})", re.DOTALL)
_SYMBOL = re.compile(r"\s*(?:('(?:[^'\\]|\\.)*')|(\d+)|([A-Za-z_]\w*)|(==|!=|[.|+()\[\]]))")


class TemplateError(ValueError):
    pass


class _Expression:
    """Recursive descent over the symbols of one tag."""

    def __init__(self, source: str):
        self.symbols, at = [], 0
        source = source.strip()
        while at < len(source):
            m = _SYMBOL.match(source, at)
            if not m:
                raise TemplateError(f"unexpected {source[at:]!r}")
            self.symbols.append((m.lastindex, m[m.lastindex]))
            at = m.end()
        self.at = 0

    def next_is(self, *words: str) -> str | None:
        if self.at < len(self.symbols) and (s := self.symbols[self.at])[1] in words and s[0] in (3, 4):
            self.at += 1
            return s[1]
        return None

    def need(self, word: str) -> None:
        if not self.next_is(word):
            raise TemplateError(f"{word!r} is missing")

    def whole(self):
        node = self.either()
        if self.at < len(self.symbols):
            raise TemplateError(f"unexpected {self.symbols[self.at][1]!r}")
        return node

    def either(self):
        node = self.both()
        while self.next_is("or"):
            node = ("or", node, self.both())
        return node

    def both(self):
        node = self.negated()
        while self.next_is("and"):
            node = ("and", node, self.negated())
        return node

    def negated(self):
        return ("not", self.negated()) if self.next_is("not") else self.compared()

    def compared(self):
        node = self.summed()
        while sign := self.next_is("==", "!=", "in"):
            node = ("compare", sign, node, self.summed())
        return node

    def summed(self):
        node = self.filtered()
        while self.next_is("+"):
            node = ("add", node, self.filtered())
        return node

    def filtered(self):
        node = self.item()
        while self.next_is("|"):
            name = self.name()
            if name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            node = ("filter", name, node)
        return node

    def name(self) -> str:
        if self.at >= len(self.symbols) or self.symbols[self.at][0] != 3:
            raise TemplateError("a name is missing")
        self.at += 1
        return self.symbols[self.at - 1][1]

    def item(self):
        if self.at >= len(self.symbols):
            raise TemplateError("an expression is missing")
        kind, symbol = self.symbols[self.at]
        self.at += 1
        if kind == 1:
            node = ("const", unescape(symbol[1:-1]))
        elif kind == 2:
            node = ("const", int(symbol))
        elif kind == 3:
            known = {"true": True, "false": False, "none": None}
            node = ("const", known[symbol]) if symbol in known else ("name", symbol)
        elif symbol == "(":
            node = self.either()
            self.need(")")
        else:
            raise TemplateError(f"unexpected {symbol!r}")
        while sign := self.next_is(".", "["):
            if sign == ".":
                node = ("get", node, ("const", self.name()))
            else:
                node = ("get", node, self.either())
                self.need("]")
        return node


def parse(source: str) -> list:
    """The statements of a template."""
    parts = [p for p in _TAG.split(source) if p]
    body, rest = _statements(parts, 0, ())
    return body


def _statements(parts: list[str], at: int, ends: tuple[str, ...]) -> tuple[list, int]:
    body: list = []
    while at < len(parts):
        part = parts[at]
        at += 1
        if part.startswith("{{"):
            body.append(("out", _Expression(part[2:-2]).whole()))
            continue
        if not part.startswith("{%"):
            body.append(("text", part))
            continue
        word, _, rest = part[2:-2].strip().partition(" ")
        if word in ends:
            return body, at - 1
        if word == "generation":
            inner, at = _statements(parts, at, ("endgeneration",))
            body.append(("generation", inner))
            at += 1
        elif word == "set":
            name, _, value = rest.partition("=")
            body.append(("set", name.strip(), _Expression(value).whole()))
        elif word == "for":
            name, _, value = rest.partition(" in ")
            inner, at = _statements(parts, at, ("endfor",))
            body.append(("for", name.strip(), _Expression(value).whole(), inner))
            at += 1
        elif word == "if":
            arms = []
            condition = _Expression(rest).whole()
            while True:
                inner, at = _statements(parts, at, ("elif", "else", "endif"))
                arms.append((condition, inner))
                word, _, rest = parts[at][2:-2].strip().partition(" ")
                at += 1
                if word == "endif":
                    break
                condition = ("const", True) if word == "else" else _Expression(rest).whole()
            body.append(("if", arms))
        else:
            raise TemplateError(f"unexpected {part!r}")
    if ends:
        raise TemplateError(f"{ends[-1]!r} is missing")
    return body, at


def fold_expression(node):
    kind = node[0]
    if kind in ("const", "name"):
        return node
    node = tuple(fold_expression(x) if isinstance(x, tuple) else x for x in node)
    inner = [x for x in node[1:] if isinstance(x, tuple)]
    if all(x[0] == "const" for x in inner):
        return ("const", _evaluator(node)({}))
    return node


def fold(body: list) -> list:
    """Constants evaluated, decided branches resolved, neighbouring texts joined."""
    out: list = []

    def add(node) -> None:
        if node[0] == "text" and out and out[-1][0] == "text":
            out[-1] = ("text", out[-1][1] + node[1])
        elif node != ("text", ""):
            out.append(node)

    for node in body:
        kind = node[0]
        if kind == "out":
            value = fold_expression(node[1])
            add(("text", _text(value[1])) if value[0] == "const" else ("out", value))
        elif kind == "set":
            add(("set", node[1], fold_expression(node[2])))
        elif kind == "generation":
            add(("generation", fold(node[1])))
        elif kind == "for":
            add(("for", node[1], fold_expression(node[2]), fold(node[3])))
        elif kind == "if":
            arms = []
            for condition, inner in node[1]:
                condition = fold_expression(condition)
                if condition[0] == "const" and not condition[1]:
                    continue
                arms.append((condition, fold(inner)))
                if condition[0] == "const":
                    break
            if arms and arms[0][0][0] == "const":
                for x in arms[0][1]:
                    add(x)
            elif arms:
                add(("if", arms))
        else:
            add(node)
    return out


def _evaluator(node) -> Callable[[dict], object]:
    kind = node[0]
    if kind == "const":
        value = node[1]
        return lambda env: value
    if kind == "name":
        name = node[1]
        return lambda env: env.get(name)
    if kind == "get":
        of, key = _evaluator(node[1]), _evaluator(node[2])

        def get(env):
            value = of(env)
            return value.get(key(env)) if isinstance(value, dict) else None

        return get
    if kind == "not":
        inner = _evaluator(node[1])
        return lambda env: not inner(env)
    if kind in ("and", "or"):
        a, b = _evaluator(node[1]), _evaluator(node[2])
        return (lambda env: a(env) and b(env)) if kind == "and" else (lambda env: a(env) or b(env))
    if kind == "compare":
        compare, a, b = _COMPARE[node[1]], _evaluator(node[2]), _evaluator(node[3])
        return lambda env: compare(a(env), b(env))
    if kind == "add":
        a, b = _evaluator(node[1]), _evaluator(node[2])
        return lambda env: a(env) + b(env)
    function, inner = FILTERS[node[1]], _evaluator(node[2])
    return lambda env: function(inner(env))


#: A piece of output, and whether a model is to learn it.  ``None`` ends what one round of a
#: loop over the conversation gives.
Segment = tuple[str, bool] | None


def _renderer(node, learn: bool) -> Callable[[dict], Iterator[Segment]]:
    kind = node[0]
    if kind == "text":
        made = ((node[1], learn),)
        return lambda env: iter(made)
    if kind == "out":
        value = _evaluator(node[1])
        return lambda env: iter(((_text(value(env)), learn),))
    if kind == "set":
        name, value = node[1], _evaluator(node[2])

        def assign(env):
            env[name] = value(env)
            return iter(())

        return assign
    if kind == "generation":
        return _sequence(node[1], True)
    if kind == "if":
        arms = [(_evaluator(c), _sequence(b, learn)) for c, b in node[1]]

        def choose(env):
            for condition, body in arms:
                if condition(env):
                    return body(env)
            return iter(())

        return choose
    name, sequence, body = node[1], _evaluator(node[2]), _sequence(node[3], learn)
    over_messages = node[2] == ("name", "messages")

    def loop(env):
        items = iter(sequence(env) or ())
        item, index, ended = next(items, loop), 0, False
        while item is not loop:
            following = next(items, loop)
            inner = env | {name: item, "loop": {"index": index + 1, "first": index == 0, "last": following is loop}}
            yield from body(inner)
            if over_messages:
                yield None
            item, index = following, index + 1

    return loop


def _sequence(body: list, learn: bool) -> Callable[[dict], Iterator[Segment]]:
    parts = [_renderer(x, learn) for x in body]
    if len(parts) == 1:
        return parts[0]

    def run(env):
        for part in parts:
            yield from part(env)

    return run


def compile_template(source: str) -> Callable[[Iterable[dict]], Iterator[Segment]]:
    run = _sequence(fold(parse(source)), False)
    return lambda messages: run({"messages": messages})


_FORMATTED = "conv_id long, part long, formatted string, learned array<struct<begin: int, end: int>>"
_ARROW = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("part", pa.int64()),
        ("formatted", pa.string()),
        ("learned", pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))),
    ]
)
_ROWS = 512


def _rows(batches) -> Iterator[tuple]:
    for batch in batches:
        for low in range(0, batch.num_rows, _ROWS):
            yield from zip(*(c.to_pylist() for c in batch.slice(low, _ROWS).columns), strict=True)


def _batches(rows: Iterable[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == _ROWS:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


def format_conversations(turns: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """Render conversations; the parts of one, joined in order, are its formatted text.

    ``turns`` has conv_id, turn, role, text.  A part is what one message gives; ``learned`` lists
    the stretches of it (code points) that a model is to learn.  Null roles and texts are empty;
    rows without a conversation id form one conversation; rows of the same turn follow each
    other by role and text, repeated rows included.

    Conversations are sorted within their partition and streamed, so a very long one costs the
    time of its rows and no memory.
    """

    def run(batches):
        render = compile_template(template)

        def parts():
            for conv, group in groupby(_rows(batches), key=lambda r: r[0]):
                messages = ({"role": role or "", "text": text or ""} for _, role, text in group)
                number, text, at, learned = 0, [], 0, []
                for segment in render(messages):
                    if segment is None:
                        yield conv, number, "".join(text), learned
                        number, text, at, learned = number + 1, [], 0, []
                    else:
                        text.append(segment[0])
                        if segment[1] and segment[0]:
                            learned.append({"begin": at, "end": at + len(segment[0])})
                        at += len(segment[0])
                if text:
                    yield conv, number, "".join(text), learned

        yield from _batches(parts(), _ARROW)

    ordered = (
        turns.select(
            F.col("conv_id").cast("long").alias("conv_id"),
            F.col("turn").cast("long").alias("turn"),
            F.col("role").cast("string").alias("role"),
            F.col("text").cast("string").alias("text"),
        )
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .select("conv_id", "role", "text")
    )
    return ordered.mapInArrow(run, StructType.fromDDL(_FORMATTED))


_TURN = re.compile(
    r"<s>(?:\[INST\] (?P<user>.*?) \[/INST\]|\[ANSWER\] (?P<assistant>.*?) \[/ANSWER\]|\[SYS\] (?P<system>.*?) \[/SYS\]"
    r"|\[ROLE\] (?P<role>.*?) \[/ROLE\]\[TEXT\] (?P<text>.*?) \[/TEXT\])</s>",
    re.DOTALL,
)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of the turns in text that ``TEMPLATE`` made; it must be made of them alone."""
    turns, at = [], 0
    for m in _TURN.finditer(formatted):
        if m.start() != at:
            break
        at = m.end()
        if m["role"] is not None:
            turns.append((unescape(m["role"]), unescape(m["text"])))
        else:
            turns.append((m.lastgroup, unescape(m[m.lastgroup])))
    if at != len(formatted):
        raise ValueError(f"not a turn: {formatted[at : at + 50]!r}")
    return turns


_SUMMARY = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("n_turns", pa.int64()),
        ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()),
        ("formatted_chars", pa.int64()),
    ]
)


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation, digests of the turns and of the learned text found in the output.

    Takes the rows of ``format_conversations`` as they come: the parts of a conversation follow
    each other within a partition.
    """

    def run(batches):
        def summaries():
            for conv, group in groupby(_rows(batches), key=lambda r: r[0]):
                turns, loss, n, chars, size = hashlib.sha256(), hashlib.sha256(), 0, 0, 0
                for _, text, learned in group:
                    for role, said in read_turns(text):
                        turns.update(f"{role}\n{said}\n".encode("utf-8", "replace"))
                        n += 1
                    for span in learned:
                        said = unescape(text[span["begin"] : span["end"]])
                        loss.update(said.encode("utf-8", "replace"))
                        chars += len(said)
                    size += len(text)
                yield conv, n, turns.hexdigest(), chars, loss.hexdigest(), size

        yield from _batches(summaries(), _SUMMARY)

    ddl = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return formatted.select("conv_id", "formatted", "learned").mapInArrow(run, StructType.fromDDL(ddl))
