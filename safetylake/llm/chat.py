"""Chat formatting: a template compiler and its use over conversations.

A template is parsed into a syntax tree, constants are folded, and the tree is turned into Python closures.
The language: text, ``{{ expression }}``, ``{% for m in messages %}``, ``{% if %} {% elif %} {% else %}``,
``{% generation %}`` (marks what a model is to learn). Expressions know literals, ``m.role``, ``m.text``,
``loop.first``, ``loop.last``, ``loop.index0``, ``== != + and or not in``, parentheses and the filters
``escape trim upper lower``. Nothing else can be reached: no calls, no attributes of Python objects, no names
but these, and one loop, at the top level, over the turns.

That loop makes a template three closures (head, turn, tail), so conversations are rendered turn by turn from
rows sorted by conversation and turn. A task holds one batch of rows whatever the length of a conversation;
one shuffle by conversation is all that moves.

``escape`` keeps control strings out of texts: a backslash is doubled, and one is put after the first
character of every control string; :func:`unescape` undoes it.

Defined results: null roles and texts are empty; turns are ordered by turn (null first), then role, then
text, so ties and repeated rows have one order; a null conv_id is a conversation of its own; an empty table
gives no rows; only the four named columns are read, so other columns of any name are left aside.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "<|turn|>", "<|text|>", "<|end|>")
TEMPLATE = (
    "<s>{% for m in messages %}<|turn|>{{ m.role | escape }}<|text|>"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}"
    "{% else %}{{ m.text | escape }}{% endif %}<|end|>{% endfor %}</s>"
)

_MARKED = re.compile("|".join([r"\\", *map(re.escape, CONTROL)]))


def escape(text: str) -> str:
    return _MARKED.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


class TemplateError(ValueError):
    """The template is not in the language."""


# --- parsing: nodes are tuples (kind, ...) -------------------------------------------------------------

_TAG = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}", re.S)
_TOKEN = re.compile(r"""\s*(?:('[^']*'|"[^"]*")|(\d+)|([A-Za-z_]\w*)|(==|!=|[+|().]))""")
_FIELDS = {"m": ("role", "text"), "loop": ("first", "last", "index0")}
_FILTERS: dict[str, Callable[[str], str]] = {"escape": escape, "trim": str.strip, "upper": str.upper, "lower": str.lower}


class _Expression:
    """Recursive descent over: or, and, not, comparison, sum, filtered value."""

    def __init__(self, source: str):
        self.tokens, at = [], 0
        source = source.strip()
        while at < len(source):
            m = _TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"unexpected {source[at:]!r}")
            self.tokens.append(next((k, t) for k, t in zip(("str", "int", "name", "op"), m.groups(), strict=True) if t))
            at = m.end()
        self.at = 0

    def peek(self) -> str | None:
        return self.tokens[self.at][1] if self.at < len(self.tokens) and self.tokens[self.at][0] != "str" else None

    def take(self, *wanted: str) -> str | None:
        if self.peek() in wanted:
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def parse(self) -> tuple:
        node = self.either()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return node

    def either(self) -> tuple:
        node = self.both()
        while self.take("or"):
            node = ("or", node, self.both())
        return node

    def both(self) -> tuple:
        node = self.negated()
        while self.take("and"):
            node = ("and", node, self.negated())
        return node

    def negated(self) -> tuple:
        return ("not", self.negated()) if self.take("not") else self.compared()

    def compared(self) -> tuple:
        node = self.added()
        op = self.take("==", "!=", "in")
        return (op, node, self.added()) if op else node

    def added(self) -> tuple:
        node = self.filtered()
        while self.take("+"):
            node = ("+", node, self.filtered())
        return node

    def filtered(self) -> tuple:
        node = self.value()
        while self.take("|"):
            name = self.peek()
            if name not in _FILTERS:
                raise TemplateError(f"unknown filter {name!r}")
            self.at += 1
            node = ("filter", name, node)
        return node

    def value(self) -> tuple:
        if self.at >= len(self.tokens):
            raise TemplateError("an expression ends early")
        if self.take("("):
            node = self.either()
            if not self.take(")"):
                raise TemplateError("a parenthesis is not closed")
            return node
        kind, text = self.tokens[self.at]
        self.at += 1
        if kind == "str":
            return ("const", text[1:-1])
        if kind == "int":
            return ("const", int(text))
        if text in ("true", "false"):
            return ("const", text == "true")
        if kind == "name" and text in _FIELDS and self.take("."):
            field = self.peek()
            if field in _FIELDS[text]:
                self.at += 1
                return ("field", text, field)
        raise TemplateError(f"unknown name {text!r}")


def parse(source: str) -> list[tuple]:
    """The syntax tree: a list of nodes."""
    parts: list[tuple[str, str]] = []
    at = 0
    for m in _TAG.finditer(source):
        parts.append(("text", source[at : m.start()]))
        parts.append(("print", m[1]) if m[1] is not None else ("tag", " ".join(m[2].split())))
        at = m.end()
    parts.append(("text", source[at:]))
    place = 0

    def block(ends: tuple[str, ...], depth: int) -> tuple[list[tuple], str]:
        nonlocal place
        nodes: list[tuple] = []
        while place < len(parts):
            kind, body = parts[place]
            place += 1
            word = body.split(" ")[0]
            if kind == "text":
                nodes.append(("text", ("const", body)))
            elif kind == "print":
                nodes.append(("text", _Expression(body).parse()))
            elif word in ends:
                return nodes, body
            elif body == "for m in messages" and depth == 0:
                nodes.append(("for", block(("endfor",), depth + 1)[0]))
            elif word == "generation":
                nodes.append(("generation", block(("endgeneration",), depth + 1)[0]))
            elif word == "if":
                nodes.append(condition(body[3:], depth))
            else:
                raise TemplateError(f"unexpected tag {body!r}")
        if ends:
            raise TemplateError(f"{ends[-1]} is missing")
        return nodes, ""

    def condition(test: str, depth: int) -> tuple:
        then, end = block(("elif", "else", "endif"), depth + 1)
        if end.startswith("elif "):
            return ("if", _Expression(test).parse(), then, [condition(end[5:], depth)])
        other = block(("endif",), depth + 1)[0] if end == "else" else []
        return ("if", _Expression(test).parse(), then, other)

    return block((), 0)[0]


# --- folding -------------------------------------------------------------------------------------------

_BINARY: dict[str, Callable] = {
    "==": lambda a, b: a == b, "!=": lambda a, b: a != b, "+": lambda a, b: a + b if type(a) is type(b) else f"{a}{b}",
    "in": lambda a, b: str(a) in str(b), "and": lambda a, b: a and b, "or": lambda a, b: a or b,
}


def fold_value(node: tuple) -> tuple:
    kind = node[0]
    if kind in ("const", "field"):
        return node
    if kind == "filter":
        inner = fold_value(node[2])
        return ("const", _FILTERS[node[1]](str(inner[1]))) if inner[0] == "const" else (kind, node[1], inner)
    operands = [fold_value(x) for x in node[1:]]
    if all(x[0] == "const" for x in operands):
        values = [x[1] for x in operands]
        return ("const", not values[0]) if kind == "not" else ("const", _BINARY[kind](*values))
    return (kind, *operands)


def fold(nodes: list[tuple]) -> list[tuple]:
    """Constant expressions become values, decided branches disappear, neighbouring texts are one."""
    out: list[tuple] = []
    for node in nodes:
        kind = node[0]
        if kind == "text":
            made = [("text", fold_value(node[1]))]
        elif kind == "if":
            test = fold_value(node[1])
            made = fold(node[2] if test[1] else node[3]) if test[0] == "const" else [("if", test, fold(node[2]), fold(node[3]))]
        else:
            made = [(kind, fold(node[1]))]
        for x in made:
            constant = x[0] == "text" and x[1][0] == "const"
            if constant and x[1][1] == "":
                continue
            if constant and out and out[-1][0] == "text" and out[-1][1][0] == "const":
                x = ("text", ("const", f"{out.pop()[1][1]}{x[1][1]}"))
            out.append(x)
    return out


# --- closures ------------------------------------------------------------------------------------------

Env = dict[str, dict]


class Output:
    """Rendered text, and the spans of it that lie under the generation mark."""

    def __init__(self) -> None:
        self.parts: list[str] = []
        self.length = 0
        self.spans: list[tuple[int, int]] = []

    def put(self, value: object) -> None:
        text = value if isinstance(value, str) else str(value)
        self.parts.append(text)
        self.length += len(text)


def value_of(node: tuple) -> Callable[[Env], object]:
    kind = node[0]
    if kind == "const":
        constant = node[1]
        return lambda env: constant
    if kind == "field":
        _, name, field = node
        return lambda env: env[name][field]
    if kind == "filter":
        act, inner = _FILTERS[node[1]], value_of(node[2])
        return lambda env: act(str(inner(env)))
    if kind == "not":
        operand = value_of(node[1])
        return lambda env: not operand(env)
    act, left, right = _BINARY[kind], value_of(node[1]), value_of(node[2])
    return lambda env: act(left(env), right(env))


def closure(nodes: list[tuple]) -> Callable[[Env, Output], None]:
    steps = []
    for node in nodes:
        if node[0] == "text":
            steps.append((lambda get: lambda env, out: out.put(get(env)))(value_of(node[1])))
        elif node[0] == "if":
            made = value_of(node[1]), closure(node[2]), closure(node[3])
            steps.append((lambda test, then, other: lambda env, out: (then if test(env) else other)(env, out))(*made))
        elif node[0] == "generation":
            steps.append((lambda body: lambda env, out: _marked(body, env, out))(closure(node[1])))
        else:
            raise TemplateError("the loop over messages must stand alone")

    def run(env: Env, out: Output) -> None:
        for step in steps:
            step(env, out)

    return run


def _marked(body: Callable[[Env, Output], None], env: Env, out: Output) -> None:
    start = out.length
    body(env, out)
    out.spans.append((start, out.length))


def compiled(source: str) -> tuple[Callable, Callable, Callable]:
    """(head, turn, tail) closures of a template with one top-level loop."""
    tree = fold(parse(source))
    loops = [i for i, node in enumerate(tree) if node[0] == "for"]
    if len(loops) != 1:
        raise TemplateError("a template needs exactly one loop over messages")
    at = loops[0]
    return closure(tree[:at]), closure(tree[at][1]), closure(tree[at + 1 :])


# --- over conversations --------------------------------------------------------------------------------

CHUNK = "conv_id long, place long, formatted string, mask array<struct<start:int,end:int>>"
_MASK = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def format_conversations(turns: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """One row per turn: its part of the formatted conversation, and the spans of it under the loss mask.

    The head of the template is part of the first turn's row, its tail of the last one's; rows of a
    conversation are neighbours in order, and their texts joined are the formatted conversation.
    """
    compiled(template)  # errors show here, not in a task
    turns.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    empty = F.lit("")
    rows = (
        turns.select(
            F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.coalesce("role", empty).alias("role"),
            F.coalesce("text", empty).alias("text"),
        )
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
    )

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, body, tail = compiled(template)
        names = ["conv_id", "place", "formatted", "mask"]

        def chunk(row: tuple, place: int, last: bool) -> tuple:
            out = Output()
            env: Env = {"m": {"role": row[1], "text": row[2]}, "loop": {"first": not place, "last": last, "index0": place}}
            if not place:
                head(env, out)
            body(env, out)
            if last:
                tail(env, out)
            return row[0], place, "".join(out.parts), [{"start": a, "end": b} for a, b in out.spans]

        def batch_of(made: list[tuple]) -> pa.RecordBatch:
            types = [pa.int64(), pa.int64(), pa.string(), _MASK]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made, strict=True), types, strict=True)], names)

        before, place = None, 0
        for batch in batches:
            made = []
            columns = [batch.column(n).to_pylist() for n in ("conv_id", "role", "text")]
            for row in zip(*columns, strict=True):
                if before is not None:
                    last = row[0] != before[0]
                    made.append(chunk(before, place, last))
                    place = 0 if last else place + 1
                before = row
            if made:
                yield batch_of(made)
        if before is not None:
            yield batch_of([chunk(before, place, True)])

    return rows.mapInArrow(render, CHUNK)


_TURN = re.compile(r"(?:<s>)?((?:<\|turn\|>(?:.*?)<\|text\|>(?:.*?)<\|end\|>)*)(?:</s>)?", re.S)
_PARTS = re.compile(r"<\|turn\|>(.*?)<\|text\|>(.*?)<\|end\|>", re.S)
DIGEST = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)


def read_back(chunks: DataFrame) -> DataFrame:
    """What the formatted text of TEMPLATE says, one row per conversation; reads the rows in their order."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split(" ")[0] for x in DIGEST.split(", ")]
        types = [pa.string() if n.endswith("sha256") else pa.int64() for n in names]
        state: list | None = None

        def close(s: list) -> tuple:
            return s[0], s[1], s[2].hexdigest(), s[3], s[4].hexdigest(), s[5]

        def batch_of(made: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made, strict=True), types, strict=True)], names)

        for batch in batches:
            made = []
            for conv_id, place, text, mask in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if place == 0:
                    if state:
                        made.append(close(state))
                    state = [conv_id, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                whole = _TURN.fullmatch(text)
                if not whole:
                    raise ValueError(f"conversation {conv_id}: not in the format of the template")
                for role, body in _PARTS.findall(whole[1]):
                    state[1] += 1
                    state[2].update(f"{unescape(role)}\n{unescape(body)}\n".encode())
                for span in mask:
                    learned = unescape(text[span["start"] : span["end"]])
                    state[3] += len(learned)
                    state[4].update(learned.encode())
                state[5] += len(text)
            if made:
                yield batch_of(made)
        if state:
            yield batch_of([close(state)])

    return chunks.mapInArrow(read, DIGEST)


PROBE = "</s>[INST] ok [/INST]"


def op6_chat(turns: DataFrame) -> DataFrame:
    columns = ["conv_id", "turn", "role", "text"]
    probe = turns.sparkSession.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE).alias("text"),
    )
    return read_back(format_conversations(turns.select(columns).unionByName(probe)))
