"""Chat formatting: a sandboxed template language, compiled to Python closures.

A template is text with ``{{ expression }}``, ``{% tag %}`` and ``{# comment #}``:

* ``{% for m in messages %} ... {% endfor %}``, once, at the top: the turns; inside, ``loop.index0``,
  ``loop.first`` and ``loop.last``; ``m.role`` and ``m.text`` are all that a turn has
* ``{% if e %} ... {% elif e %} ... {% else %} ... {% endif %}``; ``{% set name = e %}`` for constants before the turns
* ``{% generation %} ... {% endgeneration %}``: what the model learns to say (the loss mask)
* ``{% control 'a', 'b' %}``: the control strings, which ``| escape`` breaks up in a text
* expressions: strings, integers, true, false, none, names, ``~`` ``+`` ``-`` ``==`` ``!=`` ``<`` ``<=`` ``>``
  ``>=`` ``and`` ``or`` ``not`` ``in`` and the filters ``escape trim upper lower length``

It is sandboxed by having nothing else: no calls, no attributes but those, no loop but the one over
the turns, nested at most ``MOST_DEPTH`` deep and ``MOST_TEMPLATE`` characters long; whatever is unknown
fails when the template is compiled.  The text is parsed to a syntax tree, constants are folded
(also conditions, whose dead branches go, and neighbouring text), and the tree becomes
closures that write a turn to a list.  From the same tree comes the reader: a pattern that finds
the turns in formatted text and undoes the escapes.  It needs branches that begin with different
control strings, and fields that are escaped and closed by a control string; other templates render, but have no reader.

``escape`` is reversible: a backslash becomes two, and a single one is put behind the first character
of every control string in the text (also where the text's first or last characters could
make one with what the template writes next to them), so that escaped text holds none.

On Spark the rows of all conversations are numbered over a range partitioning by conversation and
turn, so that a conversation with any share of all rows is formatted by many tasks: a turn needs only its
place.  The output is written (a piece per turn, with the spans of the loss mask), and reading it
back streams the pieces of each conversation in order.  A SHA-256 is a chain over the whole
conversation, so this last step has one task per conversation, which holds a turn at a time.

A null text is empty, a null role is an empty one, a null conv_id is a conversation of its own; null turns come
first.  Rows of the same turn are ordered by role and text; repeated rows are turns.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import process_cache, slices, written

MOST_TEMPLATE = 1 << 16
MOST_DEPTH = 16
KEY_CHARS = 64            # of a text that take part in the range partitioning
SLICE = 4 << 20
DEFAULT = """\
{%- control '<s>', '</s>', '[INST]', '[/INST]', '<<SYS>>', '<</SYS>>', '[ROLE]', '[TEXT]', '[/TEXT]' -%}
{%- set bos = '<s>' -%}{%- set eos = '</s>' -%}
{%- for m in messages -%}
{%- if m.role == 'user' -%}
{{ bos ~ '[INST] ' }}{{ m.text | escape }}{{ ' [/INST]' }}
{%- elif m.role == 'assistant' -%}
{{ bos ~ ' ' }}{% generation %}{{ m.text | escape }}{% endgeneration %}{{ eos }}
{%- elif m.role == 'system' -%}
{{ '<<SYS>>' }}{{ m.text | escape }}{{ '<</SYS>>' }}
{%- else -%}
{{ '[ROLE]' }}{{ m.role | escape }}{{ '[TEXT]' }}{{ m.text | escape }}{{ '[/TEXT]' }}
{%- endif -%}
{%- endfor -%}"""


class TemplateError(ValueError):
    """The template can't be compiled, or has no reader."""


# ---- escapes -------------------------------------------------------------------

class Escape:
    """Breaks up control strings, reversibly."""

    def __init__(self, controls: tuple[str, ...]):
        for c in controls:
            if len(c) < 2 or "\\" in c:
                raise TemplateError(f"a control string has two characters or more and no backslash: {c!r}")
        self.controls = controls
        begins = [re.escape(c[0]) + "(?=" + re.escape(c[1:]) + ")" for c in controls]
        self.found = re.compile("|".join(["\\\\", *begins]))
        self.heads = tuple({c[:n] for c in controls for n in range(1, len(c))})     # text can end with one ...
        self.tails = tuple({c[n:] for c in controls for n in range(1, len(c))})     # ... or begin with one

    def __call__(self, text: str) -> str:
        out = self.found.sub(lambda m: m[0] + "\\", text)
        if not out:
            return out
        inside = len(text) <= max(map(len, self.controls), default=0) and any(text in c for c in self.controls)
        before = "\\" if inside or text.startswith(self.tails) else ""
        return before + out + ("\\" if text.endswith(self.heads) else "")

    @staticmethod
    def undo(text: str) -> str:
        """The backslash that breaks a control string goes, a double one is one."""
        return UNDO.sub(lambda m: "\\" if m[0] == "\\\\" else "", text) if "\\" in text else text


UNDO = re.compile(r"\\\\|\\")


# ---- syntax tree ---------------------------------------------------------------

class Const(NamedTuple):
    value: object


class Name(NamedTuple):
    path: str                   # m.role, m.text, loop.index0, loop.first, loop.last


class Op(NamedTuple):
    name: str
    parts: tuple


class Text(NamedTuple):
    text: str


class Put(NamedTuple):
    value: object               # an expression


class If(NamedTuple):
    branches: tuple             # ((condition, body), ...); the last condition may be Const(True)


class Generation(NamedTuple):
    body: tuple


class Template(NamedTuple):
    head: tuple
    turn: tuple
    tail: tuple
    escape: Escape


TOKEN = re.compile(r"\{#.*?#\}|\{\{-?(?P<put>.*?)-?\}\}|\{%(?P<left>-?)(?P<tag>.*?)(?P<right>-?)%\}", re.S)
LEXEME = re.compile(r"\s*(?:(?P<string>'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(?P<number>\d+)|(?P<name>[A-Za-z_][A-Za-z_0-9.]*)"
                    r"|(?P<mark>==|!=|<=|>=|[~+\-<>()|,=]))")
BACKSLASHED = {"n": "\n", "t": "\t", "r": "\r"}
FILTERS: dict[str, Callable] = {"trim": lambda x: x.strip(), "upper": lambda x: x.upper(), "lower": lambda x: x.lower(), "length": len}
TWO: dict[str, Callable] = {
    "~": lambda a, b: text_of(a) + text_of(b), "+": lambda a, b: a + b, "-": lambda a, b: a - b, "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b, "<": lambda a, b: a < b, "<=": lambda a, b: a <= b, ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b, "in": lambda a, b: a in b}
CONSTANTS = {"true": True, "false": False, "none": None}
LOOP = ("loop.index0", "loop.first", "loop.last")


def text_of(value: object) -> str:
    return "" if value is None else str(value)


class Expressions:
    """Recursive descent over the lexemes of one expression; constants are folded on the way."""

    def __init__(self, source: str, names: dict[str, Const], turn: str | None, escape: Escape):
        self.lexemes, at = [], 0
        source = source.strip()
        while at < len(source):
            m = LEXEME.match(source, at)
            if not m:
                raise TemplateError(f"unexpected {source[at:at + 10]!r}")
            self.lexemes.append((m.lastgroup, m[m.lastgroup]))
            at = m.end()
        self.at, self.names, self.turn, self.escape, self.depth = 0, names, turn, escape, 0

    def next_is(self, *words: str) -> bool:
        return self.at < len(self.lexemes) and self.lexemes[self.at][0] != "string" and self.lexemes[self.at][1] in words

    def take(self) -> tuple[str, str]:
        if self.at == len(self.lexemes):
            raise TemplateError("an expression ends too early")
        self.at += 1
        return self.lexemes[self.at - 1]

    def whole(self) -> object:
        out = self.either()
        if self.at < len(self.lexemes):
            raise TemplateError(f"unexpected {self.lexemes[self.at][1]!r}")
        return out

    def either(self) -> object:
        self.depth += 1
        if self.depth > MOST_DEPTH:
            raise TemplateError("an expression is nested too deep")
        out = self.both()
        while self.next_is("or"):
            self.take()
            out = fold(Op("or", (out, self.both())))
        self.depth -= 1
        return out

    def both(self) -> object:
        out = self.negated()
        while self.next_is("and"):
            self.take()
            out = fold(Op("and", (out, self.negated())))
        return out

    def negated(self) -> object:
        turns = 0
        while self.next_is("not"):
            self.take()
            turns += 1
        out = self.compared()
        for _ in range(turns):
            out = fold(Op("not", (out,)))
        return out

    def compared(self) -> object:
        out = self.joined()
        while self.next_is("==", "!=", "<", "<=", ">", ">=", "in"):
            name = self.take()[1]
            out = fold(Op(name, (out, self.joined())))
        return out

    def joined(self) -> object:
        out = self.filtered()
        while self.next_is("~", "+", "-"):
            name = self.take()[1]
            out = fold(Op(name, (out, self.filtered())))
        return out

    def filtered(self) -> object:
        out = self.single()
        while self.next_is("|"):
            self.take()
            kind, name = self.take()
            if kind != "name" or name not in (*FILTERS, "escape"):
                raise TemplateError(f"no filter {name!r}")
            out = fold(Op("|" + name, (out,)), self.escape)
        return out

    def single(self) -> object:
        kind, word = self.take()
        if kind == "string":
            return Const(re.sub(r"\\(.)", lambda m: BACKSLASHED.get(m[1], m[1]), word[1:-1], flags=re.S))
        if kind == "number":
            return Const(int(word))
        if word == "(":
            out = self.either()
            if self.take()[1] != ")":
                raise TemplateError("a bracket is not closed")
            return out
        if kind == "name":
            if word in CONSTANTS:
                return Const(CONSTANTS[word])
            if word in self.names:
                return self.names[word]
            if self.turn and word in LOOP:
                return Name(word)
            if self.turn and word in (f"{self.turn}.role", f"{self.turn}.text"):
                return Name("m" + word[len(self.turn):])
        raise TemplateError(f"nothing is called {word!r}")


def fold(op: Op, escape: Escape | None = None) -> object:
    """An operation on constants as its value; and / or with a constant left side as one of the sides."""
    first = op.parts[0]
    if op.name in ("and", "or") and isinstance(first, Const):
        return op.parts[1] if bool(first.value) == (op.name == "and") else first
    if not all(isinstance(p, Const) for p in op.parts):
        return op
    try:
        return Const(closure(op, escape)({}))
    except TypeError as e:
        raise TemplateError(f"{op.name} of {[p.value for p in op.parts]}: {e}") from e


class Parser:
    """Tags and text to the syntax tree."""

    def __init__(self, source: str):
        if len(source) > MOST_TEMPLATE:
            raise TemplateError("the template is too long")
        self.parts: list[tuple[str, str]] = []
        at, trim = 0, False
        for m in TOKEN.finditer(source):
            text = source[at:m.start()]
            text = text.lstrip() if trim else text
            trim = False
            if m["tag"] is not None:
                text = text.rstrip() if m["left"] else text
                trim = bool(m["right"])
            if text:
                self.parts.append(("text", text))
            if m["put"] is not None:
                self.parts.append(("put", m["put"]))
            elif m["tag"] is not None:
                self.parts.append(("tag", m["tag"].strip()))
            at = m.end()
        text = source[at:].lstrip() if trim else source[at:]
        if text:
            self.parts.append(("text", text))
        self.at, self.names, self.turn, self.depth = 0, {}, None, 0
        self.escape = Escape(())
        self.loops: list[tuple] = []

    def expression(self, source: str) -> object:
        return Expressions(source, self.names, self.turn, self.escape).whole()

    def parse(self) -> Template:
        body, _ = self.body(())
        places = [k for k, node in enumerate(body) if node == "turns"]
        if len(places) != 1:
            raise TemplateError("a template has one loop over messages, at the top")
        return Template(merged(body[:places[0]]), self.loops[0], merged(body[places[0] + 1:]), self.escape)

    def body(self, ends: tuple[str, ...]) -> tuple[list, str]:
        """Nodes up to a tag that begins with one of ``ends``, and that tag."""
        out: list = []
        self.depth += 1
        if self.depth > MOST_DEPTH:
            raise TemplateError("the template is nested too deep")
        while self.at < len(self.parts):
            kind, source = self.parts[self.at]
            self.at += 1
            if kind == "text":
                out.append(Text(source))
            elif kind == "put":
                value = self.expression(source)
                out.append(Text(text_of(value.value)) if isinstance(value, Const) else Put(value))
            else:
                word, _, rest = source.partition(" ")
                if word in ends:
                    self.depth -= 1
                    return out, source
                out += self.tag(word, rest)
        if ends:
            raise TemplateError(f"{ends[-1]} is missing")
        return out, ""

    def tag(self, word: str, rest: str) -> list:
        if word == "control":
            found = [self.expression(x) for x in re.findall(r"'[^']*'|\"[^\"]*\"", rest)]
            if self.turn or self.loops or not found:
                raise TemplateError("control strings are named before the turns")
            self.escape = Escape(tuple(dict.fromkeys(c.value for c in found)))
            return []
        if word == "set":
            name, eq, source = rest.partition("=")
            value = self.expression(source) if eq else None
            if self.turn or not re.fullmatch(r"\s*[A-Za-z_]\w*\s*", name) or not isinstance(value, Const):
                raise TemplateError("set names a constant, outside the turns")
            self.names[name.strip()] = value
            return []
        if word == "for":
            m = re.fullmatch(r"([A-Za-z_]\w*) in messages", rest.strip())
            if not m or self.turn or self.depth != 1 or self.loops:
                raise TemplateError("the one loop is over messages, at the top")
            self.turn = m[1]
            body, _ = self.body(("endfor",))
            self.turn = None
            self.loops.append(merged(body))
            return ["turns"]
        if word == "if":
            branches, tag = [], "if " + rest
            while tag != "endif":
                word, _, rest = tag.partition(" ")
                condition = Const(True) if word == "else" else self.expression(rest)
                body, tag = self.body(("endif",) if word == "else" else ("elif", "else", "endif"))
                branches.append((condition, merged(body)))
            return pruned(branches)
        if word == "generation":
            return [Generation(merged(self.body(("endgeneration",))[0]))]
        raise TemplateError(f"no tag {word!r}")


def pruned(branches: list[tuple[object, tuple]]) -> list:
    """An if without the branches that constants rule out; its body alone, if only one can be taken."""
    left = []
    for condition, body in branches:
        if isinstance(condition, Const) and not condition.value:
            continue
        left.append((condition, body))
        if isinstance(condition, Const):
            break
    if left and isinstance(left[0][0], Const):
        return list(left[0][1])
    return [If(tuple(left))] if left else []


def merged(nodes: list) -> tuple:
    """Neighbouring texts as one."""
    out: list = []
    for node in nodes:
        if isinstance(node, Text) and out and isinstance(out[-1], Text):
            out[-1] = Text(out[-1].text + node.text)
        else:
            out.append(node)
    return tuple(out)


# ---- closures ------------------------------------------------------------------

def closure(node: object, escape: Escape | None) -> Callable[[dict], object]:
    """An expression as a function of the scope."""
    if isinstance(node, Const):
        return lambda scope: node.value
    if isinstance(node, Name):
        return lambda scope: scope[node.path]
    parts = [closure(p, escape) for p in node.parts]
    if node.name == "|escape":
        return lambda scope: escape(text_of(parts[0](scope)))
    if node.name.startswith("|"):
        work = FILTERS[node.name[1:]]
        return lambda scope: work(text_of(parts[0](scope)))
    if node.name == "not":
        return lambda scope: not parts[0](scope)
    a, b = parts
    if node.name == "and":
        return lambda scope: a(scope) and b(scope)
    if node.name == "or":
        return lambda scope: a(scope) or b(scope)
    work = TWO[node.name]
    return lambda scope: work(a(scope), b(scope))


class Out:
    """What has been written, and the spans of it that are generated (code points)."""

    def __init__(self):
        self.parts: list[str] = []
        self.size = 0
        self.spans: list[tuple[int, int]] = []

    def put(self, text: str) -> None:
        self.parts.append(text)
        self.size += len(text)


def writer(nodes: tuple, escape: Escape) -> Callable[[dict, Out], None]:
    """Nodes as a function that writes them."""
    steps = [_step(node, escape) for node in nodes]

    def run(scope: dict, out: Out) -> None:
        for step in steps:
            step(scope, out)

    return run


def _step(node: object, escape: Escape) -> Callable[[dict, Out], None]:
    if isinstance(node, Text):
        return lambda scope, out: out.put(node.text)
    if isinstance(node, Put):
        value = closure(node.value, escape)
        return lambda scope, out: out.put(text_of(value(scope)))
    if isinstance(node, Generation):
        body = writer(node.body, escape)

        def generation(scope: dict, out: Out) -> None:
            start = out.size
            body(scope, out)
            out.spans.append((start, out.size))

        return generation
    branches = [(closure(c, escape), writer(body, escape)) for c, body in node.branches]

    def choose(scope: dict, out: Out) -> None:
        for condition, body in branches:
            if condition(scope):
                return body(scope, out)

    return choose


class Compiled:
    """A template as closures: ``turn`` renders one turn by its place, ``render`` a conversation."""

    def __init__(self, source: str = DEFAULT):
        self.tree = Parser(source).parse()
        escape = self.tree.escape
        self._head, self._turn, self._tail = (writer(nodes, escape) for nodes in self.tree[:3])

    def turn(self, role: str | None, text: str | None, index: int, last: bool) -> tuple[str, list[tuple[int, int]]]:
        """(text, generated spans) of a turn, with what stands before the first and after the last."""
        out = Out()
        if index == 0:
            self._head({}, out)
        self._turn({"m.role": role or "", "m.text": text or "", "loop.index0": index, "loop.first": index == 0, "loop.last": last}, out)
        if last:
            self._tail({}, out)
        return "".join(out.parts), out.spans

    def render(self, turns: list[tuple[str | None, str | None]]) -> tuple[str, list[tuple[int, int]]]:
        """(text, generated spans) of the turns (role, text) of a conversation; '' without turns."""
        parts, spans, at = [], [], 0
        for k, (role, text) in enumerate(turns):
            piece, own = self.turn(role, text, k, k + 1 == len(turns))
            parts.append(piece)
            spans += [(a + at, b + at) for a, b in own]
            at += len(piece)
        return "".join(parts), spans


# ---- reading back --------------------------------------------------------------

class Reader:
    """Finds turns in formatted text, by the pattern that the template's tree gives."""

    def __init__(self, tree: Template):
        self.escape = tree.escape
        self.fields: list[tuple[int, str | None, bool]] = []        # of each branch: first group, role, text before role
        nodes = tree.turn
        branches = nodes[0].branches if len(nodes) == 1 and isinstance(nodes[0], If) else ((Const(True), nodes),)
        heads, patterns, groups = [], [], 0
        for condition, body in branches:
            role, names, pattern, closed = _role(condition), [], "", True
            for node in flat(body):
                if isinstance(node, Text):
                    if not closed and not any(c in node.text for c in self.escape.controls):
                        raise TemplateError("a field is not closed by a control string")
                    pattern, closed = pattern + re.escape(node.text), True
                elif isinstance(node, Put) and node.value in ESCAPED and closed:
                    names.append(ESCAPED[node.value])
                    pattern, closed = pattern + "(.*?)", False
                else:
                    raise TemplateError(f"not readable: {node}")
            first = next(iter(flat(body)), None)
            if not closed or not isinstance(first, Text) or not any(c in first.text for c in self.escape.controls):
                raise TemplateError("a turn begins and ends with a control string")
            if sorted(names) != (["text"] if role is not None else ["role", "text"]):
                raise TemplateError("a turn holds its text once, and its role unless the condition says it")
            heads.append(first.text)
            patterns.append(pattern)
            self.fields.append((groups + 1, role, names[0] == "role"))
            groups += len(names)
        if any(a != b and (b.startswith(a) or a.startswith(b)) or heads.count(a) > 1 for a in heads for b in heads):
            raise TemplateError("turns of different kinds begin alike")
        for nodes in (tree.head, tree.tail):
            if not all(isinstance(node, Text) for node in nodes):
                raise TemplateError("what stands around the turns is not constant")
        self.head, self.tail = ("".join(n.text for n in nodes) for nodes in (tree.head, tree.tail))
        self.pattern = re.compile("|".join(patterns), re.S)

    def turn(self, m: re.Match) -> tuple[str, str]:
        """(role, text) of a match."""
        first, role, role_first = next(f for f in reversed(self.fields) if m[f[0]] is not None)
        if role is not None:
            return role, self.escape.undo(m[first])
        at = (first, first + 1) if role_first else (first + 1, first)
        return self.escape.undo(m[at[0]]), self.escape.undo(m[at[1]])

    def read(self, pieces: Iterator[str]) -> Iterator[tuple[str, str]]:
        """Turns of one conversation, given as pieces of text cut anywhere; holds what is not yet read."""
        held, begun, seen = "", False, 0
        for piece in pieces:
            held += piece
            if not begun:
                if len(held) < len(self.head):
                    continue
                if not held.startswith(self.head):
                    raise ValueError("the text does not begin as the template does")
                held, begun = held[len(self.head):], True
            if len(held) < 2 * seen:                       # a long turn in many pieces: look again when it has doubled
                continue
            at = 0
            while m := self.pattern.match(held, at):
                yield self.turn(m)
                at = m.end()
            held = held[at:]
            seen = len(held)
        at = 0
        while m := self.pattern.match(held, at):
            yield self.turn(m)
            at = m.end()
        if held[at:] != self.tail:
            raise ValueError(f"not a turn: {held[at:at + 40]!r}")


ESCAPED = {Op("|escape", (Name("m.role"),)): "role", Op("|escape", (Name("m.text"),)): "text"}


def _role(condition: object) -> str | None:
    """The role of a branch for role == constant."""
    if isinstance(condition, Op) and condition.name == "==":
        for a, b in (condition.parts, condition.parts[::-1]):
            if a == Name("m.role") and isinstance(b, Const) and isinstance(b.value, str):
                return b.value
    if condition != Const(True):
        raise TemplateError("turns are told apart by their role alone")
    return None


def flat(body: tuple) -> list:
    """The nodes of a branch, those of generation markers among them, texts merged."""
    out: list = []
    for node in body:
        out += flat(node.body) if isinstance(node, Generation) else [node]
    return list(merged(out))


def compiled(source: str) -> tuple[Compiled, Reader]:
    cache = process_cache()
    key = f"template {source}"
    if key not in cache:
        template = Compiled(source)
        cache[key] = template, Reader(template.tree)
    return cache[key]


# ---- Spark ---------------------------------------------------------------------

def placed_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, place, last, role, text): turns numbered within their conversation.

    Rows are range-partitioned by conversation, turn, role and the text's first characters (ties beyond these
    share a task and are sorted there), so no conversation need fit a task.  A conversation's turns are
    numbered in each partition; only conversations that go on in the next partition need more, one for each
    partition at most: the rows before and whether any follow, which are broadcast.
    """
    kind = dict(conversations.dtypes)["conv_id"]
    rows = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
                                F.coalesce("text", F.lit("")).alias("text"))
    keys = ["conv_id", "turn", "role", "begin"]
    ordered = (rows.withColumn("begin", F.substring("text", 1, KEY_CHARS)).repartitionByRange(*keys)
               .sortWithinPartitions(*keys, "text")
               .select("conv_id", F.spark_partition_id().alias("part"), "role", "text"))
    turns = written(ordered.mapInArrow(_numbered, f"conv_id {kind}, part int, place long, last boolean, role string, text string"), "turns")
    ends = turns.filter("last").select(F.col("conv_id").alias("conv"), F.col("part").alias("in"), (F.col("place") + 1).alias("n"))
    several = ends.groupBy("conv").agg(F.count(F.lit(1)).alias("parts")).filter("parts > 1").select(F.col("conv").alias("id"))
    own = Window.partitionBy("conv")
    before = own.orderBy("in").rowsBetween(Window.unboundedPreceding, -1)
    crossing = (ends.join(several, ends["conv"].eqNullSafe(several["id"])).select(
        "conv", "in", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"), (F.col("in") == F.max("in").over(own)).alias("ends")))
    same = turns["conv_id"].eqNullSafe(crossing["conv"]) & (turns["part"] == crossing["in"])
    return turns.join(F.broadcast(crossing), same, "left").select(
        "conv_id", (F.col("place") + F.coalesce("before", F.lit(0))).alias("place"),
        (F.col("last") & F.coalesce("ends", F.lit(True))).alias("last"), "role", "text")


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Place of each row among its conversation's in this partition, and whether it is the last of these."""
    names = ["conv_id", "part", "place", "last", "role", "text"]
    held, places, ids = None, [], []

    def made(after: list) -> pa.RecordBatch:
        last = [a != b for a, b in zip(ids, ids[1:])] + [not after or after[0] != ids[-1]]
        return pa.RecordBatch.from_arrays([held.column(0), held.column(1), pa.array(places, pa.int64()), pa.array(last, pa.bool_()),
                                           held.column(2), held.column(3)], names=names)

    at, current = -1, object()
    for batch in batches:
        if not batch.num_rows:
            continue
        new = batch.column("conv_id").to_pylist()
        if held is not None:
            yield made(new)
        held, places, ids = batch, [], new
        for i in new:
            at, current = (at + 1, current) if i == current else (0, i)
            places.append(at)
    if held is not None:
        yield made([])


def format_conversations(conversations: DataFrame, template: str = DEFAULT) -> DataFrame:
    """(conv_id, place, formatted, spans): the formatted text of every conversation, a piece per turn in
    order of ``place``; ``spans`` are the generated (start, end) of a piece, in code points."""
    compiled(template)                                     # errors show here

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, _ = compiled(template)
        for batch in slices(batches, "text", SLICE):
            made = [own.turn(role, text, place, last) for place, last, role, text in zip(*(c.to_pylist() for c in batch.columns[1:]))]
            spans = pa.array([[{"start": a, "end": b} for a, b in s] for _, s in made],
                             pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("place"), pa.array([f for f, _ in made], pa.string()), spans],
                                             names=["conv_id", "place", "formatted", "spans"])

    kind = dict(conversations.dtypes)["conv_id"]
    return placed_turns(conversations).mapInArrow(
        run, f"conv_id {kind}, place long, formatted string, spans array<struct<start: long, end: long>>")


def read_back(formatted: DataFrame, template: str = DEFAULT) -> DataFrame:
    """One row per conversation: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, reader = compiled(template)
        out: list[tuple] = []
        kind_of = None

        def rows() -> Iterator[tuple]:
            nonlocal kind_of
            for some in slices(batches, "formatted", SLICE):
                kind_of = some.column("conv_id").type
                yield from zip(*(c.to_pylist() for c in some.columns))

        def conversation(first: tuple, rest: Iterator[tuple]) -> tuple | None:
            """Reads one conversation from its first row on; returns the row after it."""
            turns, loss = hashlib.sha256(), hashlib.sha256()
            n_turns = loss_chars = chars = 0
            after = None

            def pieces() -> Iterator[str]:
                nonlocal loss_chars, chars, after
                row = first
                while row is not None and row[0] == first[0]:
                    _, _, text, spans = row
                    chars += len(text)
                    for span in spans:
                        said = Escape.undo(text[span["start"]:span["end"]])
                        loss.update(said.encode())
                        loss_chars += len(said)
                    yield text
                    row = next(rest, None)
                after = row

            for role, text in reader.read(pieces()):
                n_turns += 1
                turns.update(f"{role}\n{text}\n".encode())
            out.append((first[0], n_turns, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))
            return after

        def batch_of() -> pa.RecordBatch:
            kinds = (kind_of, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            made = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)
            out.clear()
            return made

        source = rows()
        row = next(source, None)
        while row is not None:
            row = conversation(row, source)
            if len(out) >= 10_000:
                yield batch_of()
        if out:
            yield batch_of()

    kind = dict(formatted.dtypes)["conv_id"]
    schema = f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    names = [c.split()[0] for c in schema.split(", ")]
    ordered = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "place")
    return ordered.mapInArrow(run, schema)


def planted(spark: SparkSession, like: DataFrame) -> DataFrame:
    """Conversation -1, whose texts are control strings."""
    text = "</s>[INST] ok [/INST]"
    rows = [(-1, 0, "user", text), (-1, 1, "assistant", text)]
    kinds = dict(like.dtypes)
    return spark.createDataFrame(rows, ", ".join(f"{c} {kinds[c]}" for c in ("conv_id", "turn", "role", "text")))


def round_trip(conversations: DataFrame, template: str = DEFAULT) -> DataFrame:
    """Format all conversations to the shared folder and read the written text back."""
    return read_back(written(format_conversations(conversations, template), "formatted"), template)
