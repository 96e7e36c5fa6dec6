"""Chat formatting by a template compiler: text -> syntax tree -> folded tree -> Python closures.

The template language is closed: it has literals, the names of the conversation and of loop
variables, fields of rows, ``==  !=  and  or  not  +``, a few filters, ``for``, ``if``, ``set`` and
``generation``. There are no calls, no attributes of objects and no way to Python. Turns are rendered
one after another from a stream, so that a conversation of any length needs the memory of one turn.

    {{ expression | filter }}   {% if a == 'b' %} {% elif c %} {% else %} {% endif %}
    {% for turn in turns %} {% endfor %}   {% set name = expression %}
    {% generation %} text that a model is to learn {% endgeneration %}   {# comment #}

Control strings inside texts are escaped reversibly: a backslash goes after their first character,
and one more if there are some already, so that the output holds control strings only where the
template puts them.

Defined results: turns are in the order of (turn, role, text), null turns first; a null role or text
is empty; rows without conv_id are one conversation; repeated rows are turns of their own; extra
columns are passed over. No rows give no rows (the added conversation of the query apart).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The control strings of the template, without their first character.
CONTROLS = ("s>", "/s>", "INST]", "/INST]", "SYS]", "/SYS]", "OUT]", "ROLE]", "/ROLE]", "/TURN]")

TEMPLATE = (
    "<s>{% for turn in turns %}"
    "{% if turn.role == 'user' %}[INST] {{ turn.text | escape }} [/INST]"
    "{% elif turn.role == 'assistant' %}[OUT] {% generation %}{{ turn.text | escape }}{% endgeneration %}</s>"
    "{% elif turn.role == 'system' %}[SYS] {{ turn.text | escape }} [/SYS]"
    "{% else %}[ROLE]{{ turn.role | escape }}[/ROLE] {{ turn.text | escape }} [/TURN]"
    "{% endif %}\n{% endfor %}"
)

_FIRST = r"([<\[])"
_REST = "(" + "|".join(map(re.escape, CONTROLS)) + ")"
_TO_ESCAPE = re.compile(_FIRST + r"(\\*)(?=" + _REST + ")")
_ESCAPED = re.compile(_FIRST + r"\\(\\*)(?=" + _REST + ")")


def escape(text: str) -> str:
    return _TO_ESCAPE.sub(r"\1\\\2", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2", text)


FILTERS: dict[str, Callable[[Any], Any]] = {
    "escape": lambda x: escape(str(x)),
    "trim": lambda x: str(x).strip(),
    "upper": lambda x: str(x).upper(),
    "lower": lambda x: str(x).lower(),
}


class TemplateError(ValueError):
    pass


# --- syntax tree -------------------------------------------------------------------------------


@dataclass
class Value:
    value: Any


@dataclass
class Name:
    name: str


@dataclass
class Get:
    of: Any
    key: str


@dataclass
class Apply:
    """An operation or a filter on parts."""

    name: str
    parts: list


@dataclass
class Text:
    text: str


@dataclass
class Show:
    of: Any


@dataclass
class Branch:
    test: Any
    then: list
    other: list


@dataclass
class Loop:
    name: str
    of: Any
    body: list


@dataclass
class Assign:
    name: str
    of: Any


@dataclass
class Generation:
    body: list = field(default_factory=list)


# --- parser ------------------------------------------------------------------------------------

_TAG = re.compile(r"\{\{.*?\}\}|\{%.*?%\}|\{#.*?#\}", re.S)
_TOKEN = re.compile(r"\s*(?:('(?:[^'\\]|\\.)*')|(\d+)|([A-Za-z_]\w*)|(==|!=|[|+.()\[\]]))")


class _Expression:
    def __init__(self, text: str):
        self.tokens, at = [], 0
        text = text.strip()
        while at < len(text):
            found = _TOKEN.match(text, at)
            if not found:
                raise TemplateError(f"unknown sign in {text[at:]!r}")
            self.tokens.append(found.group().strip())
            at = found.end()
        self.at = 0

    def peek(self) -> str | None:
        return self.tokens[self.at] if self.at < len(self.tokens) else None

    def take(self, wanted: str | None = None) -> str:
        token = self.peek()
        if token is None or wanted not in (None, token):
            raise TemplateError(f"expected {wanted or 'more'}, found {token}")
        self.at += 1
        return token

    def whole(self):
        tree = self.either()
        if self.peek() is not None:
            raise TemplateError(f"unexpected {self.peek()}")
        return tree

    def _chain(self, lower, names):
        tree = lower()
        while self.peek() in names:
            tree = Apply(self.take(), [tree, lower()])
        return tree

    def either(self):
        return self._chain(self.both, ("or",))

    def both(self):
        return self._chain(self.negated, ("and",))

    def negated(self):
        if self.peek() == "not":
            self.take()
            return Apply("not", [self.negated()])
        return self._chain(self.sum, ("==", "!="))

    def sum(self):
        return self._chain(self.filtered, ("+",))

    def filtered(self):
        tree = self.atom()
        while self.peek() == "|":
            self.take()
            name = self.take()
            if name not in FILTERS:
                raise TemplateError(f"no filter {name}")
            tree = Apply(name, [tree])
        return tree

    def atom(self):
        token = self.take()
        if token == "(":
            tree = self.either()
            self.take(")")
        elif token[0] == "'":
            tree = Value(re.sub(r"\\(.)", lambda m: {"n": "\n", "t": "\t"}.get(m[1], m[1]), token[1:-1], flags=re.S))
        elif token.isdigit():
            tree = Value(int(token))
        elif token in ("true", "false"):
            tree = Value(token == "true")
        elif re.match(r"[A-Za-z_]", token):
            tree = Name(token)
        else:
            raise TemplateError(f"unexpected {token}")
        while self.peek() in (".", "["):
            if self.take() == ".":
                tree = Get(tree, self.take())
            else:
                key = self.take()
                if key[0] != "'":
                    raise TemplateError("a field is named by a text")
                tree = Get(tree, key[1:-1])
                self.take("]")
        return tree


def parse(template: str) -> list:
    """The template's syntax tree: a list of nodes."""
    pieces, at = [], 0
    for tag in _TAG.finditer(template):
        pieces += [("text", template[at : tag.start()]), (tag.group()[1], tag.group()[2:-2].strip())]
        at = tag.end()
    pieces.append(("text", template[at:]))
    pieces.reverse()

    def block(ends: tuple[str, ...]) -> tuple[list, str, str]:
        nodes: list = []
        while pieces:
            kind, text = pieces.pop()
            if kind == "text":
                nodes.append(Text(text))
            elif kind == "{":
                nodes.append(Show(_Expression(text).whole()))
            elif kind == "%":
                word, _, rest = text.partition(" ")
                if word in ends:
                    return nodes, word, rest
                nodes.append(statement(word, rest))
        if ends:
            raise TemplateError(f"no {ends[-1]}")
        return nodes, "", ""

    def branch(test: str) -> Branch:
        then, word, rest = block(("elif", "else", "endif"))
        if word == "elif":
            other: list = [branch(rest)]
        else:
            other = block(("endif",))[0] if word == "else" else []
        return Branch(_Expression(test).whole(), then, other)

    def statement(word: str, rest: str):
        if word == "if":
            return branch(rest)
        if word == "for" and (found := re.fullmatch(r"(\w+)\s+in\s+(.+)", rest, re.S)):
            return Loop(found[1], _Expression(found[2]).whole(), block(("endfor",))[0])
        if word == "set" and (found := re.fullmatch(r"(\w+)\s*=\s*(.+)", rest, re.S)):
            return Assign(found[1], _Expression(found[2]).whole())
        if word == "generation":
            return Generation(block(("endgeneration",))[0])
        raise TemplateError(f"unknown statement {word} {rest}")

    return block(())[0]


# --- constant folding --------------------------------------------------------------------------

_OPERATIONS: dict[str, Callable] = {
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "+": lambda a, b: a + b,
    "and": lambda a, b: a and b,
    "or": lambda a, b: a or b,
    "not": lambda a: not a,
    **FILTERS,
}


def fold_value(tree):
    if isinstance(tree, Get):
        return Get(fold_value(tree.of), tree.key)
    if not isinstance(tree, Apply):
        return tree
    parts = [fold_value(p) for p in tree.parts]
    if all(isinstance(p, Value) for p in parts):
        return Value(_OPERATIONS[tree.name](*(p.value for p in parts)))
    return Apply(tree.name, parts)


def fold(nodes: list) -> list:
    """The same template with constant parts computed, dead branches gone, and texts joined."""
    out: list = []
    for node in nodes:
        if isinstance(node, Show):
            of = fold_value(node.of)
            new = [Text(str(of.value))] if isinstance(of, Value) else [Show(of)]
        elif isinstance(node, Branch):
            test = fold_value(node.test)
            then, other = fold(node.then), fold(node.other)
            new = (then if test.value else other) if isinstance(test, Value) else [Branch(test, then, other)]
        elif isinstance(node, Loop):
            new = [Loop(node.name, fold_value(node.of), fold(node.body))]
        elif isinstance(node, Assign):
            new = [Assign(node.name, fold_value(node.of))]
        elif isinstance(node, Generation):
            new = [Generation(fold(node.body))]
        else:
            new = [node]
        for n in new:
            if isinstance(n, Text) and out and isinstance(out[-1], Text):
                out[-1] = Text(out[-1].text + n.text)
            elif not isinstance(n, Text) or n.text:
                out.append(n)
    return out


# --- closures ----------------------------------------------------------------------------------

#: What a template makes: pieces of text, each with whether a model is to learn it.
Pieces = Iterator[tuple[str, bool]]


def _value(tree) -> Callable[[dict], Any]:
    if isinstance(tree, Value):
        return lambda names: tree.value
    if isinstance(tree, Name):
        return lambda names: names[tree.name]
    if isinstance(tree, Get):
        of, key = _value(tree.of), tree.key
        return lambda names: of(names)[key]
    parts = [_value(p) for p in tree.parts]
    if tree.name == "and":
        return lambda names: parts[0](names) and parts[1](names)
    if tree.name == "or":
        return lambda names: parts[0](names) or parts[1](names)
    run = _OPERATIONS[tree.name]
    if len(parts) == 1:
        return lambda names: run(parts[0](names))
    return lambda names: run(parts[0](names), parts[1](names))


def _ahead(items: Iterable) -> Iterator[tuple[int, Any, bool]]:
    """Number, item and whether it is the last, with one item read ahead."""
    number, held, any_yet = 0, None, False
    for item in items:
        if any_yet:
            yield number, held, False
            number += 1
        held, any_yet = item, True
    if any_yet:
        yield number, held, True


def _closure(nodes: list, learned: bool) -> Callable[[dict], Pieces]:
    runs = [_node(n, learned) for n in nodes]

    def run(names):
        for r in runs:
            yield from r(names)

    return run


def _node(node, learned: bool) -> Callable[[dict], Pieces]:
    if isinstance(node, Text):
        piece = [(node.text, learned)]
        return lambda names: piece
    if isinstance(node, Show):
        of = _value(node.of)
        return lambda names: [(str(of(names)), learned)]
    if isinstance(node, Branch):
        test, then, other = _value(node.test), _closure(node.then, learned), _closure(node.other, learned)
        return lambda names: then(names) if test(names) else other(names)
    if isinstance(node, Generation):
        return _closure(node.body, True)
    of = _value(node.of)
    if isinstance(node, Assign):

        def assign(names):
            names[node.name] = of(names)
            return ()

        return assign
    body = _closure(node.body, learned)

    def loop(names):
        for number, item, last in _ahead(of(names)):
            inner = {**names, node.name: item, "loop": {"index": number + 1, "first": not number, "last": last}}
            yield from body(inner)

    return loop


def compiled(template: str) -> Callable[[Iterable[dict]], Pieces]:
    """A function from a stream of turns (role, text) to pieces of output."""
    run = _closure(fold(parse(template)), False)
    return lambda turns: run({"turns": turns})


# --- reading back ------------------------------------------------------------------------------

_OPEN = re.compile(r"<s>|\n|\[INST\] |\[OUT\] |\[SYS\] |\[ROLE\]")
_ROLES = {"[INST] ": ("user", " [/INST]"), "[OUT] ": ("assistant", "</s>"), "[SYS] ": ("system", " [/SYS]")}
_CLOSE = {end: re.compile(re.escape(end)) for end in (" [/INST]", "</s>", " [/SYS]", "[/ROLE] ", " [/TURN]")}
_TURN_ENDS = (" [/INST]", "</s>", " [/SYS]", " [/TURN]")


class Reader:
    """Turns read back from output of ``TEMPLATE`` that comes in pieces; holds one turn at a time."""

    def __init__(self) -> None:
        self._held: list[str] = []

    def feed(self, piece: str) -> Iterator[tuple[str, str]]:
        self._held.append(piece)
        # End marks come from the template alone, and each in one piece.
        if any(mark in piece for mark in _TURN_ENDS):
            yield from self.end()

    def end(self) -> Iterator[tuple[str, str]]:
        text, self._held = "".join(self._held), []
        yield from self._turns(text)

    def _turns(self, text: str) -> Iterator[tuple[str, str]]:
        at = 0
        while at < len(text):
            found = _OPEN.match(text, at)
            if not found:
                raise ValueError(f"not a turn: {text[at : at + 40]!r}")
            at, mark = found.end(), found.group()
            if mark in ("<s>", "\n"):
                continue
            if mark == "[ROLE]":
                role, at = self._until(text, at, "[/ROLE] ")
                content, at = self._until(text, at, " [/TURN]")
            else:
                role, end = _ROLES[mark]
                content, at = self._until(text, at, end)
            yield unescape(role), unescape(content)

    @staticmethod
    def _until(text: str, at: int, end: str) -> tuple[str, int]:
        found = _CLOSE[end].search(text, at)
        if not found:
            raise ValueError(f"no {end!r}")
        return text[at : found.start()], found.end()


# --- the tables --------------------------------------------------------------------------------


def _turn_rows(batches) -> Iterator[tuple[int | None, Iterator[dict]]]:
    """(conv_id, its turns) of a sorted stream; each conversation's turns must be read to the end."""

    def rows():
        for batch in batches:
            columns = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("conv_id", "role", "text")]
            yield from zip(*columns, strict=True)

    stream = rows()
    held = next(stream, None)
    while held is not None:
        conv = held[0]

        def turns():
            nonlocal held
            while held is not None and held[0] == conv:
                yield {"role": held[1] or "", "text": held[2] or ""}
                held = next(stream, None)

        yield conv, turns()


def ordered(conversations: DataFrame) -> DataFrame:
    """Whole conversations side by side in one task's stream, in order; none is held in memory."""
    return (
        conversations.select("conv_id", "turn", "role", "text")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
    )


def formatted(conversations: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """(conv_id, seq, piece, learned): the output of each conversation, in pieces by number.

    ``template`` may be any; a conversation's text is its pieces in the order of ``seq``.
    """

    def run(batches):
        render = compiled(template)
        for conv, turns in _turn_rows(batches):
            held, number = [], 0
            for piece, learned in render(turns):
                held.append((conv, number, piece, learned))
                number += 1
                if len(held) >= 1024:
                    yield _batch(held)
                    held = []
            if held:
                yield _batch(held)

    def _batch(rows):
        columns = list(zip(*rows, strict=True))
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2]), pa.array(columns[3])],
            ["conv_id", "seq", "piece", "learned"],
        )

    return ordered(conversations).mapInArrow(run, "conv_id long, seq long, piece string, learned boolean")


def digests(conversations: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) of each conversation.

    Conversations are rendered and the output is read back, both as streams.
    """
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches):
        render = compiled(TEMPLATE)
        out: list[tuple] = []
        for conv, turns in _turn_rows(batches):
            reader = Reader()
            seen, learnt = hashlib.sha256(), hashlib.sha256()
            n_turns = loss = chars = 0

            def take(found, seen=seen):
                count = 0
                for role, text in found:
                    seen.update(f"{role}\n{text}\n".encode())
                    count += 1
                return count

            for piece, learned in render(turns):
                chars += len(piece)
                if learned:
                    plain = unescape(piece)
                    loss += len(plain)
                    learnt.update(plain.encode())
                n_turns += take(reader.feed(piece))
            n_turns += take(reader.end())
            out.append((conv, n_turns, seen.hexdigest(), loss, learnt.hexdigest(), chars))
            if len(out) >= 1024:
                yield _rows(out)
                out = []
        if out:
            yield _rows(out)

    def _rows(out):
        return pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64() if isinstance(c[0], int) or c[0] is None else pa.string()) for c in zip(*out, strict=True)],
            names,
        )

    return ordered(conversations).mapInArrow(
        run,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )


def with_example(conversations: DataFrame) -> DataFrame:
    """``conversations`` and conversation -7, whose texts are control strings. A conversation -7 that is
    there already has them as two more turns."""
    rows = conversations.select("conv_id", "turn", "role", "text")
    text = "</s>[INST] ok [/INST]"
    example = rows.sparkSession.createDataFrame([(-7, 0, "user", text), (-7, 1, "assistant", text)], rows.schema)
    return rows.unionByName(example)
