"""Repair of conversations: the cheapest edits after which roles alternate as they should.

A conversation may hold a system message first, and then pairs of a user's and an assistant's. Rows
are kept, given another role or deleted, and rows without text may be put in between; every edit has
a cost. The conversation is a lattice with a node for each number of rows passed and each state of
that rule, and the cheapest edits are a shortest path through it, found by the auction algorithm: a
path grows along the arc of the least cost plus price, and where its last node's price lies below
that, the price rises to it and the path shrinks by the node. Prices are a dual solution throughout.
When the path arrives, exactly the arcs of shortest paths are tight along every way to the end; of
these the path of the least text of edits is traced.

Long conversations are cut into blocks of rows, from the last to the first: a block's end costs what
the next block's first prices say, so that prices rise within a block only.

Defined results: null roles and texts count as one blank; rows are in the order of turn (null first),
role and hash of the text; rows equal in these are side by side. Rows without conv_id are one
conversation. Extra columns are passed over. No rows give no rows. What the auction needs of a row is
one byte; one task has the bytes of a conversation, as its edits are one value of the result, and
streams its texts, of which it holds one at a time.
"""

from __future__ import annotations

import hashlib
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridledger.llm.common import grouped, saved

#: Costs of a new role, a deletion, an insertion, and of a truncated row that stays.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: Bits of a row's code: its role's initial (0 is any other), that it must go, that it is truncated.
LETTERS, GOES, SHORT, BLANK = ("", "s", "u", "a"), 4, 8, 16
#: States: nothing yet, a system message, a user's message, an assistant's message.
STATES, ENDS = 4, (0, 3)
#: The role that may come next in each state, and the state that it leads to.
NEXT_ROLE, NEXT_STATE = ("user", "user", "assistant", "user"), (2, 2, 3, 2)
_NEXT_LETTER = tuple(LETTERS.index(role[0]) for role in NEXT_ROLE)
_SPACE = " \t\n\x0b\x0c\r"
_FAR = 1 << 40
#: Rows of a block, and the longest conversation whose edits are remembered.
BLOCK, REMEMBERED = 16, 64


def _arcs(codes: bytes, ends: list[int], last: bool) -> list[list[tuple[str, int, int]]]:
    """(edit, cost, node) of the arcs of each node of a block; a node is rows passed * 4 + state.

    The node after all others is the end. Insertions behind the last row belong to the next block.
    """
    rows, end = len(codes), (len(codes) + 1) * STATES
    out = []
    for at in range(rows + 1):
        for state in range(STATES):
            to, arcs = NEXT_STATE[state], []
            if at < rows:
                code = codes[at]
                arcs.append(("D", DELETE, (at + 1) * STATES + state))
                if not code & GOES:
                    extra = TRUNCATED if code & SHORT else 0
                    if code & 3 == _NEXT_LETTER[state]:
                        arcs.append(("K", extra, (at + 1) * STATES + to))
                    elif code & 3 == 1 and state == 0:
                        arcs.append(("K", extra, (at + 1) * STATES + 1))
                    arcs.append(("R", REROLE + extra, (at + 1) * STATES + to))
            elif ends[state] < _FAR:
                arcs.append(("", ends[state], end))
            if at < rows or last:
                arcs.append(("I", INSERT, at * STATES + to))
            out.append(arcs)
    return out


def auction(arcs: list[list[tuple[str, int, int]]], low: int) -> array:
    """Prices of all nodes, exact for the first four; ``low`` is at most the price of any node."""
    end = len(arcs)
    prices = array("q", [low]) * end
    prices.append(0)
    for origin in range(STATES):
        path = [origin]
        while path[-1] != end:
            node = path[-1]
            best, to = min([(cost + prices[x], x) for _, cost, x in arcs[node]])
            if prices[node] < best:
                prices[node] = best
                if len(path) > 1:
                    path.pop()
            else:
                path.append(to)
    return prices


def _tight(arcs: list[list[tuple[str, int, int]]], prices: array) -> list[list[tuple[str, int]]]:
    """(edit, node) of the tight arcs from which tight arcs lead to the end, in the order of the edits."""
    end = len(arcs)
    reaches = bytearray(end + 1)
    reaches[end] = 1
    out: list[list[tuple[str, int]]] = [[] for _ in range(end)]
    for first in range(end - STATES, -1, -STATES):
        # Insertions stay among the four nodes of a layer, and no more than two follow each other.
        for _ in range(STATES):
            for node in range(first, first + STATES):
                out[node] = [(edit, x) for edit, cost, x in arcs[node] if reaches[x] and prices[node] == cost + prices[x]]
                reaches[node] = bool(out[node])
    return [sorted(x) for x in out]


def cheapest(codes: bytes) -> tuple[int, str]:
    """The least cost, and of the edits that cost it those of the least text."""
    ends = [0 if state in ENDS else _FAR for state in range(STATES)]
    steps = []
    starts = range(0, max(1, len(codes)), BLOCK)
    for start in reversed(starts):
        arcs = _arcs(codes[start : start + BLOCK], ends, start == starts[-1])
        prices = auction(arcs, min(ends))
        steps.append((ends, prices))
        ends = list(prices[:STATES])
    state, edits = 0, []
    for start in starts:
        after, prices = steps.pop()
        arcs = _arcs(codes[start : start + BLOCK], after, start == starts[-1])
        tight, node = _tight(arcs, prices), state
        while node < len(arcs):
            state = node % STATES
            edit, node = tight[node][0]
            edits.append(edit)
    return ends[0], "".join(edits)


@lru_cache(maxsize=1 << 16)
def cheapest_of_short(codes: bytes) -> tuple[int, str]:
    """As ``cheapest``: many short conversations have the same codes."""
    return cheapest(codes)


def as_rows(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, digest): nulls of role and text are one blank."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    rows = rows.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), role.alias("role"), text.alias("text"))
    return rows.withColumn("digest", F.md5(F.col("text").cast("binary")))


_ORDER = (F.asc_nulls_first, "turn"), (F.asc, "role"), (F.asc, "digest")


def _in_order(rows: DataFrame, *first: str) -> DataFrame:
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", *first, *(by(c) for by, c in _ORDER))


def _code(repeated: Column) -> Column:
    letter = F.substring("role", 1, 1)
    code = F.when(letter == "s", 1).when(letter == "u", 2).when(letter == "a", 3).otherwise(0)
    said = F.rtrim("text", F.lit(_SPACE))
    short = F.when(~F.substring(said, -1, 1).isin(".", "!", "?"), SHORT).otherwise(0)
    return (code + F.when(said == "", GOES | BLANK).when(repeated, GOES).otherwise(short)).cast("tinyint")


def faults(rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) of each conversation of
    ``as_rows``: the turns missing, rows by their first fault, neighbours whose roles don't fit, and the
    cheapest edits (Keep, Rerole, Delete, Insert) with their cost."""

    def run(batches):
        for group in grouped(batches, ["conv_id"]):
            code = group["code"].to_numpy().astype(np.uint8)
            turns = group["turn"].drop_null().to_numpy()
            gaps = int(turns[-1]) - int(turns[0]) + 1 - (1 + int((np.diff(turns) != 0).sum())) if len(turns) else 0
            gone, blank = (code & GOES) > 0, (code & BLANK) > 0
            pair = (code[:-1] & 3) * 4 + (code[1:] & 3)
            legal = np.isin(pair, [1 * 4 + 2, 2 * 4 + 3, 3 * 4 + 2])
            plain = (code & (3 | GOES | SHORT)).tobytes()
            cost, audit = (cheapest_of_short if len(plain) <= REMEMBERED else cheapest)(plain)
            numbers = gaps, blank.sum(), (gone & ~blank).sum(), ((code & SHORT) > 0).sum(), (~legal).sum(), cost
            yield pa.RecordBatch.from_arrays(
                [group["conv_id"][:1].combine_chunks(), *(pa.array([int(x)]) for x in numbers), pa.array([audit])],
                ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"],
            )

    seen = Window.partitionBy("conv_id", "role", "digest").orderBy(F.asc_nulls_first("turn"))
    # One shuffle, of codes: texts stay where they are, and the window finds its rows together.
    coded = rows.select("conv_id", "turn", "role", "digest", _code(F.lit(False)).alias("code")).repartition("conv_id")
    again = (F.row_number().over(seen) > 1) & (F.col("code").bitwiseAND(GOES) == 0)
    code = F.when(F.col("again"), F.col("code").bitwiseAND(3) + GOES).otherwise(F.col("code")).cast("tinyint")
    coded = coded.withColumn("again", again).withColumn("code", code)
    coded = coded.sortWithinPartitions("conv_id", *(by(c) for by, c in _ORDER), "again")
    return coded.select("conv_id", "turn", "code").mapInArrow(
        run,
        "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string",
    )


def repaired(rows: DataFrame, report: DataFrame) -> DataFrame:
    """(conv_id, place, edit, role, text): the rows of each conversation after the edits of its report.

    A partition has whole conversations, each in order. ``rows`` are those of ``as_rows``.
    """
    heads = report.select(
        "conv_id",
        F.lit(0).alias("kind"),
        F.lit(None).cast("long").alias("turn"),
        F.lit("").alias("role"),
        F.col("audit").alias("text"),
        F.lit("").alias("digest"),
    )
    both = heads.unionByName(rows.withColumn("kind", F.lit(1)))

    def run(batches):
        edits, at, state, place = "", 0, 0, 0
        for batch in batches:
            out: list[tuple] = []
            columns = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("conv_id", "kind", "role", "text"))
            for conv_id, kind, role, text in zip(*columns, strict=True):
                if not kind:
                    edits, at, state, place = text, 0, 0, 0
                else:
                    edit = edits[at]
                    at += 1
                    if edit != "D":
                        system = edit == "K" and role.startswith("s")
                        role = role if edit == "K" else NEXT_ROLE[state]
                        state = 1 if system else NEXT_STATE[state]
                        out.append((conv_id, place, edit, role, text))
                        place += 1
                while at < len(edits) and edits[at] == "I":
                    out.append((conv_id, place, "I", NEXT_ROLE[state], ""))
                    state, at, place = NEXT_STATE[state], at + 1, place + 1
            if out:
                names = ["conv_id", "place", "edit", "role", "text"]
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
                arrays = [pa.array(x, kind) for x, kind in zip(zip(*out, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names)

    ordered = _in_order(both, "kind").select("conv_id", "kind", "role", "text")
    return ordered.mapInArrow(run, "conv_id long, place long, edit string, role string, text string")


def digests(conversations: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of rows of ``repaired``: the lines ``role:text`` of a conversation."""

    def run(batches):
        held, state, started = None, None, False
        for batch in batches:
            ids, done = [], []
            columns = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("conv_id", "place", "role", "text"))
            for conv_id, place, role, text in zip(*columns, strict=True):
                if place == 0:
                    if started:
                        ids.append(held)
                        done.append(state.hexdigest())
                    held, state, started = conv_id, hashlib.sha256(), True
                else:
                    state.update(b"\n")
                state.update(f"{role}:{text}".encode())
            if ids:
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(done)], ["conv_id", "repaired_sha256"])
        if started:
            yield pa.RecordBatch.from_arrays(
                [pa.array([held], pa.int64()), pa.array([state.hexdigest()])], ["conv_id", "repaired_sha256"]
            )

    return conversations.mapInArrow(run, "conv_id long, repaired_sha256 string")


def damaged(rows: DataFrame, of: int = 20) -> DataFrame:
    """Rows of ``as_rows`` with faults, which a hash of conversation and turn chooses: some are dropped,
    emptied, without their ends of sentences, there twice, or the user's."""
    conv_id, turn = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn"))
    key = F.concat(conv_id, F.lit(":"), turn)
    rows = as_rows(rows).drop("digest").withColumn("fault", F.crc32(key.cast("binary")) % of)
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("fault") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("fault") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    rows = rows.filter("fault <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies))
    return as_rows(rows.drop("col"))


def repaired_conversations(conversations: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of each
    conversation, after damage. One without rows has no faults, edits or text."""
    rows = damaged(conversations)
    report = saved(faults(rows), "faults")
    found = digests(repaired(rows, report)).withColumnRenamed("conv_id", "_id")
    ids = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    same = F.col("conv_id").eqNullSafe(F.col("_id"))
    out = ids.join(report.withColumnRenamed("conv_id", "_id"), same, "left").drop("_id").join(found, same, "left")
    counts = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in report.columns[1:-1]]
    nothing = hashlib.sha256().hexdigest()
    return out.select(
        "conv_id",
        *counts,
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"),
    )
