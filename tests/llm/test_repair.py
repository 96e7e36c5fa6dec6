"""Repair of conversations: the auction against plain dynamic programming, the query against SQL."""

import hashlib
import random
import re
import zlib

import duckdb
from conftest import rows

from brute import FOLDER
from gridledger.llm import repair
from gridledger.llm.queries import ORACLE_SQL, QUERIES

KIND = "conv_id long, turn long, role string, text string"
EDGES = [
    (1, None, None, None),
    (1, None, "user", "Same. "),
    (1, 3, "user", "Same. "),
    (1, 3, "assistant", "Tie?"),
    (1, 3, "assistant", "A tie!"),
    (1, 9, "tool", "no end"),
    (None, 1, "system", "Be good."),
    (None, 2, "user", "é\n"),
    (None, None, None, "x"),
    (2, 1, "", ""),
    (4, 1, "user", "word " * 40_000 + "."),
    (4, 1, "user", "word " * 40_000 + "."),
    (4, 2, "assistant", "Yes."),
    (5, 7, "system", "Only this."),
]


def plain(codes):
    """The least (cost, edits) by states, row by row."""
    to = (2, 2, 3, 2)

    def put(layer, state, value):
        layer[state] = min(layer.get(state, value), value)

    def with_insertions(layer):
        for _ in range(4):
            for state, (cost, edits) in list(layer.items()):
                put(layer, to[state], (cost + 5, edits + "I"))
        return layer

    layer = with_insertions({0: (0, "")})
    for code in codes:
        extra, after = 5 if code & 8 else 0, {}
        for state, (cost, edits) in layer.items():
            put(after, state, (cost + 2, edits + "D"))
            if not code & 4:
                put(after, to[state], (cost + 1 + extra, edits + "R"))
                if code & 3 == to[state]:
                    put(after, to[state], (cost + extra, edits + "K"))
                if code & 3 == 1 and state == 0:
                    put(after, 1, (cost + extra, edits + "K"))
        layer = with_insertions(after)
    return min(layer[state] for state in (0, 3) if state in layer)


def expected(table):
    def blank(v):
        return " " if v is None else v

    conversations = {}
    for r in table:
        conversations.setdefault(r[0], []).append(r)
    out = []
    for conv_id, members in conversations.items():
        held = []
        for _, turn, role, text in members:
            kind = zlib.crc32(f"{blank(conv_id)}:{blank(turn)}".encode()) % 20
            role, text = blank(role), blank(text)
            text = {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text)
            held += [(turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
        held.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), hashlib.md5(x[2].encode()).hexdigest()))
        turns = [t for t, _, _ in held if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        counts, codes, seen = [0, 0, 0], [], set()
        for _, role, text in held:
            said, code = text.strip(" \t\n\x0b\x0c\r"), {"s": 1, "u": 2, "a": 3}.get(role[:1], 0)
            fault = 0 if not said else 1 if (role, text) in seen else 2 if said[-1] not in ".!?" else None
            if fault is not None:
                counts[fault] += 1
                code |= (4, 4, 8)[fault]
            seen.add((role, text))
            codes.append(code)
        initials = [role[:1] for _, role, _ in held]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, edits = plain(codes)
        lines, at, legal = [], 0, ""
        for edit in edits:
            role, text = ("assistant" if legal.endswith("u") else "user"), ""
            if edit != "I":
                _, own, text = held[at]
                at += 1
                role = own if edit == "K" else role
            if edit != "D":
                lines.append(f"{role}:{text}")
                legal += role[0]
        assert re.fullmatch("(s?(ua)+)?", legal)
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out.append((conv_id, gaps, *counts, illegal, cost, edits, digest))
    return sorted(out, key=repr)


def test_auction_finds_the_least_edits():
    choose = random.Random(5)
    for size in [*range(10), 15, 16, 17, 31, 33, 60, 200]:
        for _ in range(40 if size < 60 else 8):
            codes = bytes(choose.choice([0, 1, 2, 3, 2, 3, 2, 3, 6, 11, 10, 4, 9]) for _ in range(size))
            assert repair.cheapest(codes) == plain(codes)


def test_prices_are_a_dual_solution():
    codes = bytes([2, 2, 3, 1, 10, 3, 6, 3])
    arcs = repair._arcs(codes, [0, repair._FAR, repair._FAR, 0], True)
    prices = repair.auction(arcs, 0)
    assert all(prices[node] <= cost + prices[to] for node, out in enumerate(arcs) for _, cost, to in out)
    assert prices[0] == plain(codes)[0]


def test_long_conversation():
    cost, edits = repair.cheapest(bytes([3]) * 5000)
    assert (cost, edits) == (2500, "RK" * 2500)


def test_conversations(spark):
    table = spark.read.parquet(f"{FOLDER}/conversations.parquet")
    assert rows(repair.repaired_conversations(table)) == expected([tuple(r) for r in table.collect()])


def test_odd_rows_and_clashing_names(spark):
    data = EDGES + [(c, t, "user" if t % 2 else "assistant", f"{t} of {c}.") for c in range(20, 60) for t in range(5)]
    table = spark.createDataFrame(data, KIND)
    clashing = table.selectExpr("*", "1 AS digest", "2 AS code", "3 AS again", "4 AS kind", "5 AS place", "'e' AS edit", "6 AS fault")
    found = rows(repair.repaired_conversations(clashing))
    assert found == expected(data)
    assert rows(repair.repaired_conversations(spark.createDataFrame([], KIND))) == []


def test_conversation_without_rows(spark):
    dropped = next(k for k in range(1000) if zlib.crc32(f"{k}:1".encode()) % 20 == 0)
    found = rows(repair.repaired_conversations(spark.createDataFrame([(dropped, 1, "user", "Hm.")], KIND)))
    assert found == [(dropped, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())]


def test_repaired_rows(spark):
    table = repair.as_rows(spark.createDataFrame([(1, 1, "assistant", "Hello."), (1, 2, "user", " "), (1, 3, "user", "So?")], KIND))
    report = repair.faults(table)
    assert [(r.cost, r.audit) for r in report.collect()] == [plain(bytes([3, 6, 2]))]
    found = [(r.place, r.edit, r.role, r.text) for r in repair.repaired(table, report).collect()]
    edits = report.first().audit
    assert len(found) == len(edits.replace("D", "")) and [r[2] for r in found] == ["user", "assistant"] * (len(found) // 2)


def test_sql(spark):
    duck = duckdb.connect()
    for table in (spark.read.parquet(f"{FOLDER}/conversations.parquet"), spark.createDataFrame(EDGES, KIND)):
        duck.register("given", table.toArrow())
        duck.sql("CREATE OR REPLACE VIEW conversations AS SELECT * FROM given")
        answer = duck.sql(ORACLE_SQL["op12_conversation_repair"])
        df = repair.repaired_conversations(table)
        assert answer.columns == df.columns and sorted(answer.fetchall(), key=repr) == rows(df)
    assert "op12_conversation_repair" in QUERIES
