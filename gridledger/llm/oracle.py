"""SQL, for another engine, of the queries whose steps have a fixed number of levels or states."""

from __future__ import annotations

from gridledger.llm import merkle, repair


def crc32(text: str) -> str:
    """crc32 of an ASCII text, bit by bit: each step shifts, the first of eight takes in a byte."""
    steps = f"list_transform(range(8 * len({text})), lambda i: CASE WHEN i % 8 = 0 THEN ascii(substr({text}, i // 8 + 1, 1)) ELSE 0 END)"
    shift = "(xor(c, b) >> 1), CASE WHEN xor(c, b) & 1 = 1 THEN 3988292384 ELSE 0 END"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform({steps}, lambda x: x::BIGINT)), lambda c, b: xor({shift})), 4294967295)"


#: Levels that are written out: enough for 16^5 rows of a source, and as many sources.
DEPTH = 5


def _climb(name: str, tree: str, start: str) -> str:
    """Levels of each tree of ``start`` (tree, pos, node), and each node's siblings in them."""
    out, fan = "", merkle.FANOUT
    run = f"PARTITION BY {tree}, pos // {fan} ORDER BY pos"
    for k in range(DEPTH + 1):
        of = start if k == 0 else f"{name}{k - 1}"
        rows = f"SELECT {tree}, pos, node FROM {of}" if k == 0 else (
            f"SELECT {tree}, pos // {fan} AS pos, CASE WHEN max(total) = 1 THEN min(node) "
            f"ELSE sha256(string_agg(node, '' ORDER BY pos)) END AS node FROM {of} GROUP BY {tree}, pos // {fan}"
        )
        out += f""",
{name}{k} AS (
  SELECT *, count(*) OVER (PARTITION BY {tree}) AS total,
         coalesce(string_agg(node, '') OVER ({run} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
         coalesce(string_agg(node, '') OVER ({run} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM ({rows}))"""
    return out


def _folds(name: str, tree: str, of: str, out: str) -> str:
    """``of`` (tree, pos, proof, acc) with the siblings of each level added and folded in."""
    sql = ""
    for k in range(DEPTH):
        sql += f""",
{out}{k} AS (
  SELECT f.* REPLACE (f.proof || x.l || x.r AS proof,
                      CASE WHEN x.total > 1 THEN sha256(x.l || f.acc || x.r) ELSE f.acc END AS acc)
  FROM {of if k == 0 else f"{out}{k - 1}"} f
  JOIN {name}{k} x ON f.{tree} IS NOT DISTINCT FROM x.{tree} AND f.pos // {merkle.FANOUT**k} = x.pos)"""
    return sql


def _merkle() -> str:
    def encoded(column: str) -> str:
        plain = f"CAST({column} AS VARCHAR)"
        return f"coalesce(strlen({plain})::VARCHAR || ':' || {plain}, '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(encoded(text if c == "text" else c) for c in merkle.HASHED) + ")"

    capitals, small = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
WITH rows AS (
  SELECT doc_id, source, {leaf("text")} AS node, {leaf(f"translate(text, '{capitals}', '{small}')")} AS lowered,
         coalesce({crc32("CAST(doc_id AS VARCHAR)")} % 5 = 0, false) AS tampered
  FROM documents),
start AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, node) - 1 AS pos FROM rows){_climb("n", "source", "start")},
subroots AS (
  SELECT 0 AS tree, source, node, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos FROM n{DEPTH}){_climb("s", "tree", "subroots")},
own AS (
  SELECT doc_id, source, node AS leaf, pos, '' AS proof, CASE WHEN tampered THEN lowered ELSE node END AS acc
  FROM start){_folds("n", "source", "own", "f")},
upper AS (
  SELECT f.* REPLACE (s.pos AS pos), s.node AS subroot, s.tree FROM f{DEPTH - 1} f
  JOIN subroots s ON f.source IS NOT DISTINCT FROM s.source){_folds("s", "tree", "upper", "g")}
SELECT doc_id, leaf, subroot, t.node AS root, sha256(proof) AS proof_sha256, acc AS folded_root, acc = t.node AS verified
FROM g{DEPTH - 1} CROSS JOIN s{DEPTH} t"""


def _repair() -> str:
    """The cheapest edits by rows, as texts of cost and edits for each state, and then their effect."""

    def add(value: str, cost: str, edit: str) -> str:
        return f"(lpad(CAST(CAST(substr({value}, 1, 9) AS INT) + {cost} AS VARCHAR), 9, '0') || substr({value}, 10) || '{edit}')"

    def kept(state: int, role: str) -> str:
        return f"CASE WHEN NOT goes AND letter = '{role}' THEN {add(f'v{state}', 'extra', 'K')} END"

    def given(state: int) -> str:
        return f"CASE WHEN NOT goes THEN {add(f'v{state}', f'{repair.REROLE} + extra', 'R')} END"

    def inserted(state: str) -> str:
        return add(state, str(repair.INSERT), "I")

    after = {
        0: [],
        1: [kept(0, "s")],
        2: [f(q, *x) for q in (0, 1, 3) for f, x in ((given, ()), (kept, ("u",)))],
        3: [given(2), kept(2, "a")],
    }
    states = ", ".join(
        f"least({', '.join([add(f'v{q}', str(repair.DELETE), 'D'), *ways])}, NULL) AS n{q}" for q, ways in after.items()
    )
    blanks = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
WITH RECURSIVE source AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key
  FROM conversations),
chosen AS (SELECT *, {crc32("key")} % 20 AS fault FROM source),
damaged AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
         CASE fault WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(range(CASE fault WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM chosen),
numbered AS (
  SELECT conv_id, turn, role, text, substr(role, 1, 1) AS letter, rtrim(text, {blanks}) AS said,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS idx
  FROM damaged),
seen AS (SELECT *, idx > min(idx) OVER (PARTITION BY conv_id, role, text) AS again FROM numbered),
marked AS (
  SELECT *, said = '' AS blank, said <> '' AND again AS duplicate,
         said <> '' AND NOT again AND right(said, 1) NOT IN ('.', '!', '?') AS truncated,
         said = '' OR again AS goes, lag(letter) OVER (PARTITION BY conv_id ORDER BY idx) || letter AS pair
  FROM seen),
ids AS (SELECT DISTINCT conv_id FROM conversations),
walk AS (
  SELECT conv_id, 0::BIGINT AS idx, '000000000' AS v0, CAST(NULL AS VARCHAR) AS v1, '000000005I' AS v2, '000000010II' AS v3
  FROM ids
  UNION ALL
  SELECT conv_id, idx, n0, n1, least(m2, {inserted("m3")}), m3
  FROM (SELECT *, least(n3, {inserted("m2")}) AS m3
        FROM (SELECT *, least(n2, {inserted("n0")}, {inserted("n1")}, {inserted("n3")}) AS m2
              FROM (SELECT w.conv_id, m.idx, {states}
                    FROM walk w JOIN (SELECT *, CASE WHEN truncated THEN {repair.TRUNCATED} ELSE 0 END AS extra FROM marked) m
                      ON m.conv_id IS NOT DISTINCT FROM w.conv_id AND m.idx = w.idx + 1)))),
best AS (SELECT conv_id, arg_max(least(v0, v3), idx) AS best FROM walk GROUP BY conv_id),
edits AS (SELECT conv_id, CAST(substr(best, 1, 9) AS BIGINT) AS cost, substr(best, 10) AS audit FROM best),
letters AS (SELECT conv_id, audit, unnest(range(1, len(audit) + 1)) AS k FROM edits),
steps AS (
  SELECT conv_id, k, substr(audit, k, 1) AS edit, k - (len(substr(audit, 1, k)) - len(replace(substr(audit, 1, k), 'I', ''))) AS idx,
         k - (len(substr(audit, 1, k)) - len(replace(substr(audit, 1, k), 'D', ''))) AS place
  FROM letters),
left_over AS (
  SELECT s.conv_id, place, edit, m.role, CASE WHEN edit = 'I' THEN '' ELSE m.text END AS text,
         bool_or(edit = 'K' AND letter = 's') OVER (PARTITION BY s.conv_id) AS has_system
  FROM steps s LEFT JOIN marked m ON edit <> 'I' AND m.conv_id IS NOT DISTINCT FROM s.conv_id AND m.idx = s.idx
  WHERE edit <> 'D'),
lines AS (
  SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role
                                  WHEN (place - CASE WHEN has_system THEN 1 ELSE 0 END) % 2 = 1 THEN 'user'
                                  ELSE 'assistant' END || ':' || text, chr(10) ORDER BY place) AS lines
  FROM left_over GROUP BY conv_id),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate,
         count(*) FILTER (truncated) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM marked GROUP BY conv_id)
SELECT i.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, e.cost, e.audit,
       sha256(coalesce(lines, '')) AS repaired_sha256
FROM ids i
JOIN edits e ON e.conv_id IS NOT DISTINCT FROM i.conv_id
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM i.conv_id
LEFT JOIN lines l ON l.conv_id IS NOT DISTINCT FROM i.conv_id"""


ORACLE_SQL = {"op11_merkle_manifest": _merkle(), "op12_conversation_repair": _repair()}
