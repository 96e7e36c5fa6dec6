"""The Merkle manifest against trees that are built node by node, and against its SQL."""

import hashlib
import zlib

import duckdb
import pytest
from conftest import plan, rows

from brute import FOLDER, ROWS
from gridledger.llm import merkle
from gridledger.llm.queries import ORACLE_SQL, QUERIES

EDGES = [
    (None, None, None, None, None),
    (None, None, None, None, None),
    (3, "-", "-", "-", 0),
    (5, "ABC", "en", "b", 3),
    (5, "ABC", "en", "b", 3),
    (5, "other Text", "en", "b", 3),
    (25, "no capitals", "en", None, 3),
    (6, "", "", "", None),
    (7, "Long " * 60_000, "en", "é", 5),
    (-10, "x", "en", "Z", 5),
]


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tree(nodes):
    """The root, and for each node the texts left and right of it on every level."""
    at, paths = list(range(len(nodes))), [[] for _ in nodes]
    while len(nodes) > 1:
        for k, path in enumerate(paths):
            first = at[k] - at[k] % 16
            path.append(("".join(nodes[first : at[k]]), "".join(nodes[at[k] + 1 : first + 16])))
            at[k] //= 16
        nodes = [sha(*nodes[i : i + 16]) for i in range(0, len(nodes), 16)]
    return nodes[0], paths


def expected(table):
    def leaf(r, text):
        values = (r.doc_id, r.source, r.lang, r.n_chars, text)
        return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))

    sources = {}
    for r in table:
        own, changed = leaf(r, r.text), None
        if r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and r.text is not None:
            changed = leaf(r, "".join(c.lower() if c.isascii() else c for c in r.text))
        sources.setdefault(r.source, []).append((r.doc_id is not None, r.doc_id or 0, own, changed or own, r.doc_id))
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = [tree([x[2] for x in sorted(sources[s])]) for s in order]
    root, above = tree([x[0] for x in trees])
    out = []
    for source, (subroot, paths), last in zip(order, trees, above, strict=True):
        for (_, _, own, changed, doc_id), path in zip(sorted(sources[source]), paths, strict=True):
            up = changed
            for left, right in path + last:
                up = sha(left, up, right)
            out.append((doc_id, own, subroot, root, sha(*(x for pair in path + last for x in pair)), up, up == root))
    return sorted(out, key=repr)


@pytest.mark.parametrize("levels", [1, 3])
def test_manifest(spark, monkeypatch, levels):
    monkeypatch.setattr(merkle, "LEVELS", levels)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    found = rows(merkle.tampered_documents(docs))
    assert found == expected(docs.collect())
    assert 0 < sum(not r[-1] for r in found) < len(found)


@pytest.mark.parametrize("count", [1, 2, 16, 17, 256, 257])
def test_sizes_of_trees(spark, monkeypatch, count):
    monkeypatch.setattr(merkle, "LEVELS", 1)
    docs = spark.range(count).selectExpr("id AS doc_id", "string(id) AS text", "'en' AS lang", "'s' AS source", "id AS n_chars")
    assert rows(merkle.tampered_documents(docs)) == expected(docs.collect())


def test_odd_rows_and_clashing_names(spark):
    table = spark.createDataFrame(EDGES, ROWS)
    clashing = table.selectExpr("*", "1 AS pos", "'t' AS tree", "2 AS n", "'r' AS root", "'p' AS part", "'l' AS leaf", "3 AS node")
    found = rows(merkle.tampered_documents(clashing))
    assert found == expected(table.collect())
    assert rows(merkle.tampered_documents(spark.createDataFrame([], ROWS))) == []


def test_many_sources(spark, monkeypatch):
    monkeypatch.setattr(merkle, "LEVELS", 1)
    docs = spark.range(600).selectExpr("id AS doc_id", "'A' AS text", "'en' AS lang", "concat('s', id % 300) AS source", "id AS n_chars")
    assert rows(merkle.tampered_documents(docs)) == expected(docs.collect())


def test_sql(spark):
    duck = duckdb.connect()
    duck.sql(f"CREATE VIEW documents AS SELECT * FROM '{FOLDER}/documents.parquet'")
    answer = duck.sql(ORACLE_SQL["op11_merkle_manifest"])
    df = QUERIES["op11_merkle_manifest"](spark, FOLDER)
    assert answer.columns == df.columns and sorted(answer.fetchall(), key=repr) == rows(df)
    duck.register("odd", spark.createDataFrame(EDGES, ROWS).toArrow())
    duck.sql("CREATE OR REPLACE VIEW documents AS SELECT * FROM odd")
    answer = sorted(duck.sql(ORACLE_SQL["op11_merkle_manifest"]).fetchall(), key=repr)
    assert answer == rows(merkle.tampered_documents(spark.createDataFrame(EDGES, ROWS)))


def test_steps_are_sql(spark):
    assert "Python" not in plan(QUERIES["op11_merkle_manifest"](spark, FOLDER))
