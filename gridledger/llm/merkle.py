"""A Merkle manifest of a table of documents: one root, and a proof for every row.

The rows of a source are the leaves of a tree in which every 16 nodes in a row have one parent; the
roots of the sources, in order, are the leaves of a tree of the same kind. No tree is walked node by
node. An aligned block of 4,096 leaves keeps each of its levels as one hex string: substrings of 16
digests hash to the parents, whose digests joined are the string of the next level. The siblings of a
node are the two pieces of its run's substring beside it. The roots of the blocks are nodes of a tree
again, so that the same steps recurse over a table that is 4,096 times smaller each time.

Defined results: a null counts as ``-`` and stands apart from the text ``-``; null sources are one
source, the first; within a source null ids come first, and rows of one id are ordered by their
leaves; equal rows are leaves of their own, side by side; a tree of one leaf has that leaf as its
root and an empty proof. Extra columns are passed over. No rows give no rows.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridledger.llm.common import Scratch, saved
from gridledger.runtime import row_bound

#: Nodes under one parent, characters of a digest, and levels that one block holds.
FANOUT, WIDTH, LEVELS = 16, 64, 3
#: The columns that a leaf hashes, in order.
HASHED = ("doc_id", "source", "lang", "n_chars", "text")


def digest(value: Column) -> Column:
    return F.sha2(value, 256)


def encoded(value: Column) -> Column:
    """The length in bytes, a colon and the value; ``-`` for null."""
    plain = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(plain).cast("string"), F.lit(":"), plain), F.lit("-"))


def leaf(**changed: Column) -> Column:
    """The digest of a row; ``changed`` replaces columns."""
    return digest(F.concat(*(encoded(changed.get(c, F.col(c))) for c in HASHED)))


def placed(rows: DataFrame, tree: str, order: list[str], scratch: Scratch) -> DataFrame:
    """``rows`` with ``pos``, the number from 0 on in the tree, and ``n``, the rows of the tree.

    Ranges of all rows are numbered each for itself, on top of the rows of the ranges before, so that
    a tree of any size is spread over many tasks. ``order`` must tell all rows of a tree apart.
    """
    keys = [F.col(c).asc_nulls_first() for c in (tree, *order)]
    ranged = scratch.saved(rows.repartitionByRange(*keys).withColumn("part", F.spark_partition_id()), "ranges")
    sums = ranged.groupBy(F.col(tree).alias("_tree"), F.col("part").alias("_part")).agg(F.count("*").alias("size"))
    before = Window.partitionBy("_tree").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        "_tree",
        "_part",
        F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"),
        F.sum("size").over(Window.partitionBy("_tree")).alias("n"),
    )
    own = F.row_number().over(Window.partitionBy("part", tree).orderBy(*keys[1:])) - 1
    same = F.col(tree).eqNullSafe(F.col("_tree")) & (F.col("part") == F.col("_part"))
    out = ranged.withColumn("own", own).join(sums, same)
    return out.withColumn("pos", F.col("start") + F.col("own")).drop("own", "start", "part", "_tree", "_part")


def _parents(level: Column) -> Column:
    """The string of the level above: a digest for each substring of 16 digests."""
    step = FANOUT * WIDTH
    runs = F.sequence(F.lit(0), F.ceil(F.length(level) / step).cast("int") - 1)
    return F.array_join(F.transform(runs, lambda k: digest(F.substring(level, k * step + 1, F.lit(step)))), "").cast("binary")


def _beside(level: Column, at: Column) -> Column:
    """The siblings of node ``at`` of a level: the pieces of its run before and after it."""
    first = at - at % FANOUT
    left = F.substring(level, first * WIDTH + 1, (at - first) * WIDTH)
    right = F.substring(level, (at + 1) * WIDTH + 1, (first + FANOUT - 1 - at) * WIDTH)
    return F.struct(left.alias("left"), right.alias("right"))


def _names() -> list[str]:
    return [f"level_{k}" for k in range(LEVELS)]


def blocks(nodes: DataFrame, tree: str, payload: list[str], scratch: Scratch) -> DataFrame:
    """One row for each block of ``nodes`` (tree, pos, n, node, payload): its nodes (``items``), its
    levels, their number (``height``), the path ``above`` it, and the tree's ``root``."""
    size = FANOUT**LEVELS
    held = nodes.groupBy(tree, "n", F.floor(F.col("pos") / size).alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "node", *payload))).alias("items")
    )
    # A tree of one block ends where one node is left; blocks of a larger tree all have all levels.
    height = F.lit(0)
    for k in range(LEVELS):
        height = height + (F.col("n") > FANOUT**k).cast("int")
    held = held.withColumn("height", height)
    held = held.withColumn("level_0", F.array_join(F.col("items.node"), "").cast("binary"))
    for k in range(1, LEVELS + 1):
        held = held.withColumn(f"level_{k}", F.when(F.col("height") >= k, _parents(F.col(f"level_{k - 1}"))))
    top = F.coalesce(*(F.col(f"level_{k}") for k in range(LEVELS, -1, -1))).cast("string")
    held = scratch.saved(held.withColumn("top", top).drop(f"level_{LEVELS}"), "levels")
    if not held.filter(F.col("n") > size).select(F.lit(1)).take(1):
        nothing = F.expr("cast(array() AS array<struct<left: binary, right: binary>>)")
        return held.withColumns({"above": nothing, "root": F.col("top")})
    roots = held.select(tree, F.col("block").alias("pos"), F.ceil(F.col("n") / size).alias("n"), F.col("top").alias("node"))
    upper = opened(blocks(roots, tree, [], scratch), tree, [])
    upper = upper.select(F.col(tree).alias("_tree"), F.col("pos").alias("_block"), F.col("path").alias("above"), "root")
    same = F.col(tree).eqNullSafe(F.col("_tree")) & (F.col("block") == F.col("_block"))
    return held.join(upper, same).drop("_tree", "_block")


def opened(held: DataFrame, tree: str, payload: list[str]) -> DataFrame:
    """(tree, root, pos, node, payload, path): the nodes of blocks, each with its siblings level by level."""

    def with_path(item: Column, number: Column) -> Column:
        at, beside = number.cast("int"), []
        for name in _names():
            beside.append(_beside(F.col(name), at))
            at = F.floor(at / FANOUT).cast("int")
        path = F.concat(F.slice(F.array(*beside), F.lit(1), F.col("height")), F.col("above"))
        return F.struct(*(item[c].alias(c) for c in ("pos", "node", *payload)), path.alias("path"))

    return held.select(tree, "root", F.explode(F.transform("items", with_path)).alias("item")).select(
        tree, "root", "item.*"
    )


def proof_digest(path: Column) -> Column:
    """The digest of all siblings of a path, level by level and from left to right."""
    whole = F.aggregate(path, F.lit(b""), lambda held, x: F.concat(held, x["left"], x["right"]))
    return digest(whole)


def folded(path: Column, node: Column) -> Column:
    """The root that a node comes to with the siblings of a path."""
    up = F.aggregate(
        path,
        node.cast("binary"),
        lambda held, x: digest(F.concat(x["left"], held, x["right"])).cast("binary"),
    )
    return up.cast("string")


def manifest(rows: DataFrame, payload: list[str]) -> DataFrame:
    """(source, doc_id, node, payload, subroot, root, path) for each of ``rows`` (source, doc_id, node
    and the payload's columns): the root of its source's tree, that of all, and the path to it."""
    scratch = Scratch()
    # A number of its own tells equal rows apart.
    rows = rows.withColumn("_own", F.monotonically_increasing_id())
    rows = scratch.saved(rows, "leaves")
    held = blocks(
        placed(rows, "source", ["doc_id", "node", "_own"], scratch), "source", ["doc_id", *payload], scratch
    )
    held = saved(held.withColumnRenamed("root", "subroot"), "blocks")
    subroots = held.filter("block = 0").select(F.lit(0).alias("tree"), "source", F.col("subroot").alias("node"))
    sources = blocks(placed(subroots, "tree", ["source"], scratch), "tree", ["source"], scratch)
    sources = opened(sources, "tree", ["source"])
    sources = saved(sources.select(F.col("source").alias("_source"), F.col("path").alias("_path"), F.col("root").alias("_root")), "sources")
    scratch.clear()
    few = F.broadcast(sources) if row_bound(sources) else sources
    held = held.join(few, F.col("source").eqNullSafe(F.col("_source")))
    held = held.withColumns({"above": F.concat("above", "_path"), "root": F.col("_root")})
    out = opened(held.withColumn("tree", F.struct("source", "subroot")), "tree", ["doc_id", *payload])
    return out.select("tree.*", "root", "doc_id", "node", *payload, "path")


def tampered_documents(docs: DataFrame, every: int = 5) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) for each row of ``docs``.

    Rows whose crc32(doc_id) is divisible by ``every`` are tampered with: their texts' capital ASCII
    letters become small ones, and the root is folded from the leaf of that. A row without doc_id stays.
    """
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % every == 0
    rows = docs.select(
        F.col("source").cast("string").alias("source"),
        F.col("doc_id").cast("long").alias("doc_id"),
        leaf().alias("node"),
        F.when(hit, leaf(text=lowered)).alias("tampered"),
    )
    out = manifest(rows, ["tampered"])
    root = folded(F.col("path"), F.coalesce("tampered", "node"))
    return out.select(
        "doc_id",
        F.col("node").alias("leaf"),
        "subroot",
        "root",
        proof_digest(F.col("path")).alias("proof_sha256"),
        root.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
