"""Near-duplicate vectors: int8 tile products with an error bound per vector, then components.

A vector x of length one is stored as scale * q + rest, with q in -127..127. For two of them

    |x . y - scale_x scale_y q_x . q_y| <= |rest_x| (1 + |rest_y|) + |rest_y|

so that the product of the small integers decides all pairs but those within this bound of the
threshold, and only these are computed again in double precision. The integer products are exact:
matrix products of small whole numbers in single precision, cut into pieces that can't exceed 2^24.

Vectors are compared within their label, in pairs of tiles. Equal vectors are one class and are
compared once. All tiles of a label meet each other, so that the work within a label is quadratic by
nature. Tiles travel in parts of many, as many as keep the cores busy and a part within the bytes that
a task may hold: each vector is copied once for every part of its label, and a pair of parts sends on
counts of links by vector and a forest of links, never pairs.

Defined results: vectors that are null or empty, have length zero, or hold null or non-finite
components, and rows without label or vec_id, are linked with nothing; vectors of different
dimensions are never linked; a row is its own component and kept unless linked to a smaller vec_id;
rows that repeat a vec_id count as vectors of their own for ``n_links`` and share a component if
linked; a row without vec_id is kept and has no component. Extra columns are passed over.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridledger.llm.common import Scratch, block_pairs, by_group, forest, saved, spread
from gridledger.llm.components import components

THRESHOLD = 0.98
#: Vectors of a tile, and rows of a tile that are multiplied at a time.
TILE, STRIP = 2048, 256
#: Bytes of the vectors of a part, and pairs of parts for each core.
PART_BYTES, TASKS_PER_CORE = 32 << 20, 3
#: More than the rounding errors of the bound and of the products in double precision.
SLACK = 1e-9


def packed(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, vector): the components as 64-bit floats, or null if they can't be linked."""

    def run(batches):
        for batch in batches:
            ids, labels, vectors = (batch.column(batch.schema.get_field_index(c)) for c in ("vec_id", "label", "embedding"))
            out = []
            for v, label, own in zip(vectors.to_pylist(), labels.to_pylist(), ids.to_pylist(), strict=True):
                if not v or label is None or own is None or None in v:
                    out.append(None)
                    continue
                x = np.array(v, np.float64) + 0.0  # minus zero becomes zero
                good = np.isfinite(x).all() and (x != 0).any()
                out.append(x.tobytes() if good else None)
            yield pa.RecordBatch.from_arrays([ids, labels, pa.array(out, pa.binary())], ["vec_id", "label", "vector"])

    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("embedding").cast("array<double>").alias("embedding"))
    return rows.mapInArrow(run, f"vec_id long, label {rows.schema['label'].dataType.simpleString()}, vector binary")


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that no square overflows or vanishes."""
    x = vectors / np.abs(vectors).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Small whole numbers, their scales, and the length of what they leave out, for each row."""
    scale = np.abs(x).max(1) / 127
    q = np.rint(x / scale[:, None])
    rest = np.sqrt(((x - scale[:, None] * q) ** 2).sum(1)) + SLACK
    return q.astype(np.int8), scale, rest


def whole_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a . b of int8 rows, exact. 1,024 products of at most 127 * 127 stay below 2^24."""
    total = 0.0
    for at in range(0, a.shape[1], 1024):
        part = a[:, at : at + 1024].astype(np.float32) @ b[:, at : at + 1024].astype(np.float32).T
        total = total + part.astype(np.float64)
    return total


def linked(x: np.ndarray, threshold: float, first: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (i, j) of rows with cosine >= threshold.

    ``first`` rows are one tile, the others a second: only pairs across; without others, i < j.
    """
    x = unit(x)
    q, scale, rest = quantised(x)
    others = first if first < len(x) else 0
    out: list[tuple[np.ndarray, np.ndarray]] = []
    for at in range(0, first, STRIP):
        to = min(at + STRIP, first)
        near = whole_products(q[at:to], q[others:]) * scale[at:to, None] * scale[None, others:]
        bound = rest[at:to, None] * (1 + rest[None, others:]) + rest[None, others:]
        possible = near + bound >= threshold
        if not others:
            possible &= np.arange(len(x))[None, :] > np.arange(at, to)[:, None]
        i, j = np.nonzero(possible)
        certain = (near - bound)[i, j] >= threshold
        for part in np.array_split(np.flatnonzero(~certain), max(1, len(i) // 65536)):
            exact = np.einsum("ij,ij->i", x[at + i[part]], x[others + j[part]])
            certain[part] = exact >= threshold
        out.append((i[certain] + at, j[certain] + others))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))  # type: ignore[return-value]


def _part_links(threshold: float, tile: int):
    """For a pair of parts: links of each class by number of vectors, and a forest of links."""

    def run(group: pa.Table):
        order = np.argsort(group["block"].to_numpy(), kind="stable")
        group = group.take(pa.array(order))
        ids, weight, block = (group[c].to_numpy() for c in ("id", "n", "block"))
        same = group["low"][0].as_py() == group["high"][0].as_py()
        first = len(ids) if same else int((block == group["low"][0].as_py()).sum())
        x = np.frombuffer(b"".join(group["vector"].to_pylist()), np.float64).reshape(len(ids), -1)
        links, joined = np.zeros(len(ids)), np.zeros((0, 2), np.int64)
        for low in range(0, first, tile):
            own = np.arange(low, min(low + tile, first))
            for high in range(low if same else first, len(ids), tile):
                others = own[:0] if same and high == low else np.arange(high, min(high + tile, len(ids)))
                both = np.append(own, others)
                left, right = (both[k] for k in linked(x[both], threshold, len(own)))
                links += np.bincount(left, weight[right], len(ids)) + np.bincount(right, weight[left], len(ids))
                # Links that join what is joined already go at once.
                edges = forest(len(ids), np.append(joined[:, 0], left), np.append(joined[:, 1], right))
                joined = np.array(edges, np.int64).reshape(-1, 2)
        hit = np.flatnonzero(links)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([ids[hit], ids[joined[:, 0]]])),
                pa.array(np.concatenate([links[hit].astype(np.int64), np.zeros(len(joined), np.int64)])),
                pa.array(np.concatenate([ids[hit], ids[joined[:, 1]]])),
            ],
            ["a", "links", "b"],
        )

    return run


def parts(classes: DataFrame) -> DataFrame:
    """(label, width, blocks): how many parts the vectors of each label and width are dealt to."""
    sizes = classes.groupBy("label", "width").agg(F.count("*").alias("n"))
    work = F.col("n").cast("double") * F.col("n") * F.col("width")
    total = sizes.agg(F.sum(work)).first()[0] or 1.0
    tasks = work / total * TASKS_PER_CORE * classes.sparkSession.sparkContext.defaultParallelism
    # So many pairs of parts as there should be tasks, but no part below a tile or above its bytes.
    even = F.least(F.ceil(F.col("n") / TILE), F.ceil(F.sqrt(2 * tasks)))
    held = F.ceil(F.col("n") * F.col("width") / PART_BYTES)
    return sizes.select("label", "width", F.greatest(even, held, F.lit(1)).cast("int").alias("blocks"))


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of ``vectors`` (vec_id, embedding, label)."""
    scratch = Scratch()
    rows = packed(vectors).withColumn("digest", F.unhex(F.sha2("vector", 256)))
    rows = scratch.saved(rows, "vectors")
    classes = rows.filter("vector is not null").groupBy("label", "digest").agg(
        F.count("*").alias("n"), F.min("vec_id").alias("least"), F.first("vector").alias("vector")
    )
    classes = classes.withColumn("width", F.octet_length("vector"))
    classes = scratch.saved(classes.select("*", F.monotonically_increasing_id().alias("id")), "classes")
    dealt = scratch.saved(parts(classes), "parts")
    placed = classes.select("label", "width", "id", "n", "vector").join(dealt, ["label", "width"])
    placed = block_pairs(placed.withColumn("block", spread(F.col("id"), parts=F.col("blocks"))), "block", "blocks")
    found = by_group(placed, ["label", "width", "low", "high"], _part_links(threshold, TILE), "a long, links long, b long")
    found = scratch.saved(found, "found")
    links = found.groupBy(F.col("a").alias("id")).agg(F.sum("links").alias("links"))
    near = components(found, "a", "b")
    members = classes.select("id", "least").join(near, F.col("id") == F.col("node"))
    roots = members.groupBy("component").agg(F.min("least").alias("root"))
    near = members.join(roots, "component").select("id", "root")
    labels = classes.select("label", "digest", "n", "id", "least").join(links, "id", "left").join(near, "id", "left")
    labels = saved(
        labels.select(
            "label",
            "digest",
            (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("root", "least").alias("root"),
        ),
        "labels",
    )
    own = saved(rows.select("vec_id", "label", "digest"), "own")
    scratch.clear()
    return own.join(labels, ["label", "digest"], "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("root", "vec_id").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("root", "vec_id"), F.lit(True)).alias("kept"),
    )
