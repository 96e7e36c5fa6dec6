"""Helpers of the training-data operators: tables, saved steps, streams of groups, checked sizes."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager, suppress
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridledger.runtime import row_bound, session_setting, shared_folder

#: Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Bytes of the batches of rows that Python workers get; a batch is held several times on either side.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20)


class Scratch:
    """Tables written to the shared folder and read again, so that what follows doesn't depend on
    executors. ``clear`` removes them, once nothing reads them any more."""

    def __init__(self) -> None:
        self._held: list[tuple[SparkSession, str]] = []

    def saved(self, df: DataFrame, label: str) -> DataFrame:
        spark = df.sparkSession
        path = shared_folder(spark, label)
        # What a finished write has shuffled is not read again.
        cleanup = session_setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
        with cleanup, session_setting(spark, BATCH_SETTING, BATCH_BYTES):
            df.write.parquet(path)
        self._held.append((spark, path))
        return spark.read.schema(df.schema).parquet(path)

    def clear(self) -> None:
        for spark, path in self._held:
            target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
        self._held.clear()

    def hand_over(self) -> None:
        """Leave the tables to the block that ``owned`` opened, if any: a result goes on reading them."""
        if owner := _owner.get():
            owner._held += self._held


_owner: ContextVar[Scratch | None] = ContextVar("owner", default=None)


def saved(df: DataFrame, label: str) -> DataFrame:
    """As ``Scratch.saved``, for a table that a result goes on reading. Within ``owned`` it belongs to
    that block's scratch; else it stays until the folder is cleaned."""
    return (_owner.get() or Scratch()).saved(df, label)


@contextmanager
def owned() -> Iterator[Scratch]:
    """A scratch that the tables saved in the block belong to, for who has written what they were for."""
    scratch = Scratch()
    token = _owner.set(scratch)
    try:
        yield scratch
    finally:
        _owner.reset(token)


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one row for each doc_id and text; rows without doc_id all stay.

    Only rows that are there more than once are shuffled, if there are any.
    """
    rows = docs.select(
        F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("key"), F.xxhash64("text").alias("at")
    )
    shared = rows.filter("key is not null").groupBy("key", "at").agg(F.count("*").alias("n")).filter("n > 1")
    shared = saved(shared.select("key", "at"), "shared")
    if not shared.take(1):
        return docs
    some = F.broadcast(shared) if row_bound(shared) else shared
    again = rows.join(some, ["key", "at"], "left_semi").dropDuplicates(["key", "at"])
    return rows.join(some, ["key", "at"], "left_anti").unionByName(again).select("row.*")


def remainder(key: Column, of: int) -> Column:
    """crc32 of the key as text, modulo ``of``: fixes which rows are held out."""
    return F.crc32(key.cast("string").cast("binary")) % of


def spread(*keys: Column, parts: Column) -> Column:
    """A part from 0 to ``parts`` - 1 by a hash of the keys."""
    return F.pmod(F.xxhash64(*keys), parts.cast("long")).cast("int")


def block_pairs(df: DataFrame, block: str, blocks: str) -> DataFrame:
    """Each row once for every pair of blocks (low <= high) that its block is in.

    Two rows of one set meet in the pair of their blocks; the number of copies is that of blocks.
    """
    pair = F.transform(
        F.sequence(F.lit(0), F.col(blocks) - 1),
        lambda other: F.struct(
            F.least(F.col(block), other).alias("low"), F.greatest(F.col(block), other).alias("high")
        ),
    )
    return df.withColumn("pair", F.explode(pair)).select(
        "*", F.col("pair.low").alias("low"), F.col("pair.high").alias("high")
    ).drop("pair")


def grouped(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The runs of equal keys in a sorted stream of batches, each as one table."""
    held: list[pa.RecordBatch] = []
    held_key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(batch.schema.get_field_index(k)).to_pylist() for k in keys]
        rows = list(zip(*columns, strict=True))
        start = 0
        for at in range(1, len(rows) + 1):
            if at < len(rows) and rows[at] == rows[start]:
                continue
            piece = batch.slice(start, at - start)
            if held and held_key == rows[start]:
                held.append(piece)
            else:
                if held:
                    yield pa.Table.from_batches(held)
                held, held_key = [piece], rows[start]
            start = at
    if held:
        yield pa.Table.from_batches(held)


def whole_groups(
    batches: Iterable[pa.RecordBatch], keys: list[str], rows: int = 512
) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Pieces of a stream sorted by ``keys`` (numbers) that have whole groups and, if groups allow, no
    more than about ``rows`` rows; with each, the first row of its groups and the row after the last."""
    held: list[pa.RecordBatch] = []

    def pieces(last: bool):
        nonlocal held
        table = pa.Table.from_batches(held).combine_chunks()
        new = np.zeros(table.num_rows, bool)
        new[0] = True
        for key in keys:
            values = table[key].to_numpy()
            new[1:] |= values[1:] != values[:-1]
        starts = np.flatnonzero(new)
        # Without more batches to come the last group is whole.
        end = table.num_rows if last else int(starts[-1])
        starts = np.append(starts[starts < end], end)
        at = 0
        while at < len(starts) - 1:
            to = max(at + 1, int(np.searchsorted(starts, starts[at] + rows, "right")) - 1)
            yield table.slice(starts[at], starts[to] - starts[at]), starts[at : to + 1] - starts[at]
            at = to
        held = table.slice(end).to_batches()

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            if sum(b.num_rows for b in held) >= rows:
                yield from pieces(False)
    if held:
        yield from pieces(True)


def by_group(
    df: DataFrame, keys: list[str], function: Callable[[pa.Table], pa.RecordBatch | None], schema: str
) -> DataFrame:
    """``function`` on each group of ``keys``; groups must be of bounded size. One shuffle."""

    def run(batches):
        for group in grouped(batches, keys):
            out = function(group)
            if out is not None and out.num_rows:
                yield out

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(lean(run), schema)


def forest(n: int, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """The edges that join parts not joined before: at most ``n`` - 1 of the given ones."""
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for a, b in zip(left.tolist(), right.tolist(), strict=True):
        x, y = root(a), root(b)
        if x != y:
            parent[max(x, y)] = min(x, y)
            out.append((a, b))
    return out


def lean(run: Callable) -> Callable:
    """A step on batches after which its worker gives back the memory that it holds no more: workers
    wait for the next task, beside an executor whose memory is bounded."""

    def whole(batches):
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        with suppress(OSError, AttributeError):  # other systems than Linux have no such call
            ctypes.CDLL(None).malloc_trim(0)

    return whole


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """The column's texts as UTF-8 bytes; null is empty."""
    column = batch.column(batch.schema.get_field_index(name))
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]
