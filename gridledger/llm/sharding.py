"""Sharding by jump consistent hashing: a stable key and the number of shards decide, nothing else.

No ring table is kept. With one more shard, a key stays or goes to the new one.

Defined results: the key of a row is its doc_id; all rows of one doc_id share a shard, and rows
without doc_id share one too (that of the hash of nothing). A null text has no bytes (size 1) and
the crc of no bytes. Slots number the rows of a shard from 0 on without gaps, in the order of
(bucket, doc_id, text_crc32, size); rows equal in these are alike and take slots side by side.
Extra columns are passed over. No rows give no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridledger.llm.common import saved, spread

#: Rows that are numbered together, by one sort.
SLOT_ROWS = 50_000


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each 64-bit key: every jump draws the next number of shards at which it moves."""
    if shards < 1:
        raise ValueError("at least one shard is needed")
    state = keys.astype(np.uint64)
    at, after = np.zeros(len(state), np.int64), np.zeros(len(state), np.float64)
    moving = np.ones(len(state), bool)
    while moving.any():
        at[moving] = after[moving].astype(np.int64)
        state[moving] = state[moving] * np.uint64(2862933555777941757) + np.uint64(1)
        drawn = (state[moving] >> np.uint64(33)).astype(np.float64) + 1
        after[moving] = np.floor((at[moving] + 1) * (2.0**31 / drawn))
        moving = after < shards
    return at.astype(np.int32)


def shard_of(key: Column, shards: int) -> Column:
    """The shard from 0 to ``shards`` - 1 of a key of any type."""

    @F.pandas_udf("int")
    def place(keys: pd.Series) -> pd.Series:
        return pd.Series(jump(keys.to_numpy(np.int64).view(np.uint64), shards))

    return place(F.xxhash64(key))


def with_shards(df: DataFrame, key: str, shards: int) -> DataFrame:
    """``df`` with ``shard`` and, for one more shard, ``grown_shard``; columns of these names go."""
    return df.withColumns({"shard": shard_of(F.col(key), shards), "grown_shard": shard_of(F.col(key), shards + 1)})


def numbered(df: DataFrame, group: str, slot: str) -> DataFrame:
    """Each row of ``df`` with a number in its group, from 0 on without gaps.

    Alike rows are summed up first, so that no key, however frequent, is one task's work. Buckets by a
    hash are numbered each for itself, on top of the rows in the buckets before.
    """
    columns = df.columns
    buckets = max(1, -(-df.count() // SLOT_ROWS))
    alike = df.groupBy(*columns).agg(F.count("*").alias("n"))
    alike = saved(alike.withColumn("bucket", spread(*map(F.col, columns), parts=F.lit(buckets))), "slots")
    sums = alike.groupBy(group, "bucket").agg(F.sum("n").alias("size"))
    before = Window.partitionBy(group).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(group, "bucket", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    own = Window.partitionBy(group, "bucket").orderBy(*columns).rowsBetween(Window.unboundedPreceding, -1)
    placed = alike.withColumn("ahead", F.coalesce(F.sum("n").over(own), F.lit(0)))
    placed = placed.join(sums, [group, "bucket"]).withColumn("first", F.col("start") + F.col("ahead"))
    if alike.filter(F.col("n") > SLOT_ROWS).select(F.lit(1)).take(1):
        # The slots of very many alike rows are cut in pieces, which are dealt out.
        offset = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(SLOT_ROWS).cast("long")))
        # A number of tasks is given, as adaptive execution would put the small pieces together again.
        tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        placed = placed.withColumn("_offset", offset).repartition(tasks, group, "first", "_offset")
        placed = placed.withColumns(
            {"first": F.col("first") + F.col("_offset"), "n": F.least(F.col("n") - F.col("_offset"), F.lit(SLOT_ROWS))}
        )
    slots = F.sequence("first", F.col("first") + F.col("n") - 1)
    return placed.select(*columns, F.explode(slots).alias(slot))


def shard_documents(docs: DataFrame, shards: int = 8) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for each row of ``docs``."""
    content = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    rows = docs.select(
        "doc_id", (F.octet_length(content) + 1).cast("long").alias("size"), F.crc32(content).alias("text_crc32")
    )
    out = numbered(with_shards(rows, "doc_id", shards), "shard", "slot")
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", F.col("slot").cast("long"), "grown_shard"
    )
