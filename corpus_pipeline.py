"""Documents made ready for training, in stages; each works on all that the one before has kept.

    quality      documents that the rule ensemble rejects go
    lines        near-equal lines stay once; documents all of whose lines occurred before go
    near_dedup   of each group of near-equal documents, one stays
    mixing       sources are taken to their target weights, in whole documents, up to twice
    packing      what is left becomes sequences of tokens

Stages set the bytes of a batch that Python workers get, for the session: with batches of the usual
10,000 rows, texts alone would take some hundred megabytes on each side of every task.

All stages but the last return the columns of documents; texts that lose lines change, and with them
``n_chars``. Null and empty texts pass (if the classifier lets them), tables without rows give none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridledger.llm import lines, minhash, mixing, packing, quality
from gridledger.llm.common import BATCH_BYTES, BATCH_SETTING, Scratch, owned, table


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    spark.conf.set(BATCH_SETTING, BATCH_BYTES)
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def first_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    spark.conf.set(BATCH_SETTING, BATCH_BYTES)
    return lines.drop_lines(docs)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    spark.conf.set(BATCH_SETTING, BATCH_BYTES)
    return minhash.keep_one(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    spark.conf.set(BATCH_SETTING, BATCH_BYTES)
    return mixing.mixed(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    spark.conf.set(BATCH_SETTING, BATCH_BYTES)
    return packing.packed(docs)


STAGES = [
    ("quality", good_documents),
    ("lines", first_lines),
    ("near_dedup", distinct_documents),
    ("mixing", mixed_sources),
    ("packing", packed_sequences),
]

#: Signatures, learned rules and tokenizers are beyond SQL; tests hold the stages to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, over all documents of ``sf_dir``. What a stage has read, and the tables
    that it made on the way, go once its output is written."""
    docs, before = table(spark, sf_dir, "documents"), Scratch()
    for name, stage in STAGES[:-1]:
        kept = Scratch()
        with owned() as inner:
            docs = kept.saved(stage(spark, docs, sf_dir), name)
        inner.clear()
        before.clear()
        before = kept
    return STAGES[-1][1](spark, docs, sf_dir)
