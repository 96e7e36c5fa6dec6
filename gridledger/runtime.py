"""Session helpers: shared scratch folder, and the size checks made before broadcasting."""

import os
import tempfile
import uuid
from contextlib import contextmanager
from functools import lru_cache

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Upper bound on the rows that may be sent whole to every executor.
BROADCAST_ROWS = 20_000


@lru_cache(maxsize=1)
def _local_root() -> tempfile.TemporaryDirectory:
    """One folder for a process in local mode, which goes when the process ends."""
    return tempfile.TemporaryDirectory(prefix="gridledger-", ignore_cleanup_errors=True)


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder under ``spark.checkpoint.dir``, which every node of the cluster sees.

    A machine-local folder is used only in local mode, where there is just one machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all nodes share")
        root = _local_root().name
    return os.path.join(root, f"{label}-{uuid.uuid4().hex}")


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme, as Spark writes it in rows."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return store.makeQualified(target).toString()


def file_store(path: str) -> tuple[fs.FileSystem, str]:
    """The store of a path and the path within it, for tasks that list, read or write files."""
    # A local path may be written as file:/path, file:///path or /path; s3a is Hadoop's name of s3.
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1) if path.startswith("s3a:") else path)


def row_bound(df: DataFrame, bound: int = BROADCAST_ROWS) -> bool:
    """True if ``df`` has at most ``bound`` rows.

    Takes rows without columns, one partition after another, and stops at the bound.
    """
    return len(df.select(F.lit(1)).take(bound + 1)) <= bound


def by_shuffle(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that is never sent whole, for tables that grow with the campaign.

    Spark judges a table by the bytes of its files, if nothing better is known. Ledgers, listings and facts take
    a hundredth of their size there, so that millions of rows pass for a small table, and the driver would
    have to hold them.
    """
    return df.hint("merge")


def few_or_by_shuffle(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that is sent whole if its rows are counted to be few, else never."""
    return F.broadcast(df) if row_bound(df) else by_shuffle(df)


@contextmanager
def session_setting(spark: SparkSession, name: str, value):
    """A session setting for the length of a block, then the old one again."""
    old = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, old)
