"""The ledger: one row per grid cell, with the state of its run."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridledger.functions.names import expected_name
from gridledger.functions.times import iso_timestamp
from gridledger.runtime import by_shuffle, few_or_by_shuffle
from gridledger.schemas import COMPLETED, KEYS, LEDGER_COLUMNS, PENDING


def new_ledger(grid: DataFrame) -> DataFrame:
    return grid.select(
        *KEYS,
        F.lit("").alias("result_file"),
        F.lit("").alias("timestamp"),
        F.lit(PENDING).alias("status"),
    )


def merge_ledger(grid: DataFrame, old: DataFrame) -> DataFrame:
    """The grid with what ``old`` knows of it. Cells that left the grid are dropped."""
    return grid.join(by_shuffle(old.select(LEDGER_COLUMNS)), KEYS, "left").select(
        *KEYS,
        F.coalesce("result_file", F.lit("")).alias("result_file"),
        F.coalesce("timestamp", F.lit("")).alias("timestamp"),
        F.coalesce("status", F.lit(PENDING)).alias("status"),
    )


def added_cells(grid: DataFrame, old: DataFrame) -> DataFrame:
    """Cells of the grid that ``old`` does not hold."""
    return grid.join(by_shuffle(old), KEYS, "left_anti")


def latest_results(results: DataFrame) -> DataFrame:
    """One result per key: the latest, and of equally late ones the last path.

    Partial maxima are taken before the shuffle, so a key with very many files costs no more
    than another. The shuffle is by key, as `upsert` needs it.
    """
    latest = F.max(F.struct("mtime", "result_file")).alias("latest")
    return results.groupBy(KEYS).agg(latest).select(*KEYS, "latest.*")


def latest_by_name(listing: DataFrame) -> DataFrame:
    """The latest file of each name. Partial maxima are taken before the shuffle."""
    latest = F.max(F.struct("mtime", "result_file")).alias("latest")
    return listing.groupBy("file_name").agg(latest).select("file_name", "latest.*")


def _found() -> list[Column]:
    return [
        F.col("result_file").alias("_file"),
        iso_timestamp("mtime").alias("_timestamp"),
        F.lit(COMPLETED).alias("_status"),
    ]


def _completed(joined: DataFrame, *kept: str) -> DataFrame:
    return joined.select(
        *kept,
        *KEYS,
        F.coalesce("_file", "result_file").alias("result_file"),
        F.coalesce("_timestamp", "timestamp").alias("timestamp"),
        F.coalesce("_status", "status").alias("status"),
    )


def upsert(ledger: DataFrame, results: DataFrame) -> DataFrame:
    """Mark the cells that have results (key, result_file, mtime) as completed.

    Results of unknown cells change nothing; completed cells never go back.
    """
    return _completed(ledger.join(latest_results(results).select(*KEYS, *_found()), KEYS, "left"))


def _named(listing: DataFrame) -> DataFrame:
    return latest_by_name(listing).select(F.col("file_name").alias("_name"), *_found())


def upsert_by_name(ledger: DataFrame, listing: DataFrame, *kept: str) -> DataFrame:
    """Mark the cells whose expected file is in the listing as completed, by the latest of its name.

    A name belongs to one cell (see `ambiguous_names`), so that one join by name is the upsert.
    Other columns of the ledger that are ``kept`` come first.
    """
    return _completed(ledger.join(by_shuffle(_named(listing)), expected_name() == F.col("_name"), "left"), *kept)


def changed_cells(ledger: DataFrame, listing: DataFrame) -> DataFrame:
    """The rows of the ledger, with all their columns, that `upsert_by_name` would change.

    Few results go to the ledger; many, which are counted for that, meet it by a shuffle.
    """
    joined = ledger.join(few_or_by_shuffle(_named(listing)), expected_name() == F.col("_name"))
    same = [F.col(new).eqNullSafe(F.col(old)) for new, old in (("_file", "result_file"), ("_timestamp", "timestamp"), ("_status", "status"))]
    return joined.where(~(same[0] & same[1] & same[2])).select(ledger.columns)


def with_status(ledger: DataFrame, status: str) -> DataFrame:
    return ledger.where(F.col("status") == status)


def pending_rows(ledger: DataFrame) -> DataFrame:
    return with_status(ledger, PENDING)


def completed_rows(ledger: DataFrame) -> DataFrame:
    return with_status(ledger, COMPLETED)


def group_rows(ledger: DataFrame, model: str | Column, pretrained: str | Column) -> DataFrame:
    """Pending rows of one (model, pretrained) group."""
    model, pretrained = [c if isinstance(c, Column) else F.lit(c) for c in (model, pretrained)]
    return pending_rows(ledger).where(
        (F.col("model") == model) & (F.col("pretrained") == pretrained)
    )


def status_counts(ledger: DataFrame, *by: str) -> DataFrame:
    """Total, completed and pending rows; a status without rows counts 0."""
    status = F.col("status")
    return ledger.groupBy(*by).agg(
        F.count("*").alias("total"),
        F.count_if(status == COMPLETED).alias("completed"),
        F.count_if(status == PENDING).alias("pending"),
    )
