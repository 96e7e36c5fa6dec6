"""Which ledger cell a result file belongs to.

A listing has the columns result_file (path), file_name and mtime.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridledger.functions.names import expected_name, with_parsed_name
from gridledger.runtime import by_shuffle
from gridledger.schemas import KEYS


def match_by_parsing(listing: DataFrame) -> DataFrame:
    """Results whose names can be read, with the key as it was read."""
    parsed = with_parsed_name(listing).where("key IS NOT NULL")
    return parsed.select(*[f"key.{k}" for k in KEYS], "result_file", "mtime")


def unmatched_files(listing: DataFrame) -> DataFrame:
    """Files whose names cannot be read."""
    return with_parsed_name(listing).where("key IS NULL").drop("key")


def orphan_results(results: DataFrame, ledger: DataFrame) -> DataFrame:
    """Results whose key is not in the ledger."""
    return results.join(by_shuffle(ledger), KEYS, "left_anti")


def named_cells(ledger: DataFrame) -> DataFrame:
    """Ledger keys with the file name each expects."""
    return ledger.select(expected_name().alias("file_name"), *KEYS)


def ambiguous_names(ledger: DataFrame) -> DataFrame:
    """File names that more than one ledger row expects; `match_by_name` needs that there are none.

    Names depend on the grid alone, so this is checked when the grid changes.
    """
    cells = named_cells(ledger).groupBy("file_name").agg(F.count("*").alias("cells"))
    return cells.where(F.col("cells") > 1)


def match_by_name(ledger: DataFrame, listing: DataFrame) -> DataFrame:
    """Results whose file name is the one a ledger cell expects. Exact for every name."""
    return (
        listing.join(by_shuffle(named_cells(ledger)), "file_name").select(*KEYS, "result_file", "mtime")
    )


def unexpected_files(ledger: DataFrame, listing: DataFrame) -> DataFrame:
    """Files that no ledger cell expects."""
    return listing.join(by_shuffle(named_cells(ledger)), "file_name", "left_anti")


def report(rows: DataFrame, *order: str, limit: int = 5) -> DataFrame:
    """The first rows, each with the count of all: the short form of a long list."""
    total = rows.agg(F.count("*")).scalar()
    return rows.orderBy(*order).limit(limit).withColumn("total", total)
