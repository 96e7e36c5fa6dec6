"""init, update and parse: from the catalogs to the ledger to the metric tables."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from gridledger.operators import ledger as L
from gridledger.operators import matching, metrics
from gridledger.operators.catalog import pair_grid
from gridledger.sinks.ledger import expire_ledger, update_ledger, write_ledger
from gridledger.sinks.metrics import write_csv, write_metrics
from gridledger.sources.ledger import latest_manifest, read_ledger, read_ledger_csv
from gridledger.sources.results import kept_listing, list_results, listing_of, read_documents
from gridledger.runtime import path_exists, shared_folder
from gridledger.schemas import KEYS, LEDGER_SCHEMA
from gridledger.streaming.ingest import (
    fact_folders,
    facts_of_names,
    ingest_new_files,
    merge_small_facts,
    new_folders,
    read_facts,
)
from gridledger.versions import complete_versions, folder_of, latest_version, next_version

# Versions of the ledger that stay readable after a new one, and where reports are kept with them.
KEPT_VERSIONS = 3
REPORTS = "reports"


@dataclass
class Update:
    """What an update found: the new ledger, the files that no cell expects (or, read by name, that
    tell no key), and results whose key is not in the ledger. The two reports are kept with the version."""

    ledger: DataFrame
    unexpected: DataFrame
    orphans: DataFrame


@dataclass
class Change:
    """What an init changes: cells that are new in the grid, and cells of the ledger that left it."""

    added: DataFrame
    dropped: DataFrame


def _report(rows: DataFrame, root: str, version: str, name: str) -> DataFrame:
    """Keep rows with a version of the ledger, and read them from there."""
    path = f"{root.rstrip('/')}/{REPORTS}/{version.rpartition('/')[2]}/{name}"
    rows.write.mode("overwrite").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def read_report(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """A report of the newest version, if it has one: ``added`` and ``dropped`` cells of an init,
    ``unexpected`` files and ``orphans`` of an update."""
    version = latest_version(spark, root)
    path = version and f"{root.rstrip('/')}/{REPORTS}/{version.rpartition('/')[2]}/{name}"
    return spark.read.parquet(path) if path and path_exists(spark, path) else None


def _expire(spark: SparkSession, root: str) -> None:
    expire_ledger(spark, root, KEPT_VERSIONS)
    store, folder = folder_of(spark, f"{root.rstrip('/')}/{REPORTS}")
    kept = {version.rpartition("/")[2] for version in complete_versions(spark, root)}
    for status in store.listStatus(folder) if store.exists(folder) else ():
        if status.getPath().getName() not in kept:
            store.delete(status.getPath(), True)


def _check_names(cells: DataFrame) -> None:
    shared = [row.file_name for row in matching.ambiguous_names(cells).take(5)]
    if shared:
        raise ValueError(f"several ledger rows expect the same file: {shared}")


def import_ledger(spark: SparkSession, root: str, csv: str) -> DataFrame:
    """Make a CSV ledger the current one."""
    rows = read_ledger_csv(spark, csv)
    _check_names(rows)
    write_ledger(rows, root)
    return read_ledger(spark, root)


def export_ledger(spark: SparkSession, root: str, path: str, single_file: bool = False) -> None:
    """Write the current ledger as CSV: a folder, or one file if it is small."""
    write_csv(read_ledger(spark, root), path, single_file)


def init_changes(spark: SparkSession, root: str, models: DataFrame, benchmarks: DataFrame) -> Change:
    """What `init_tracking` with the same catalogs would add to the ledger and drop from it."""
    grid = pair_grid(models, benchmarks)
    known = latest_version(spark, root) is not None
    old = read_ledger(spark, root) if known else spark.createDataFrame([], LEDGER_SCHEMA)
    return Change(L.added_cells(grid, old), L.added_cells(old.select(KEYS), grid))


def init_tracking(
    spark: SparkSession, root: str, models: DataFrame, benchmarks: DataFrame, force_reset=False
) -> DataFrame:
    """Make the ledger of the grid, or bring an existing one in line with it.

    Every cell must expect a file name of its own, or results could not be told apart. The cells that
    came and went are kept with the version (see `read_report`).
    """
    version = next_version(spark, root)
    grid = pair_grid(models, benchmarks)
    _check_names(grid)
    changes = init_changes(spark, root, models, benchmarks)
    _report(changes.added, root, version, "added")
    _report(changes.dropped, root, version, "dropped")
    if force_reset or latest_version(spark, root) is None:
        rows = L.new_ledger(grid)
    else:
        rows = L.merge_ledger(grid, read_ledger(spark, root))
    write_ledger(rows, root, version)
    _expire(spark, root)
    return read_ledger(spark, root)


def update_tracking(spark: SparkSession, root: str, results: str | DataFrame, by_parsing=False) -> Update:
    """Mark the cells that have a result file as completed.

    ``results`` is a folder, or a table of files (see `listing_of`). Files are matched by the name each
    cell expects, or by reading names if ``by_parsing``.
    """
    version = next_version(spark, root)
    ledger = read_ledger(spark, root)
    listing = kept_listing(list_results(spark, results) if isinstance(results, str) else listing_of(results))
    parsed = matching.match_by_parsing(listing)
    if by_parsing:
        updated, unexpected = L.upsert(ledger, parsed), matching.unmatched_files(listing)
    else:
        updated, unexpected = L.upsert_by_name(ledger, listing), matching.unexpected_files(ledger, listing)
    unexpected = _report(unexpected, root, version, "unexpected")
    orphans = _report(matching.orphan_results(parsed, ledger), root, version, "orphans")
    write_ledger(updated, root, version)
    _expire(spark, root)
    return Update(read_ledger(spark, root), unexpected, orphans)


def update_tracking_incrementally(
    spark: SparkSession,
    root: str,
    results: str,
    facts: str,
    checkpoint: str | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """As `update_tracking`, but reads only the files that are new since the last call.

    ``max_files`` bounds the files of a batch. Cells whose names no new facts have are left as they are,
    and so are the ledger's files that hold none of the others.
    """
    version = next_version(spark, root)
    ingest_new_files(spark, results, facts, checkpoint, max_files)
    applied = latest_manifest(spark, root).applied
    folders = list(fact_folders(spark, facts))
    new = folders if applied is None else new_folders(spark, facts, folders, applied)
    if applied is None or new:
        update_ledger(spark, root, facts_of_names(spark, facts, new, folders), version, folders)
        _expire(spark, root)
    merge_small_facts(spark, facts, folders)
    return read_ledger(spark, root)


def parse_results(
    spark: SparkSession,
    root: str,
    results: str,
    out: str,
    output_format: str = "separate",
    facts: str | None = None,
    single_files: bool = False,
) -> DataFrame:
    """Write the metric tables of all completed runs and return the files that gave none.

    Tables are folders of CSV files, or with ``single_files`` one file each if they are small.

    Documents are read from the result files, or from the facts of the ingest if given.
    """
    documents = read_facts(spark, facts) if facts else read_documents(spark, results)
    completed = metrics.completed_documents(read_ledger(spark, root), documents)
    # Read and parsed once, for the tables and for the errors that are returned.
    kept = shared_folder(spark, "completed")
    completed.write.parquet(kept)
    completed = spark.read.schema(completed.schema).parquet(kept)
    write_metrics(completed, out, output_format, single_files)
    return metrics.parse_errors(completed)
