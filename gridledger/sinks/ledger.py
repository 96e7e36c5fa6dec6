"""Write ledgers: whole versions, versions that share files with the one before, and CSV."""

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridledger.manifest import COUNTS, Manifest, read_manifest, write_manifest
from gridledger.operators.ledger import changed_cells, latest_by_name, status_counts, upsert_by_name
from gridledger.schemas import GROUP, LEDGER_COLUMNS
from gridledger.sources.ledger import latest_manifest, name_in_data, read_files
from gridledger.versions import (
    ABANDONED_SECONDS,
    complete_versions,
    expire_versions,
    folder_of,
    new_folder,
    next_version,
    publish,
    write_text,
)


def _commit(spark: SparkSession, root: str, version: str, folder: str, manifest: Manifest) -> None:
    """Add the files written under ``folder`` to the manifest and the data, and make it the version."""
    store, written = folder_of(spark, f"{folder}/data")
    if store.exists(written):
        counted = status_counts(read_files(spark, f"{folder}/data").withColumn("file", name_in_data()), "file")
        manifest.files.update({row.file: {name: row[name] for name in COUNTS} for row in counted.collect()})
    data = folder_of(spark, f"{root}/data")[1]
    store.mkdirs(data)
    moved = []
    try:
        if store.exists(written):
            for status in store.listStatus(written):
                if status.isDirectory():
                    target = folder_of(spark, f"{root}/data/{status.getPath().getName()}")[1]
                    if not store.rename(status.getPath(), target):
                        raise OSError(f"cannot rename {status.getPath()} to {target}")
                    moved.append(target)
            store.delete(written, True)
        write_manifest(spark, folder, manifest)
        write_text(spark, f"{folder}/_SUCCESS", "")
        publish(spark, folder, version)
    except Exception:
        for target in moved:
            store.delete(target, True)
        raise


def write_ledger(ledger: DataFrame, root: str, version: str | None = None, applied: list[str] | None = None) -> str:
    """Write a new version of the ledger and return its path.

    ``version`` is the one that this write may become: the next one when the ledger it comes from was
    read, or when this call began. Rows are kept in ranges of (model, pretrained) and sorted by them
    within each file, so that a reader of one group skips the other files and row groups by their
    statistics. The ranges are drawn from a sample, for which the rows are kept until written.
    """
    spark, root = ledger.sparkSession, root.rstrip("/")
    version, folder = version or next_version(spark, root), new_folder(root)
    rows = ledger.select(LEDGER_COLUMNS).persist()
    ranged = rows.repartitionByRange(*GROUP).sortWithinPartitions("task_type", *GROUP)
    ranged.withColumn("w", F.lit(uuid.uuid4().hex)).write.partitionBy("w", "task_type").parquet(f"{folder}/data")
    rows.unpersist()
    _commit(spark, root, version, folder, Manifest(applied=applied))
    return version


def update_ledger(
    spark: SparkSession, root: str, listing: DataFrame, version: str | None = None, applied: list[str] | None = None
) -> list[str]:
    """Mark the cells that expect a file of the listing as completed, in a version that shares all
    files without a changed cell with the one before. Returns the files that were written anew.

    The ledger is read once, and only names and states of it; rows are shuffled of changed files only.
    """
    root = root.rstrip("/")
    version, folder = version or next_version(spark, root), new_folder(root)
    manifest, data = latest_manifest(spark, root), f"{root}/data"
    found = latest_by_name(listing).persist()
    changed = []
    if manifest.files:
        cells = read_files(spark, data, manifest.files).withColumn("file", name_in_data())
        changed = [row.file for row in changed_cells(cells, found).select("file").distinct().collect()]
    if changed:
        part = read_files(spark, data, changed).withColumn("w", F.concat(F.lit(f"{uuid.uuid4().hex}-"), F.md5(name_in_data())))
        rows = upsert_by_name(part, found, "w").repartition(len(changed), "w").sortWithinPartitions("w", "task_type", *GROUP)
        rows.write.partitionBy("w", "task_type").parquet(f"{folder}/data")
    found.unpersist()
    kept = {name: counts for name, counts in manifest.files.items() if name not in set(changed)}
    store, target = folder_of(spark, folder)
    store.mkdirs(target)
    _commit(spark, root, version, folder, Manifest(kept, applied))
    return changed


def expire_ledger(spark: SparkSession, root: str, keep: int = 3) -> None:
    """Delete all but the newest versions, the files that only those had, and folders that no version
    has had for a day."""
    root = root.rstrip("/")
    before = complete_versions(spark, root)
    known = {version: set(read_manifest(spark, version).files) for version in before}
    expire_versions(spark, root, keep)
    left = [version for version in complete_versions(spark, root) if version in known]
    kept = set().union(*(known[version] for version in left))
    gone = set().union(*known.values()) - kept
    folders = {name.split("/")[0] for name in kept}
    store, data = folder_of(spark, f"{root}/data")
    for name in gone:
        first = name.split("/")[0]
        store.delete(folder_of(spark, f"{root}/data/{name if first in folders else first}")[1], True)
    if store.exists(data):
        for status in store.listStatus(data):
            old = status.getModificationTime() / 1000 < time.time() - ABANDONED_SECONDS
            if old and status.getPath().getName() not in folders and status.isDirectory():
                store.delete(status.getPath(), True)


def write_ledger_csv(ledger: DataFrame, path: str) -> None:
    ledger.select(LEDGER_COLUMNS).write.csv(path, header=True)
