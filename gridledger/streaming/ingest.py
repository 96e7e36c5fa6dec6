"""Incremental ingest: each version of a result file is read once, and kept as a row of facts.

The facts are all the state there is, and what the folder holds decides what is new: files whose path,
time and length the facts don't have yet. A call lists the folder once, by many tasks. A stream brings in
what has arrived since the last call: the listed files that its table of arrivals, beside its checkpoint,
doesn't have are added to that table, which is the stream's source, so that the driver knows the few files
of the table and not those of the store. What the facts lack after that (facts that are gone, a call
without a checkpoint) is found by comparing the same listing with them. A ledger is made from the facts by
the same upsert as in batch, of those names only that new facts have: the ledger's manifest tells which
folders of facts are in it.
"""

import math
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridledger.functions.names import file_name
from gridledger.operators.ledger import upsert_by_name
from gridledger.runtime import by_shuffle, few_or_by_shuffle, path_exists
from gridledger.schemas import FACTS_SCHEMA
from gridledger.sources.results import LISTING_SCHEMA, kept_listing, list_results, parse_files, with_content
from gridledger.versions import folder_of, read_text, write_text

# What tells a file's versions apart, and files of the store that one file of arrivals names.
_VERSION, _ARRIVED = ["result_file", "mtime", "length"], 100_000
# Older arrivals than this, against the newest ones, would be passed over by the stream.
_ANY_AGE = "36500d"
# Folders of a tier that are merged, the size of the first tier, and bytes of a merged file.
TIER, _SMALL, _PART = 8, 1 << 20, 128 << 20
_REPLACED = "_replaced"


def _write(files: DataFrame, path: str) -> None:
    rows = parse_files(files).withColumn("read_at", F.current_timestamp()).select(FACTS_SCHEMA.fieldNames())
    # A task reads few small files; their rows are gathered into larger ones.
    rows.repartition("file_name").write.mode("overwrite").parquet(path)


def _add_arrivals(listing: DataFrame, arrivals: str, max_files: int | None) -> None:
    """Add the files of the listing that the table of arrivals doesn't have."""
    spark = listing.sparkSession
    if path_exists(spark, arrivals):
        known = spark.read.schema(LISTING_SCHEMA).parquet(arrivals)
        listing = listing.join(by_shuffle(known), _VERSION, "left_anti")
    new = kept_listing(listing.select("result_file", "file_name", "mtime", "length"))
    if count := new.count():
        most = max_files or _ARRIVED
        spread = new.repartition(-(-count // most), "result_file")
        spread.write.mode("append").option("maxRecordsPerFile", most).parquet(arrivals)


def _ingest_stream(listing: DataFrame, facts: str, checkpoint: str, max_files: int | None) -> None:
    """Batch n of a query writes ``facts/run=<query>/batch=<n>``; a replayed one replaces its own folder."""
    spark, name = listing.sparkSession, f"ingest-{uuid.uuid4().hex}"
    arrivals = f"{checkpoint.rstrip('/')}/arrivals"
    _add_arrivals(listing, arrivals, max_files)
    if not path_exists(spark, arrivals):
        return

    def keep(batch: DataFrame, number: int) -> None:
        run = next(q.id for q in spark.streams.active if q.name == name)
        _write(with_content(batch), f"{facts.rstrip('/')}/run={run}/batch={number}")

    reader = spark.readStream.schema(LISTING_SCHEMA).option("maxFileAge", _ANY_AGE)
    if max_files:  # no file of arrivals names more
        reader = reader.option("maxFilesPerTrigger", 1)
    writer = (
        reader.parquet(arrivals)
        .writeStream.queryName(name)
        .foreachBatch(keep)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    writer.start().awaitTermination()


def ingest_missing(listing: DataFrame, facts: str, max_files: int | None = None) -> None:
    """Read the files of the listing whose path, time and length the facts don't have.

    ``max_files`` bounds the files that are read before they are kept.
    """
    known = read_facts(listing.sparkSession, facts).select(_VERSION)
    missing = listing.join(by_shuffle(known), _VERSION, "left_anti")
    missing = kept_listing(missing.select("result_file", "file_name", "mtime", "length"))
    count = missing.count()
    parts = -(-count // (max_files or max(1, count)))
    for part in range(parts):
        rows = missing if parts == 1 else missing.where(F.pmod(F.xxhash64("result_file"), F.lit(parts)) == part)
        _write(with_content(rows), f"{facts.rstrip('/')}/run=listing/batch={uuid.uuid4().hex}")


def ingest_new_files(
    spark: SparkSession,
    folder: str,
    facts: str,
    checkpoint: str | None = None,
    max_files: int | None = None,
) -> None:
    """Add what is new in the folder to the facts, then return; nothing if there is no folder yet.

    With a checkpoint, arrivals are read by a stream first. ``max_files`` bounds each batch.
    """
    if not path_exists(spark, folder):
        return
    listing = kept_listing(list_results(spark, folder))
    if checkpoint:
        _ingest_stream(listing, facts, checkpoint, max_files)
    ingest_missing(listing, facts, max_files)


def fact_folders(spark: SparkSession, facts: str) -> dict[str, int]:
    """The folders that hold facts, by their names under ``facts``, with the bytes of each."""
    store, root = folder_of(spark, facts)
    if not store.exists(root):
        return {}
    runs = [run.getPath() for run in store.listStatus(root) if run.getPath().getName().startswith("run=")]
    batches = [batch.getPath() for run in runs for batch in store.listStatus(run)]
    named = {f"{b.getParent().getName()}/{b.getName()}": b for b in batches if b.getName().startswith("batch=")}
    return {name: store.getContentSummary(path).getLength() for name, path in sorted(named.items())}


def _replaced(spark: SparkSession, facts: str, folder: str) -> list[str] | None:
    """The folders that a compacted one was made from; None for others."""
    path = f"{facts.rstrip('/')}/{folder.split('/')[0]}/{_REPLACED}"
    return read_text(spark, path).splitlines() if path_exists(spark, path) else None


def new_folders(spark: SparkSession, facts: str, folders: Iterable[str], applied: Iterable[str]) -> list[str]:
    """Those of the folders whose facts are not in the applied ones."""
    applied = set(applied)
    return [f for f in folders if f not in applied and not set(_replaced(spark, facts, f) or [""]) <= applied]


def _readings(spark: SparkSession, facts: str, folders: Iterable[str]) -> DataFrame:
    paths = [f"{facts.rstrip('/')}/{folder}" for folder in folders]
    return spark.read.schema(FACTS_SCHEMA).parquet(*paths) if paths else spark.createDataFrame([], FACTS_SCHEMA)


def _last(readings: DataFrame) -> DataFrame:
    others = [c for c in FACTS_SCHEMA.fieldNames() if c != "result_file"]
    latest = F.max_by(F.struct(*others), F.struct("read_at", "mtime")).alias("latest")
    return readings.groupBy("result_file").agg(latest).select("result_file", "latest.*")


def read_facts(spark: SparkSession, facts: str) -> DataFrame:
    """One row per result file: its last reading. None before the first ingest."""
    return _last(_readings(spark, facts, fact_folders(spark, facts))).drop("read_at")


def facts_of_names(spark: SparkSession, facts: str, new: Iterable[str], folders: Iterable[str]) -> DataFrame:
    """The last reading of every result file whose name some of the new folders have.

    All facts are read, of which few columns and, behind a join with the few names, few rows are left.
    """
    names = _readings(spark, facts, new).select("file_name").distinct()
    return _last(_readings(spark, facts, folders).join(few_or_by_shuffle(names), "file_name", "left_semi")).drop("read_at")


def compact_facts(spark: SparkSession, facts: str) -> None:
    """Put the last reading of each file into one folder, and drop the folders that it was made from.

    For a store that nobody else reads meanwhile; `merge_small_facts` goes on beside readers.
    """
    folders = fact_folders(spark, facts)
    if not folders:
        return
    _last(_readings(spark, facts, folders)).write.parquet(f"{facts.rstrip('/')}/run=compact-{uuid.uuid4().hex}/batch=0")
    _drop(spark, facts, folders)


def _drop(spark: SparkSession, facts: str, folders: Iterable[str]) -> None:
    for run in {folder.split("/")[0] for folder in folders}:
        store, target = folder_of(spark, f"{facts.rstrip('/')}/{run}")
        for folder in folders:
            if folder.startswith(f"{run}/"):
                store.delete(folder_of(spark, f"{facts.rstrip('/')}/{folder}")[1], True)
        if store.exists(target) and not any(x.getPath().getName().startswith("batch=") for x in store.listStatus(target)):
            store.delete(target, True)


def merge_small_facts(spark: SparkSession, facts: str, applied: Iterable[str]) -> None:
    """Merge folders of a like size, once there are many of them, so that each fact is written anew a
    few times only, however long the campaign.

    Folders that a merge has replaced stay until the next call, for those who are reading them: a
    reading that is there twice counts once. Only ``applied`` folders are merged.
    """
    folders = fact_folders(spark, facts)
    gone = {old for folder in folders for old in _replaced(spark, facts, folder) or ()} & set(folders)
    _drop(spark, facts, gone)
    tiers: dict[int, list[str]] = {}
    for folder in sorted(set(folders) & set(applied) - gone):
        tiers.setdefault(int(math.log(max(folders[folder], _SMALL) / _SMALL, TIER)), []).append(folder)
    for tier in tiers.values():
        if len(tier) >= TIER:
            run = f"{facts.rstrip('/')}/run=compact-{uuid.uuid4().hex}"
            rows = _last(_readings(spark, facts, tier))
            rows.repartitionByRange(max(1, sum(folders[f] for f in tier) // _PART), "file_name").write.parquet(f"{run}/batch=0")
            write_text(spark, f"{run}/{_REPLACED}", "\n".join(tier))


def ledger_from_facts(ledger: DataFrame, facts: DataFrame) -> DataFrame:
    return upsert_by_name(ledger, facts)
