"""Read ledgers: versioned Parquet, or CSV for import."""

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridledger.manifest import COUNTS, Manifest, read_manifest
from gridledger.schemas import LEDGER_COLUMNS, LEDGER_SCHEMA
from gridledger.versions import latest_version


def latest_manifest(spark: SparkSession, root: str) -> Manifest:
    """That of the newest complete version under ``root``."""
    path = latest_version(spark, root)
    if path is None:
        raise FileNotFoundError(f"no ledger under {root}")
    return read_manifest(spark, path)


def name_in_data() -> Column:
    """The file that a row of `read_files` comes from, as manifests have it."""
    return F.url_decode(F.substring_index(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")), "/", -3))


def read_files(spark: SparkSession, data: str, files: Iterable[str] | None = None) -> DataFrame:
    """Rows of some files of a data folder, or of all."""
    if files is not None and not files:
        return spark.createDataFrame([], LEDGER_SCHEMA)
    paths = [data] if files is None else [f"{data}/{name}" for name in files]
    return spark.read.schema(LEDGER_SCHEMA).option("basePath", data).parquet(*paths)


def read_ledger(spark: SparkSession, root: str) -> DataFrame:
    """The newest complete version under ``root``."""
    files = latest_manifest(spark, root).files
    return read_files(spark, f"{root.rstrip('/')}/data", files).select(LEDGER_COLUMNS)


def stored_status_counts(spark: SparkSession, root: str) -> DataFrame:
    """Total, completed and pending rows of the newest version, from its manifest: no rows are read."""
    files = latest_manifest(spark, root).files.values()
    counts = tuple(sum(counts[name] for counts in files) for name in COUNTS)
    return spark.createDataFrame([counts], ", ".join(f"{name} long" for name in COUNTS))


def read_ledger_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV ledger. Unset fields, read as null, are empty text."""
    rows = spark.read.schema(LEDGER_SCHEMA).csv(path, header=True, enforceSchema=False)
    unset = [F.coalesce(c, F.lit("")).alias(c) for c in ("result_file", "timestamp")]
    return rows.withColumns({c: e for c, e in zip(("result_file", "timestamp"), unset)})
