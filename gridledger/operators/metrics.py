"""Metric tables of completed runs.

Documents have the columns result_file, error_class and metrics. They come from
`functions.documents.with_metrics`, before any join, so that texts are never shuffled.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridledger.functions.names import file_name
from gridledger.operators.ledger import completed_rows
from gridledger.schemas import (
    CLASSIFICATION,
    CLASSIFICATION_METRICS,
    KEYS,
    MERGED_COLUMNS,
    MISSING,
    RETRIEVAL,
    RETRIEVAL_METRICS,
)


def completed_documents(ledger: DataFrame, documents: DataFrame) -> DataFrame:
    """Completed ledger rows that name a file, with its metrics or the reason for none.

    Files are found by their name: a ledger may hold paths that are relative, or of another place or
    scheme than the store's. Of several documents of one name the latest counts. A row without a
    document counts as missing.
    """
    named = completed_rows(ledger).where(F.col("result_file") != "")
    latest = F.struct(*[c for c in ("mtime", "result_file") if c in documents.columns])
    found = documents.groupBy(file_name("result_file").alias("_name")).agg(
        F.max_by(F.struct("error_class", "metrics"), latest).alias("_found")
    )
    error = F.when(F.col("_found").isNull(), MISSING).otherwise(F.col("_found.error_class"))
    return named.join(found, file_name("result_file") == F.col("_name"), "left").select(
        *KEYS,
        F.col("timestamp").alias("benchmark_run_at"),
        "result_file",
        error.alias("error_class"),
        F.col("_found.metrics").alias("metrics"),
    )


def _of_task(completed: DataFrame, task_type: str) -> DataFrame:
    return completed.where(F.col("error_class").isNull() & (F.col("task_type") == task_type))


def _metrics(names: dict) -> list:
    return [F.col(f"metrics.`{source}`").alias(target) for source, target in names.items()]


def _table(completed: DataFrame, task_type: str, names: dict) -> DataFrame:
    return _of_task(completed, task_type).select(
        "model", "pretrained", "benchmark", "benchmark_run_at", *_metrics(names)
    )


def classification_metrics(completed: DataFrame) -> DataFrame:
    return _table(completed, CLASSIFICATION, CLASSIFICATION_METRICS)


def retrieval_metrics(completed: DataFrame) -> DataFrame:
    return _table(completed, RETRIEVAL, RETRIEVAL_METRICS)


def merged_metrics(completed: DataFrame) -> DataFrame:
    """Both tasks in one table, in one pass; the other task's metrics are null."""
    tasks = [(CLASSIFICATION, CLASSIFICATION_METRICS), (RETRIEVAL, RETRIEVAL_METRICS)]
    metrics = [
        F.when(F.col("task_type") == task, F.col(f"metrics.`{source}`")).alias(target)
        for task, names in tasks
        for source, target in names.items()
    ]
    usable = completed.where(
        F.col("error_class").isNull() & F.col("task_type").isin([task for task, _ in tasks])
    )
    return usable.select(*KEYS, "benchmark_run_at", *metrics).select(MERGED_COLUMNS)


def parse_errors(completed: DataFrame) -> DataFrame:
    """Files that gave no metrics, with the reason."""
    return completed.where(F.col("error_class").isNotNull()).select("result_file", "error_class")
