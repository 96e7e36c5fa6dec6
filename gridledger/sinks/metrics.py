import uuid

from pyspark.sql import DataFrame

from gridledger.operators.metrics import classification_metrics, merged_metrics, retrieval_metrics
from gridledger.runtime import row_bound
from gridledger.versions import folder_of

# Rows up to which a table can be written as one file.
FILE_ROWS = 1_000_000

TABLES = {
    "separate": {
        "classification_metrics": classification_metrics,
        "retrieval_metrics": retrieval_metrics,
    },
    "merged": {"all_metrics": merged_metrics},
}


def write_csv(rows: DataFrame, path: str, single_file: bool = False) -> bool:
    """Write a table as a CSV folder, or as one file if it has few rows; False if it has none.

    What is at the path already stays if there are no rows, and is replaced otherwise.
    """
    if rows.isEmpty():
        return False
    if not single_file or not row_bound(rows, FILE_ROWS):
        rows.write.mode("overwrite").csv(path, header=True)
        return True
    spark, written = rows.sparkSession, f"{path}-writing-{uuid.uuid4().hex}"
    rows.coalesce(1).write.csv(written, header=True)
    store, folder = folder_of(spark, written)
    part = next(f.getPath() for f in store.listStatus(folder) if f.getPath().getName().startswith("part-"))
    _, target = folder_of(spark, path)
    store.delete(target, True)
    if not store.rename(part, target):
        raise OSError(f"cannot rename {part} to {path}")
    store.delete(folder, True)
    return True


def write_metrics(
    completed: DataFrame, folder: str, output_format: str = "separate", single_files: bool = False
) -> list[str]:
    """Write the metric tables as CSV folders, or small ones as files; a table without rows keeps what
    is there. ``completed`` should be a table, as it is read for each of them. Returns the names written."""
    return [
        name
        for name, table in TABLES[output_format].items()
        if write_csv(table(completed), f"{folder.rstrip('/')}/{name}.csv", single_files)
    ]
