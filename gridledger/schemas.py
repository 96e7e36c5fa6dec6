"""Table shapes. Every input is read with an explicit schema."""

from pyspark.sql import types as T

KEYS = ["model", "pretrained", "task_type", "benchmark"]
GROUP = ["model", "pretrained"]

CLASSIFICATION = "zeroshot_classification"
RETRIEVAL = "zeroshot_retrieval"

PENDING = "pending"
COMPLETED = "completed"

# Why a result document gave no metric row.
MISSING = "missing_or_empty"
DECODE = "decode"
NOT_OBJECT = "not_object"
OTHER = "other"


def _strings(*names):
    return [T.StructField(name, T.StringType()) for name in names]


def _doubles(*names):
    return [T.StructField(name, T.DoubleType()) for name in names]


LEDGER_SCHEMA = T.StructType(_strings(*KEYS, "result_file", "timestamp", "status"))
LEDGER_COLUMNS = LEDGER_SCHEMA.fieldNames()

# The metric names inside a result document.
METRICS_SCHEMA = T.StructType(
    _doubles(
        "acc1",
        "acc5",
        "mean_per_class_recall",
        "image_retrieval_recall@5",
        "text_retrieval_recall@5",
        "mean_average_precision",
    )
)

# Metric name in the document -> column in the metric tables.
CLASSIFICATION_METRICS = {
    "acc1": "accuracy",
    "acc5": "top5_accuracy",
    "mean_per_class_recall": "mean_per_class_recall",
}
RETRIEVAL_METRICS = {
    "image_retrieval_recall@5": "image_retrieval_recall_at_5",
    "text_retrieval_recall@5": "text_retrieval_recall_at_5",
    "mean_average_precision": "mean_average_precision",
}

MERGED_COLUMNS = [
    "model",
    "pretrained",
    "benchmark",
    "task_type",
    *CLASSIFICATION_METRICS.values(),
    *RETRIEVAL_METRICS.values(),
    "benchmark_run_at",
]

DATASET_CONFIG = T.StructType(_strings("webdataset_name", "dataset_root", "task"))
DATASET_MAPPING = T.MapType(T.StringType(), T.MapType(T.StringType(), DATASET_CONFIG))
SECTION_OF_RETRIEVAL = "retrieval_datasets"
SECTION_OF_CLASSIFICATION = "classification_datasets"

# What ingest stores per reading of a result file.
FACTS_SCHEMA = T.StructType(
    [
        T.StructField("result_file", T.StringType()),
        T.StructField("file_name", T.StringType()),
        T.StructField("mtime", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("error_class", T.StringType()),
        T.StructField("metrics", METRICS_SCHEMA),
        T.StructField("read_at", T.TimestampType()),
    ]
)
