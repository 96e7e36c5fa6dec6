"""Read dataset mapping files."""

from pyspark.sql import DataFrame, SparkSession

from gridledger.operators.catalog import explode_mapping


def read_dataset_mapping(spark: SparkSession, path: str) -> DataFrame:
    return explode_mapping(spark.read.text(path, wholetext=True))


def read_model_catalog(spark: SparkSession, path: str) -> DataFrame:
    """CSV with the columns model and pretrained."""
    return spark.read.schema("model string, pretrained string").csv(path, header=True)
