"""Benchmark catalog, dataset configuration, and the grid of all runs."""

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridledger import fixed
from gridledger.runtime import row_bound
from gridledger.schemas import (
    CLASSIFICATION,
    DATASET_MAPPING,
    GROUP,
    KEYS,
    RETRIEVAL,
    SECTION_OF_CLASSIFICATION,
    SECTION_OF_RETRIEVAL,
)

# Benchmarks kept together when a catalog is too large to send whole.
CATALOG_BLOCK = 1_000


def model_catalog(models: DataFrame, model="model", pretrained="pretrained") -> DataFrame:
    """Distinct (model, pretrained) pairs of any table that names them."""
    return models.select(F.col(model).alias("model"), F.col(pretrained).alias("pretrained")).distinct()


def explode_mapping(docs: DataFrame, doc: str = "value") -> DataFrame:
    """Rows (section, name, webdataset_name, dataset_root, task) of mapping documents."""
    sections = docs.select(F.explode(F.from_json(doc, DATASET_MAPPING)).alias("section", "entries"))
    entries = sections.select("section", F.explode("entries").alias("name", "config"))
    return entries.select("section", "name", "config.*")


def default_mapping(spark: SparkSession) -> DataFrame:
    """The mapping of the named public datasets."""
    schema = "section string, name string, webdataset_name string, dataset_root string, task string"
    return spark.createDataFrame(fixed.DATASET_MAPPING, schema)


def benchmark_catalog(base: DataFrame, mapping: DataFrame) -> DataFrame:
    """Rows (task_type, benchmark).

    Classification: ``base.benchmark`` and the named extras, without repeats. Retrieval: the
    mapping's retrieval section.
    """
    spark = base.sparkSession
    extras = spark.createDataFrame([(n,) for n in fixed.EXTRA_CLASSIFICATION], "benchmark string")
    classification = base.select("benchmark").union(extras).distinct()
    retrieval = mapping.where(F.col("section") == SECTION_OF_RETRIEVAL).select(
        F.col("name").alias("benchmark")
    )
    return classification.select(F.lit(CLASSIFICATION).alias("task_type"), "benchmark").union(
        retrieval.select(F.lit(RETRIEVAL).alias("task_type"), "benchmark")
    )


def pair_grid(models: DataFrame, benchmarks: DataFrame) -> DataFrame:
    """Every (model, pretrained) with every (task_type, benchmark).

    The result is the product of two tables, and as large as it must be; what costs is how the
    catalog reaches the models. A catalog of checked size is sent whole. A larger one is cut into
    blocks, each of which meets the models in as many parts as a shuffle has. Models are few bytes in
    few partitions, but each makes many rows, so they are spread over as many tasks.
    """
    benchmarks = benchmarks.select("task_type", "benchmark")
    tasks = int(models.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = models.select(GROUP).repartition(tasks, *GROUP)
    if row_bound(benchmarks):
        return spread.crossJoin(F.broadcast(benchmarks)).select(KEYS)
    blocks = math.ceil(benchmarks.count() / CATALOG_BLOCK)
    part, block = F.pmod(F.xxhash64(*GROUP), F.lit(tasks)), F.pmod(F.xxhash64("task_type", "benchmark"), F.lit(blocks))

    def every(count: int):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long")))

    left = spread.select(*GROUP, part.alias("part")).select("*", every(blocks).alias("block"))
    right = benchmarks.select("*", block.alias("block")).select("*", every(tasks).alias("part"))
    return left.join(right, ["block", "part"]).select(KEYS)


def with_dataset_config(df: DataFrame, mapping: DataFrame) -> DataFrame:
    """Add webdataset_name, dataset_root and task of each row's benchmark.

    Every task but retrieval looks in the classification section. A benchmark without an
    entry is its own dataset, with root ``root``.
    """
    section = F.when(F.col("task_type") == RETRIEVAL, SECTION_OF_RETRIEVAL).otherwise(
        SECTION_OF_CLASSIFICATION
    )
    known = mapping.select(
        F.col("section").alias("_section"),
        F.col("name").alias("_name"),
        F.col("webdataset_name").alias("_web"),
        F.col("dataset_root").alias("_root"),
        F.col("task").alias("_task"),
    )
    # The mapping has a row per named dataset; it goes to the rows unless it has grown beyond that.
    known = F.broadcast(known) if row_bound(known) else known
    same = (section == F.col("_section")) & (F.col("benchmark") == F.col("_name"))
    return df.join(known, same, "left").select(
        *df.columns,
        F.coalesce("_web", "benchmark").alias("webdataset_name"),
        F.coalesce("_root", F.lit("root")).alias("dataset_root"),
        F.coalesce("_task", "task_type").alias("task"),
    )
