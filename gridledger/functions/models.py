"""Model size, run time and cost."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridledger import fixed
from gridledger.schemas import RETRIEVAL

METADATA_SCHEMA = T.StructType(
    [
        T.StructField("model", T.StringType()),
        T.StructField("gpu_memory_gb", T.IntegerType()),
        T.StructField("parameters_millions", T.IntegerType()),
        T.StructField("recommended_gpu", T.StringType()),
        T.StructField("batch_size_hint", T.IntegerType()),
        T.StructField("architecture_family", T.StringType()),
    ]
)
REQUIREMENT_FIELDS = METADATA_SCHEMA.fieldNames()[1:]


def _by_name(model: Column, field: int) -> Column:
    """One field of the first fallback row whose substring occurs in the name."""
    *rules, default = fixed.MODEL_FALLBACKS
    value = F.lit(default[field])
    for row in reversed(rules):
        hit = reduce(lambda a, b: a | b, [F.contains(model, F.lit(text)) for text in row[0]])
        value = F.when(hit, row[field]).otherwise(value)
    return value


def with_requirement(df: DataFrame, model: str = "model") -> DataFrame:
    """Add memory, parameters, GPU, batch size and family of each row's model.

    The metadata table has 23 fixed rows, so it is sent to every task.
    """
    metadata = df.sparkSession.createDataFrame(fixed.MODEL_METADATA, METADATA_SCHEMA)
    known = metadata.select(
        F.col("model").alias("_model"), *[F.col(f).alias(f"_{f}") for f in REQUIREMENT_FIELDS]
    )
    joined = df.join(F.broadcast(known), df[model] == F.col("_model"), "left")
    name = F.col(model)
    return joined.select(
        *df.columns,
        *[
            F.coalesce(f"_{f}", _by_name(name, i)).alias(f)
            for i, f in enumerate(REQUIREMENT_FIELDS, 1)
        ],
    )


def _lookup(values: dict, key: Column, default: float) -> Column:
    pairs = [F.lit(x) for item in values.items() for x in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), key), F.lit(default))


def runtime_minutes(family="architecture_family", task_type="task_type", benchmark="benchmark"):
    """Estimated minutes of one run; whole minutes are cut, not rounded."""
    size = F.lit(fixed.OTHER_FAMILY_FACTOR)
    for ending, factor in fixed.FAMILY_FACTORS.items():
        size = F.when(F.endswith(family, F.lit(ending)), factor).otherwise(size)
    task = F.when(F.col(task_type) == RETRIEVAL, fixed.RETRIEVAL_FACTOR).otherwise(1.0)
    dataset = _lookup(fixed.DATASET_FACTORS, F.col(benchmark), 1.0)
    minutes = (F.lit(float(fixed.BASE_MINUTES)) * size * task * dataset).cast("int")
    return F.greatest(F.lit(fixed.MIN_MINUTES), F.least(minutes, F.lit(fixed.MAX_MINUTES)))


def gpu_cost(gpu, hours, use_spot=True) -> Column:
    """Dollars for ``hours`` on ``gpu``, named with its count as in ``A100:1``."""
    gpu, hours = [F.col(c) if isinstance(c, str) else c for c in (gpu, hours)]
    use_spot = use_spot if isinstance(use_spot, Column) else F.lit(use_spot)
    price = _lookup(fixed.GPU_HOURLY_RATES, gpu, fixed.DEFAULT_HOURLY_RATE) * hours
    return F.when(use_spot, price * fixed.SPOT_FACTOR).otherwise(price)


def one_gpu(name="recommended_gpu") -> Column:
    """Rate-table name of one GPU of the recommended kind."""
    return F.concat(F.col(name), F.lit(":1"))
