"""Result file names: build them from a ledger key, or read a key out of them."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridledger import fixed
from gridledger.schemas import CLASSIFICATION, RETRIEVAL


def expected_name(
    benchmark="benchmark", pretrained="pretrained", model="model", task_type="task_type",
    language: str = "en",
) -> Column:
    """``{benchmark}_{pretrained}_{model}_{language}_{task_type}.json``"""
    stem = F.concat_ws("_", benchmark, pretrained, model, F.lit(language), task_type)
    return F.concat(stem, F.lit(".json"))


def group_label(prefix: str, model="model", pretrained="pretrained") -> Column:
    """Job label of a (model, pretrained) group; ``/`` is not allowed in it."""
    return F.replace(F.concat_ws("-", F.lit(prefix), model, pretrained), F.lit("/"), F.lit("-"))


def file_name(path="path") -> Column:
    return F.substring_index(path, "/", -1)


def _first_position(items: Column, words: list[str]) -> Column:
    """1-based position of the first item that is one of ``words``, else null."""
    positions = [F.nullif(F.array_position(items, word), F.lit(0)) for word in words]
    return reduce(lambda a, b: F.least(a, b), positions)


def with_parsed_name(df: DataFrame, name: str = "file_name") -> DataFrame:
    """Add ``key``: struct (benchmark, pretrained, model, task_type) read from a name, or null.

    Names carry no escape for ``_``, so a key whose benchmark or weights hold one is read
    wrong. ``operators.matching.match_by_name`` has no such loss; this is kept for names
    that no ledger expects.

    Each step is a column of its own, as later steps use it several times.
    """
    parts, rest, at, tail = [F.col(c) for c in ("_parts", "_rest", "_at", "_tail")]
    steps = df.withColumn("_parts", F.split(F.replace(name, F.lit(".json"), F.lit("")), "_"))
    # `captions` in second place belongs to the benchmark's name.
    steps = steps.withColumn("_width", F.when(F.get(parts, F.lit(1)) == "captions", 2).otherwise(1))
    steps = steps.withColumn("_rest", F.slice(parts, F.col("_width") + 1, F.size(parts)))
    # A part holds no `_`, so only names without one can be met.
    known = [p for p in fixed.KNOWN_PRETRAINED if "_" not in p]
    steps = steps.withColumn("_at", _first_position(rest, known).cast("int"))
    steps = steps.withColumn("_tail", F.slice(rest, F.coalesce(at, F.lit(0)) + 1, F.size(rest)))
    steps = steps.withColumn("_stop", _first_position(tail, fixed.MODEL_STOP_WORDS).cast("int"))
    own = F.slice(tail, F.lit(1), F.coalesce(F.col("_stop") - 1, F.size(tail)))
    steps = steps.withColumn("_own", own)
    found = F.when(F.size("_own") == 0, "unknown").otherwise(F.concat_ws("_", "_own"))
    steps = steps.withColumn("_found", F.when(at.isNotNull(), F.nullif(found, F.lit(""))))

    task_type = (
        F.when(F.array_contains(parts, "classification"), CLASSIFICATION)
        .when(F.array_contains(parts, "retrieval"), RETRIEVAL)
    )
    by_place = F.col("_found").isNull()
    key = F.struct(
        F.concat_ws("_", F.slice(parts, F.lit(1), F.col("_width"))).alias("benchmark"),
        F.get(rest, F.when(by_place, 0).otherwise(at - 1)).alias("pretrained"),
        F.coalesce("_found", F.get(rest, F.lit(1))).alias("model"),
        task_type.alias("task_type"),
    )
    key = F.when((F.size(parts) >= 5) & task_type.isNotNull(), key)
    return steps.select(*df.columns, key.alias("key"))
