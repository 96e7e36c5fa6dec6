"""What is left to run, and how runs went."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridledger import fixed
from gridledger.functions.models import with_requirement
from gridledger.operators.ledger import pending_rows
from gridledger.schemas import COMPLETED, GROUP


def pending_groups(ledger: DataFrame) -> DataFrame:
    """Pending runs by (model, pretrained): ``runs`` holds (task_type, benchmark) in order.

    Ledger keys are unique, so a group is at most as long as the benchmark catalog.
    """
    run = F.struct("task_type", "benchmark")
    return pending_rows(ledger).groupBy(GROUP).agg(
        F.sort_array(F.collect_list(run)).alias("runs"),
        F.count("*").cast("int").alias("num_benchmarks"),
    )


def sampled_groups(groups: DataFrame, n: int | None = None, seed: int = 0) -> DataFrame:
    """Groups in an order drawn from ``seed``, all of them or the first ``n``."""
    ordered = groups.orderBy(F.md5(F.concat_ws("|", F.lit(str(seed)), *GROUP)))
    return ordered.limit(n) if n else ordered


def group_plan(groups: DataFrame, max_benchmarks: int | None = None) -> DataFrame:
    """Add the GPU each group needs and its planned minutes."""
    runs = F.col("num_benchmarks")
    planned = F.least(runs, F.lit(max_benchmarks)) if max_benchmarks else runs
    return with_requirement(groups).select(
        *groups.columns,
        F.col("recommended_gpu").alias("gpu_requirement"),
        (planned * fixed.PLANNED_MINUTES_PER_BENCHMARK).alias("estimated_runtime_minutes"),
    )


def plan_summary(plan: DataFrame, gpu_fraction: float = 0.125) -> DataFrame:
    """One row: groups, runs, minutes, and how many jobs a node holds at once."""
    at_once = (F.lit(fixed.GPUS_PER_NODE) / F.lit(gpu_fraction)).cast("int")
    return plan.agg(
        F.count("*").alias("groups"),
        F.coalesce(F.sum("num_benchmarks"), F.lit(0)).alias("total_benchmarks"),
        F.coalesce(F.sum("estimated_runtime_minutes"), F.lit(0)).alias("total_minutes"),
    ).withColumn("max_concurrent_jobs", at_once)


def first_n_per_group(ledger: DataFrame, n: int | None) -> DataFrame:
    """The first ``n`` pending runs of each group, in (task_type, benchmark) order."""
    pending = pending_rows(ledger)
    if not n:
        return pending
    order = Window.partitionBy(*GROUP).orderBy("task_type", "benchmark")
    return pending.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= n).drop("_n")


def run_summary(log: DataFrame, *by: str) -> DataFrame:
    """Runs, failures and times of each group of a run log.

    The log has status, runtime_seconds (null if unknown), started_at and ended_at.
    """
    micros = 1_000_000.0
    overall = F.max(F.unix_micros("ended_at")) - F.min(F.unix_micros("started_at"))
    counted = log.groupBy(*(by or GROUP)).agg(
        F.count("*").alias("attempted"),
        F.count_if(F.coalesce(F.col("status") != COMPLETED, F.lit(True))).alias("failed"),
        F.coalesce(F.sum("runtime_seconds"), F.lit(0.0)).alias("benchmark_seconds"),
        (overall / micros).alias("overall_seconds"),
    )
    overhead = F.col("overall_seconds") - F.col("benchmark_seconds")
    return counted.withColumn("overhead_seconds", overhead).withColumn("ok", F.col("failed") == 0)
