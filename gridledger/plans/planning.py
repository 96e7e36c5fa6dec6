from pyspark.sql import DataFrame, SparkSession

from gridledger.operators import planning
from gridledger.sources.ledger import read_ledger


def load_pending_groups(
    spark: SparkSession,
    root: str,
    max_groups: int | None = None,
    seed: int = 0,
    max_benchmarks: int | None = None,
) -> DataFrame:
    """Plan of the pending groups, all of them or ``max_groups`` drawn by ``seed``.

    At most ``max_benchmarks`` of each group's runs count for its minutes.
    """
    groups = planning.pending_groups(read_ledger(spark, root))
    return planning.sampled_groups(planning.group_plan(groups, max_benchmarks), max_groups, seed)
