from datetime import datetime

from conftest import rows
from pyspark.sql import functions as F

from gridledger.operators import ledger as L
from gridledger.operators import planning

KEY = "model string, pretrained string, task_type string, benchmark string"
C, R = "zeroshot_classification", "zeroshot_retrieval"


def ledger(spark):
    cells = [(m, "w", t, b) for m in ("ViT-L-14", "RN50", "done") for t, b in ((R, "a"), (C, "z"), (C, "b"))]
    fresh = L.new_ledger(spark.createDataFrame(cells, KEY))
    return fresh.withColumn("status", F.when(F.col("model") == "done", "completed").otherwise(F.col("status")))


def test_groups_keep_benchmark_and_task_together(spark):
    groups = planning.pending_groups(ledger(spark))
    runs = {r.model: [tuple(x) for x in r.runs] for r in groups.collect()}
    assert runs == {m: [(C, "b"), (C, "z"), (R, "a")] for m in ("ViT-L-14", "RN50")}
    assert groups.agg(F.sum("num_benchmarks")).first()[0] == L.pending_rows(ledger(spark)).count()


def test_plan_and_summary(spark):
    groups = planning.pending_groups(ledger(spark))
    plan = planning.group_plan(groups)
    assert rows(plan.select("model", "num_benchmarks", "gpu_requirement", "estimated_runtime_minutes")) == [
        ("RN50", 3, "T4", 6),
        ("ViT-L-14", 3, "V100", 6),
    ]
    assert rows(planning.plan_summary(plan)) == [(2, 6, 12, 64)]
    assert rows(planning.plan_summary(planning.group_plan(groups, 2), 0.25)) == [(2, 6, 8, 32)]
    assert rows(planning.plan_summary(plan.limit(0), 0.3)) == [(0, 0, 0, 26)]


def test_sampled_groups(spark):
    groups = spark.range(200).select(F.concat(F.lit("m"), "id").alias("model"), F.lit("w").alias("pretrained"))
    first = [r.model for r in planning.sampled_groups(groups, 20, 1).collect()]
    assert first == [r.model for r in planning.sampled_groups(groups.repartition(7), None, 1).collect()][:20]
    assert first != [r.model for r in planning.sampled_groups(groups, 20, 2).collect()]
    assert planning.sampled_groups(groups, 0).count() == 200


def test_first_n_per_group(spark):
    found = rows(planning.first_n_per_group(ledger(spark), 2).select("model", "task_type", "benchmark"))
    assert found == [(m, C, b) for m in ("RN50", "ViT-L-14") for b in ("b", "z")]
    assert planning.first_n_per_group(ledger(spark), None).count() == 6


def test_run_summary(spark):
    at = lambda s: datetime(2025, 1, 1, 0, 0, s)
    log = spark.createDataFrame(
        [("m", "w", "completed", 10.0, at(0), at(10)), ("m", "w", "failed", 5.5, at(12), at(18)), ("m", "w", None, None, at(19), at(20)),
         ("n", "w", "completed", 1.0, at(0), at(1))],
        "model string, pretrained string, status string, runtime_seconds double, started_at timestamp, ended_at timestamp",
    )
    assert rows(planning.run_summary(log)) == [("m", "w", 3, 2, 15.5, 20.0, 4.5, False), ("n", "w", 1, 0, 1.0, 1.0, 0.0, True)]
    assert rows(planning.run_summary(log, "pretrained").select("attempted")) == [(4,)]
