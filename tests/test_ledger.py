import json
import os
import random
import threading
import time
from datetime import datetime

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from gridledger.operators import ledger as L
from gridledger.runtime import session_setting
from gridledger.schemas import KEYS, LEDGER_SCHEMA
from gridledger.sinks.ledger import expire_ledger, update_ledger, write_ledger, write_ledger_csv
from gridledger.sources.ledger import read_ledger, read_ledger_csv, stored_status_counts
from gridledger.versions import VersionTaken, next_version

KEY = "model string, pretrained string, task_type string, benchmark string"
RESULT = KEY + ", result_file string, mtime timestamp"
C = "zeroshot_classification"


def grid(spark, models=("a", "b"), benchmarks=("x", "y", "z")):
    return spark.createDataFrame([(m, "w", C, b) for m in models for b in benchmarks], KEY)


def result(model, benchmark, name, when):
    return (model, "w", C, benchmark, name, datetime.fromisoformat(when))


def test_fresh(spark):
    fresh = L.new_ledger(grid(spark))
    assert fresh.columns == LEDGER_SCHEMA.fieldNames()
    assert rows(L.status_counts(fresh)) == [(6, 0, 6)]


def test_merge_drops_old_cells_and_fills_nulls(spark):
    old = spark.createDataFrame(
        [("a", "w", C, "x", "f", "t", "completed"), ("a", "w", C, "y", None, None, None), ("gone", "w", C, "x", "f", "t", "completed")],
        LEDGER_SCHEMA,
    )
    merged = {(r.model, r.benchmark): tuple(r[4:]) for r in L.merge_ledger(grid(spark), old).collect()}
    assert merged == {(m, b): ("", "", "pending") for m in "ab" for b in "xyz"} | {("a", "x"): ("f", "t", "completed")}
    assert L.added_cells(grid(spark), old).count() == 4


def test_upsert_takes_the_latest_file(spark):
    found = [
        result("a", "x", "f1", "2025-01-01T00:00:00"),
        result("a", "x", "f2", "2025-01-02T00:00:00"),
        result("b", "y", "g1", "2025-01-02T00:00:00.5"),
        result("b", "y", "g2", "2025-01-02T00:00:00.5"),
        result("unknown", "y", "h", "2025-01-02T00:00:00"),
    ]
    results = spark.createDataFrame(found, RESULT)
    once = L.upsert(L.new_ledger(grid(spark)), results)
    assert once.count() == 6
    done = {(r.model, r.benchmark): (r.result_file, r.timestamp) for r in L.completed_rows(once).collect()}
    assert done == {("a", "x"): ("f2", "2025-01-02T00:00:00"), ("b", "y"): ("g2", "2025-01-02T00:00:00.500000")}
    assert rows(L.upsert(once, results)) == rows(once)
    nothing = results.limit(0)
    assert rows(L.upsert(once, nothing)) == rows(once)


def test_group_rows(spark):
    ledger = L.upsert(L.new_ledger(grid(spark)), spark.createDataFrame([result("a", "x", "f", "2025-01-01T00:00:00")], RESULT))
    assert [r.benchmark for r in L.group_rows(ledger, "a", "w").orderBy("benchmark").collect()] == ["y", "z"]


def test_upsert_with_a_third_of_all_results_on_one_key(spark):
    draw = random.Random(5)
    found = [
        ("a" if i % 3 == 0 else f"m{draw.randrange(50)}", "w", C, "x", f"f{draw.randrange(900)}", datetime(2025, 1, 1, 0, draw.randrange(40)))
        for i in range(6000)
    ]
    models = ["a", "unrun"] + [f"m{i}" for i in range(50)]
    ledger = L.upsert(L.new_ledger(grid(spark, models, ["x"])), spark.createDataFrame(found, RESULT))
    best = {}
    for model, *_, name, when in found:
        best[model] = max(best.get(model, (when, name)), (when, name))
    expected = {m: (best[m][1], best[m][0].isoformat()) if m in best else ("", "") for m in models}
    assert {r.model: (r.result_file, r.timestamp) for r in ledger.collect()} == expected


def test_upsert_combines_before_the_shuffle(spark):
    results = spark.range(100).select(*[F.lit("k").alias(k) for k in KEYS], F.col("id").cast("string").alias("result_file"), F.current_timestamp().alias("mtime"))
    text = plan(L.latest_results(results))
    assert text.count("Exchange") == 1 and text.index("partial_max") > text.index("Exchange")


def test_versions(spark, tmp_path):
    root = str(tmp_path / "ledger")
    with pytest.raises(FileNotFoundError):
        read_ledger(spark, root)
    first = L.new_ledger(grid(spark))
    write_ledger(first, root)
    assert rows(read_ledger(spark, root)) == rows(first)
    # A ledger is rewritten from itself.
    write_ledger(L.upsert(read_ledger(spark, root), spark.createDataFrame([result("a", "x", "f", "2025-01-01T00:00:00")], RESULT)), root)
    assert rows(L.status_counts(read_ledger(spark, root))) == [(6, 1, 5)]
    # A version without its marker was not finished.
    (tmp_path / "ledger" / "v00000007").mkdir()
    assert rows(L.status_counts(read_ledger(spark, root))) == [(6, 1, 5)]
    assert write_ledger(first, root).endswith("v00000008")


def test_csv_import_keeps_empty_text(spark, tmp_path):
    ledger = L.upsert(L.new_ledger(grid(spark)), spark.createDataFrame([result("a", "x", "f", "2025-01-01T00:00:00")], RESULT))
    write_ledger_csv(ledger, str(tmp_path / "csv"))
    assert rows(read_ledger_csv(spark, str(tmp_path / "csv"))) == rows(ledger)


def test_filters_reach_the_scan(spark, tmp_path):
    root = str(tmp_path / "ledger")
    write_ledger(L.new_ledger(grid(spark)), root)
    text = plan(L.group_rows(read_ledger(spark, root), "a", "w").where(F.col("task_type") == C).select("benchmark"))
    assert "EqualTo(status,pending)" in text and "EqualTo(model,a)" in text and "EqualTo(pretrained,w)" in text
    assert "PartitionFilters: [isnotnull(task_type" in text
    assert "ReadSchema: struct<model:string,pretrained:string,benchmark:string,status:string>" in text


def test_old_versions_are_deleted_on_request(spark, tmp_path):
    root = str(tmp_path / "ledger")
    for _ in range(4):
        write_ledger(L.new_ledger(grid(spark)), root)
    expire_ledger(spark, root, keep=2)
    assert sorted(p.name for p in (tmp_path / "ledger").iterdir()) == ["data", "v00000003", "v00000004"]
    assert len(list((tmp_path / "ledger" / "data").iterdir())) == 2
    expire_ledger(spark, root, keep=5)
    assert read_ledger(spark, root).count() == 6


# --- updates that share files ---


def large_ledger(spark, root):
    rows = spark.range(3000).selectExpr(
        "concat('m', lpad(id % 60, 2, '0')) AS model", "'w' AS pretrained", "concat('b', id) AS benchmark", f"'{C}' AS task_type"
    )
    # In small tables adaptive execution would put all ranges together.
    with session_setting(spark, "spark.sql.adaptive.coalescePartitions.enabled", "false"):
        write_ledger(L.new_ledger(rows), root)


def data_files(tmp_path):
    return {p for p in (tmp_path / "ledger" / "data").rglob("*.parquet")}


def listed(spark, *found):
    return spark.createDataFrame(
        [(f"s/{name}", name, when) for name, when in found], "result_file string, file_name string, mtime string"
    ).withColumn("mtime", F.col("mtime").cast("timestamp"))


def test_one_result_rewrites_one_file(spark, tmp_path):
    root = str(tmp_path / "ledger")
    large_ledger(spark, root)
    before, old = data_files(tmp_path), read_ledger(spark, root)
    assert len(before) > 2
    listing = listed(spark, (f"b61_w_m01_en_{C}.json", "2025-01-02 00:00:00"), ("stray.json", "2025-01-02 00:00:00"))
    expected = rows(L.upsert_by_name(old, listing))
    changed = update_ledger(spark, root, listing)
    assert len(changed) == 1 and len(data_files(tmp_path) - before) == 1
    assert rows(read_ledger(spark, root)) == expected
    assert rows(stored_status_counts(spark, root)) == rows(L.status_counts(read_ledger(spark, root))) == [(3000, 1, 2999)]
    # What is known already changes no file.
    assert update_ledger(spark, root, listing) == [] and rows(read_ledger(spark, root)) == expected
    # Two cells of two files, and the same cell again.
    listing = listed(spark, (f"b61_w_m01_en_{C}.json", "2025-03-02 00:00:00"), (f"b2939_w_m59_en_{C}.json", "2025-03-02 00:00:00"))
    expected = rows(L.upsert_by_name(read_ledger(spark, root), listing))
    assert len(update_ledger(spark, root, listing)) == 2 and rows(read_ledger(spark, root)) == expected
    # The files that only old versions had go; those that are shared stay.
    expire_ledger(spark, root, keep=1)
    assert len(data_files(tmp_path)) == len(before) and rows(read_ledger(spark, root)) == expected
    assert [p.name for p in (tmp_path / "ledger").iterdir() if p.name.startswith("v")] == ["v00000004"]


def test_counts_read_no_rows(spark, tmp_path):
    root = str(tmp_path / "ledger")
    large_ledger(spark, root)
    text = plan(stored_status_counts(spark, root))
    assert "parquet" not in text.lower() and "FileScan" not in text


def test_the_ledger_is_not_shuffled_to_find_changes(spark, tmp_path):
    root = str(tmp_path / "ledger")
    large_ledger(spark, root)
    found = L.changed_cells(read_ledger(spark, root), listed(spark, (f"b61_w_m01_en_{C}.json", "2025-01-02 00:00:00")))
    found.collect()
    final = plan(found).split("Initial Plan")[0]
    assert "BroadcastHashJoin" in final and final.count("FileScan") == 1
    # The one shuffle by a key is that of the few results.
    assert final.count("Exchange hashpartitioning") == final.count("Exchange hashpartitioning(file_name") == 1


def test_a_ledger_of_few_bytes_is_not_sent_whole(spark, tmp_path):
    """Many rows may be few bytes in files; with as many results no side goes to the driver."""
    root = str(tmp_path / "ledger")
    large_ledger(spark, root)
    name = F.concat(F.lit("b"), "id", F.lit(f"_w_m01_en_{C}.json"))
    listing = spark.range(25_000).select(name.alias("file_name"), name.alias("result_file"), F.timestamp_seconds("id").alias("mtime"))
    expected = L.changed_cells(read_ledger(spark, root), listing.where("id < 100")).count()
    for found in (L.changed_cells(read_ledger(spark, root), listing), L.upsert_by_name(read_ledger(spark, root), listing)):
        found.collect()
        assert "Broadcast" not in plan(found).split("Initial Plan")[0]
    assert 0 < expected <= L.changed_cells(read_ledger(spark, root), listing).count()


def test_an_empty_ledger(spark, tmp_path):
    root = str(tmp_path / "ledger")
    write_ledger(L.new_ledger(grid(spark)).limit(0), root)
    assert read_ledger(spark, root).count() == 0
    assert update_ledger(spark, root, listed(spark, ("a.json", "2025-01-02 00:00:00"))) == []
    assert rows(stored_status_counts(spark, root)) == [(0, 0, 0)]


# --- claims ---


def test_a_claim_that_ran_out_is_taken_over(spark, tmp_path):
    root = tmp_path / "ledger"
    write_ledger(L.new_ledger(grid(spark)), str(root))
    for content in ('{"writer": "gone", "until": 1.0}', ""):
        name = next_version(spark, str(root)).rpartition("/")[2]
        claim = root / f"_claim-{name}"
        claim.write_text(content)
        os.utime(claim, (1, 1))
        write_ledger(L.new_ledger(grid(spark)), str(root))
        assert not list(root.glob("_claim*")) and not list(root.glob("_writing*"))
    assert read_ledger(spark, str(root)).count() == 6


def test_a_claim_that_is_valid_is_respected(spark, tmp_path):
    root = tmp_path / "ledger"
    write_ledger(L.new_ledger(grid(spark)), str(root))
    before = data_files(tmp_path)
    for content in (json.dumps({"writer": "other", "until": time.time() + 60}), ""):
        claim = root / "_claim-v00000002"
        claim.unlink(missing_ok=True)
        claim.write_text(content)  # one without content was made just now
        with pytest.raises(VersionTaken):
            write_ledger(L.new_ledger(grid(spark)), str(root))
        assert claim.exists() and not list(root.glob("_writing*")) and data_files(tmp_path) == before
    claim.unlink()
    assert write_ledger(L.new_ledger(grid(spark)), str(root)).endswith("v00000002")


def test_of_two_writers_one_wins(spark, tmp_path):
    root = str(tmp_path / "ledger")
    version, done, failed = next_version(spark, root), [], []

    def write():
        try:
            done.append(write_ledger(L.new_ledger(grid(spark)), root, version))
        except VersionTaken:
            failed.append(version)

    writers = [threading.Thread(target=write) for _ in range(3)]
    for writer in writers:
        writer.start()
    for writer in writers:
        writer.join()
    assert len(done) == 1 and len(failed) == 2 and read_ledger(spark, root).count() == 6
    assert len(list((tmp_path / "ledger" / "data").iterdir())) == 1


def test_what_dead_writers_left_goes_after_a_day(spark, tmp_path):
    root = tmp_path / "ledger"
    write_ledger(L.new_ledger(grid(spark)), str(root))
    for name in ("_writing-a", "data/abandoned"):
        (root / name).mkdir()
    expire_ledger(spark, str(root))
    assert (root / "_writing-a").exists() and (root / "data/abandoned").exists()
    for name in ("_writing-a", "data/abandoned"):
        os.utime(root / name, (1, 1))
    expire_ledger(spark, str(root))
    assert not (root / "_writing-a").exists() and not (root / "data/abandoned").exists()
    assert read_ledger(spark, str(root)).count() == 6
