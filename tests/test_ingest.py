import shutil
from pathlib import Path

from conftest import plan, rows
from pyspark.sql import functions as F

from gridledger.operators import ledger as L
from gridledger.operators import matching
from gridledger.sinks import documents
from gridledger.sources import results
from gridledger.sources.results import kept_listing, list_results, listing_of, read_documents, with_content
from gridledger.streaming.ingest import compact_facts, ingest_new_files, ledger_from_facts, read_facts
from workload import queries

KEY = "model string, pretrained string, task_type string, benchmark string"
C = "zeroshot_classification"


def ledger(spark):
    return L.new_ledger(spark.createDataFrame([(m, "w", C, f"b_{i}") for m in "xy" for i in range(4)], KEY))


def name(model, i):
    return f"b_{i}_w_{model}_en_{C}.json"


def test_any_split_of_the_files_equals_one_batch(spark, result_file, tmp_path):
    store, facts, checkpoint = [str(tmp_path / n) for n in ("results", "facts", "checkpoint")]

    def ingest(max_files=None):
        ingest_new_files(spark, store, facts, checkpoint, max_files)

    result_file(name("x", 0), '{"metrics": {"acc1": 0.1}}', "2025-01-01T00:00:00")
    result_file(name("x", 1), "[]", "2025-01-02T00:00:00")
    ingest()
    for i in range(4):
        result_file(name("y", i), '{"metrics": {"acc1": 0.2}}', f"2025-01-0{i + 1}T00:00:00")
    result_file("stray.json", "{}")
    ingest(max_files=2)
    ingest()  # nothing new
    batch = L.upsert(ledger(spark), matching.match_by_name(ledger(spark), list_results(spark, store)))
    streamed = ledger_from_facts(ledger(spark), read_facts(spark, facts))
    assert rows(streamed) == rows(batch)
    assert rows(L.status_counts(streamed)) == [(8, 6, 2)]
    found = {r.file_name: (r.error_class, r.metrics and r.metrics.acc1) for r in read_facts(spark, facts).collect()}
    assert found[name("x", 0)] == (None, 0.1) and found[name("x", 1)] == ("not_object", None) and len(found) == 7

    # A lost checkpoint reads all files again, under a new run: same facts, same ledger.
    shutil.rmtree(checkpoint)
    ingest(max_files=3)
    assert len(list((tmp_path / "facts").glob("run=*"))) == 2
    assert rows(ledger_from_facts(ledger(spark), read_facts(spark, facts))) == rows(batch)
    assert read_facts(spark, facts).count() == 7


def test_a_replayed_batch_replaces_its_own_folder(spark, result_file, tmp_path):
    store, facts, checkpoint = [str(tmp_path / n) for n in ("results", "facts", "checkpoint")]
    result_file(name("x", 0), '{"metrics": {"acc1": 0.1}}')
    ingest_new_files(spark, store, facts, checkpoint)
    before = rows(read_facts(spark, facts))
    # Without its commit the batch counts as not done and runs again.
    for f in (tmp_path / "checkpoint" / "commits").glob("*0*"):
        f.unlink()
    ingest_new_files(spark, store, facts, checkpoint)
    assert rows(read_facts(spark, facts)) == before
    assert spark.read.parquet(f"{facts}/run=*/batch=*").count() == 1


def test_the_latest_reading_of_a_file_counts(spark, result_file, tmp_path):
    store, facts = str(tmp_path / "results"), str(tmp_path / "facts")
    result_file(name("x", 0), '{"metrics": {"acc1": 0.1}}', "2025-01-01T00:00:00")
    ingest_new_files(spark, store, facts, str(tmp_path / "c1"))
    result_file(name("x", 0), '{"metrics": {"acc1": 0.9}}', "2025-02-01T00:00:00")
    ingest_new_files(spark, store, facts, str(tmp_path / "c2"))
    assert [r.metrics.acc1 for r in read_facts(spark, facts).collect()] == [0.9]


def test_files_that_a_stream_passes_over(spark, result_file, tmp_path):
    """Old time stamps, rewritten and empty files, a lost checkpoint: always the batch ledger."""
    store, facts, checkpoint = [str(tmp_path / n) for n in ("results", "facts", "checkpoint")]

    def check(checkpoint=checkpoint, max_files=None):
        ingest_new_files(spark, store, facts, checkpoint, max_files)
        batch = L.upsert(ledger(spark), matching.match_by_name(ledger(spark), list_results(spark, store)))
        assert rows(ledger_from_facts(ledger(spark), read_facts(spark, facts))) == rows(batch)
        read = rows(read_documents(spark, store).select("result_file", "error_class", "metrics"))
        assert rows(read_facts(spark, facts).select("result_file", "error_class", "metrics")) == read
        return {r.file_name: (r.error_class, r.metrics and r.metrics.acc1) for r in read_facts(spark, facts).collect()}

    check()  # no folder yet
    result_file(name("x", 0), '{"metrics": {"acc1": 0.1}}', "2025-06-01T00:00:00")
    check()
    result_file(name("x", 1), '{"metrics": {"acc1": 0.2}}', "2025-01-01T00:00:00")
    result_file(name("x", 2), "", "2025-06-02T00:00:00")
    found = check()
    assert found[name("x", 1)] == (None, 0.2) and found[name("x", 2)][0] == "missing_or_empty"
    result_file(name("x", 0), '{"metrics": {"acc1": 0.9}}', "2025-07-01T00:00:00")
    assert check()[name("x", 0)] == (None, 0.9)
    result_file(name("x", 0), '{"metrics": {"acc1": 0.33}}', "2024-01-01T00:00:00")  # an older copy put back
    assert check()[name("x", 0)] == (None, 0.33)
    for i in range(4):
        result_file(name("y", i), "[]", f"2023-01-0{i + 1}T00:00:00")
    check(checkpoint=None, max_files=2)
    shutil.rmtree(checkpoint)
    found = check(max_files=3)
    compact_facts(spark, facts)
    assert len(list((tmp_path / "facts").glob("run=*"))) == 1 and check() == found and len(found) == 7


def test_the_driver_of_a_stream_knows_arrivals_and_not_the_files_of_the_store(spark, result_file, tmp_path):
    store, facts, checkpoint = [str(tmp_path / n) for n in ("results", "facts", "checkpoint")]
    for i in range(60):
        result_file(f"f{i}.json", "" if i == 7 else "{}")
    ingest_new_files(spark, store, facts, checkpoint)
    result_file("g.json", "[]", "2020-01-01T00:00:00")
    ingest_new_files(spark, store, facts, checkpoint)
    # The log of a file source has a line for each file that it has seen, and the driver holds them all.
    seen = [line for log in (tmp_path / "checkpoint" / "sources" / "0").glob("[0-9]*") for line in log.read_text().splitlines()[1:]]
    assert 1 <= len(seen) <= 4 and not any("/results/" in line for line in seen)
    found = read_facts(spark, facts)
    assert found.count() == 61 and found.where("error_class = 'missing_or_empty'").count() == 1


def test_a_batch_of_a_stream_is_bounded(spark, result_file, tmp_path):
    facts, checkpoint = str(tmp_path / "facts"), str(tmp_path / "checkpoint")
    for i in range(25):
        result_file(f"f{i}.json", "{}")
    ingest_new_files(spark, str(tmp_path / "results"), facts, checkpoint, 10)
    sizes = [spark.read.parquet(str(batch)).count() for batch in (tmp_path / "facts").glob("run=*/batch=*")]
    assert sum(sizes) == 25 and len(sizes) >= 3 and max(sizes) <= 10


def test_session_settings_are_put_back(spark, result_file, tmp_path):
    setting = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(setting)
    result_file("a.json", "{}")
    ingest_new_files(spark, str(tmp_path / "results"), str(tmp_path / "f"), str(tmp_path / "c"))
    assert spark.conf.get(setting) == before


def test_facts_of_two_paths_for_one_cell(spark):
    facts = spark.createDataFrame(
        [("r1/" + name("x", 0), name("x", 0), 1), ("r2/" + name("x", 0), name("x", 0), 2)], "result_file string, file_name string, t long"
    ).withColumn("mtime", F.timestamp_seconds("t"))
    done = L.completed_rows(ledger_from_facts(ledger(spark), facts)).collect()
    assert [r.result_file for r in done] == ["r2/" + name("x", 0)]


def test_a_flat_folder_is_listed_by_several_tasks(spark, result_file, tmp_path):
    for i in range(300):
        result_file(f"f{i}.json", "x" * (i % 7), "2025-01-01T00:00:00")
    (tmp_path / "results" / "notes.txt").write_text("no result")
    (tmp_path / "results" / "folder.json").mkdir()
    listing = list_results(spark, str(tmp_path / "results"))
    tasks = listing.select(F.spark_partition_id().alias("task")).groupBy("task").count().collect()
    assert len(tasks) >= 2 and max(r["count"] for r in tasks) < 200
    assert sorted((r.file_name, r.length) for r in listing.collect()) == sorted((f"f{i}.json", i % 7) for i in range(300))


def test_many_documents_are_in_folders_that_are_dealt_to_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(documents, "FOLDER_FILES", 10)
    docs = spark.range(400).selectExpr("concat('f', id, '.json') AS file_name", "repeat('x', cast(id % 7 AS int)) AS doc")
    folders = documents.write_document_folders(docs, f"file:{tmp_path}/store")
    sizes = [len(list(folder.iterdir())) for folder in (tmp_path / "store").iterdir()]
    assert sum(sizes) == 400 and len(sizes) >= 30 and max(sizes) <= 40
    listing = list_results(spark, *folders)
    # A task reads the names of its own folders only.
    assert listing.rdd.getNumPartitions() == len(sizes)
    assert sorted((r.file_name, r.length) for r in listing.collect()) == sorted((f"f{i}.json", i % 7) for i in range(400))
    read = with_content(kept_listing(listing)).selectExpr("file_name", "cast(content AS string) AS doc")
    assert rows(read) == rows(docs)
    assert documents.write_document_folders(docs.limit(0), f"{tmp_path}/none") and list_results(spark, f"{tmp_path}/none/00000").isEmpty()


def test_result_files_come_and_go_in_waves(spark, tmp_path, monkeypatch):
    kind = "element_at(array('click', 'view', 'error'), cast(id % 3 + 1 AS int)) AS event_type"
    props = "cast(id AS double) AS value, concat('{k: ', id, '}') AS props, current_timestamp() AS ts"
    spark.sql(f"SELECT id AS event_id, id % 4 AS user_id, {kind}, {props} FROM range(60)").write.parquet(f"{tmp_path}/events.parquet")
    spark.sql("SELECT id AS p_partkey, 'TYPE' AS p_type FROM range(4)").write.parquet(f"{tmp_path}/part.parquet")
    nation = "SELECT cast(id AS int) AS n_nationkey, concat('N', id) AS n_name, cast(id % 5 AS int) AS n_regionkey FROM range(25)"
    spark.sql(nation).write.parquet(f"{tmp_path}/nation.parquet")
    root, on_disk, write = Path(spark.conf.get("spark.checkpoint.dir")), [], queries.write_document_folders

    def files():
        return len(list(root.glob("results-*/**/*.json")))

    def watched(docs, folder):
        folders = write(docs, folder)
        on_disk.append(files() - before)
        return folders

    before = files()
    monkeypatch.setattr(queries, "write_document_folders", watched)
    for query in ("result_listing", "result_file_status"):
        whole = rows(queries.QUERIES[query](spark, str(tmp_path)))
        assert len(whole) == len({r[0] for r in whole}) == 60 and on_disk.pop() == 60 and files() == before
        monkeypatch.setattr(queries, "WAVE_FILES", 15, raising=False)
        assert rows(queries.QUERIES[query](spark, str(tmp_path))) == whole
        assert len(on_disk) == 4 and sum(on_disk) == 60 and max(on_disk) < 30 and files() == before
        monkeypatch.undo()
        monkeypatch.setattr(queries, "write_document_folders", watched)
        on_disk.clear()


def test_a_table_of_files_is_a_listing(spark, result_file, tmp_path):
    for i in range(9):
        result_file(f"f{i}.json", "{}", f"2025-01-0{i + 1}T00:00:00")
    listing = list_results(spark, str(tmp_path / "results"))
    table = listing.select(F.col("result_file").alias("path"), "mtime", "length", F.lit(1).alias("file_name"))
    assert rows(listing_of(table)) == rows(listing)
    read = with_content(kept_listing(listing_of(table)))
    assert read.count() == 9 and read.where("content = CAST('{}' AS BINARY)").count() == 9


def test_tasks_that_read_grow_with_the_files(spark, result_file, tmp_path, monkeypatch):
    for i in range(40):
        result_file(f"f{i}.json", "{}")
    listing = kept_listing(list_results(spark, str(tmp_path / "results")))
    assert with_content(listing).rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
    monkeypatch.setattr(results, "TASK_FILES", 4)
    monkeypatch.setattr(results, "TASK_BYTES", 1 << 20)
    assert "10" in plan(with_content(listing)).split("hashpartitioning(result_file")[1][:12]
