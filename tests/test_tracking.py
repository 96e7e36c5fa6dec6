import pyarrow.parquet as pq
import pytest
from conftest import rows

from gridledger.operators import ledger as L
from gridledger.plans.planning import load_pending_groups
from gridledger.plans.tracking import (
    export_ledger,
    import_ledger,
    init_changes,
    init_tracking,
    parse_results,
    read_report,
    update_tracking,
    update_tracking_incrementally,
)
from gridledger.runtime import session_setting, shared_folder
from gridledger.sinks.documents import write_documents
from gridledger.sinks.ledger import write_ledger, write_ledger_csv
from gridledger.sources.ledger import read_ledger, stored_status_counts
from gridledger.streaming import ingest
from gridledger.versions import VersionTaken, next_version

C, R = "zeroshot_classification", "zeroshot_retrieval"


@pytest.fixture
def catalogs(spark):
    models = spark.createDataFrame([("ViT-B-32", "laion2b_s34b_b79k"), ("RN50", "openai")], "model string, pretrained string")
    benchmarks = spark.createDataFrame([(C, "fgvc_aircraft"), (C, "pets"), (R, "flickr8k")], "task_type string, benchmark string")
    return models, benchmarks


def test_campaign(spark, catalogs, result_file, tmp_path):
    models, benchmarks = catalogs
    root, results, out = [str(tmp_path / n) for n in ("ledger", "results", "out")]
    assert rows(L.status_counts(init_tracking(spark, root, models, benchmarks))) == [(6, 0, 6)]
    result_file("fgvc_aircraft_laion2b_s34b_b79k_ViT-B-32_en_zeroshot_classification.json", '{"metrics": {"acc1": 0.25}}')
    result_file("flickr8k_openai_RN50_en_zeroshot_retrieval.json", '{"metrics": {')
    result_file("what.json", "{}")
    update = update_tracking(spark, root, results)
    assert rows(L.status_counts(update.ledger)) == [(6, 2, 4)]
    assert [r.file_name for r in update.unexpected.collect()] == ["what.json"]
    errors = parse_results(spark, root, results, out, "merged")
    assert [r.error_class for r in errors.collect()] == ["decode"]
    plan = load_pending_groups(spark, root)
    assert {r.model: (r.num_benchmarks, r.gpu_requirement) for r in plan.collect()} == {"ViT-B-32": (2, "T4"), "RN50": (2, "T4")}
    assert load_pending_groups(spark, root, 1, seed=3).count() == 1

    # One model leaves, one comes; what is known of the rest stays.
    changed = spark.createDataFrame([("RN50", "openai"), ("RN101", "openai")], "model string, pretrained string")
    assert rows(L.status_counts(init_tracking(spark, root, changed, benchmarks))) == [(6, 1, 5)]
    assert rows(L.status_counts(init_tracking(spark, root, changed, benchmarks, force_reset=True))) == [(6, 0, 6)]
    facts = str(tmp_path / "facts")
    found = update_tracking_incrementally(spark, root, results, facts, str(tmp_path / "checkpoint"))
    assert rows(L.status_counts(found)) == [(6, 1, 5)]
    errors = parse_results(spark, root, results, out, facts=facts)
    assert rows(errors) == rows(parse_results(spark, root, results, out)) and errors.count() == 1


def test_before_any_result(spark, catalogs, tmp_path):
    root, results, out = [str(tmp_path / n) for n in ("ledger", "results", "out")]
    init_tracking(spark, root, *catalogs)
    update = update_tracking(spark, root, results)
    assert rows(L.status_counts(update.ledger)) == [(6, 0, 6)] and update.unexpected.isEmpty()
    found = update_tracking_incrementally(spark, root, results, str(tmp_path / "facts"), str(tmp_path / "checkpoint"))
    assert rows(L.status_counts(found)) == [(6, 0, 6)]
    assert parse_results(spark, root, results, out).isEmpty()
    assert not (tmp_path / "out").exists()


def test_update_by_parsing(spark, catalogs, result_file, tmp_path):
    root, results = str(tmp_path / "ledger"), str(tmp_path / "results")
    init_tracking(spark, root, *catalogs)
    result_file("fgvc_aircraft_laion2b_s34b_b79k_ViT-B-32_en_zeroshot_classification.json", "{}")
    result_file("pets_openai_RN50_en_zeroshot_classification.json", "{}")
    result_file("what.json", "{}")
    update = update_tracking(spark, root, results, by_parsing=True)
    assert rows(L.status_counts(update.ledger)) == [(6, 1, 5)]
    assert [r.file_name for r in update.unexpected.collect()] == ["what.json"]
    assert [r.benchmark for r in update.orphans.collect()] == ["fgvc"]  # a benchmark with _ is cut short


def test_imported_ledgers_find_their_files(spark, result_file, tmp_path):
    """Paths of a ledger may be relative, or of another place than the store."""
    name = "pets_openai_RN50_en_zeroshot_classification.json"
    result_file(name, '{"metrics": {"acc1": 0.5, "acc5": 0.75}}')
    lines = ["model,pretrained,task_type,benchmark,result_file,timestamp,status"]
    lines += [f"RN50,openai,{C},pets,results/{name},2025-01-01T00:00:00,completed"]
    lines += [f"RN50,openai,{C},cars,s3://other/results/none.json,2025-01-01T00:00:00,completed", f"RN50,openai,{C},dtd,,,pending"]
    (tmp_path / "old.csv").write_text("\n".join(lines) + "\n")
    root, out = str(tmp_path / "ledger"), str(tmp_path / "out")
    import_ledger(spark, root, str(tmp_path / "old.csv"))
    errors = parse_results(spark, root, str(tmp_path / "results"), out)
    assert rows(errors) == [("s3://other/results/none.json", "missing_or_empty")]
    table = spark.read.csv(f"{out}/classification_metrics.csv", header=True)
    assert [(r.benchmark, r.accuracy, r.top5_accuracy) for r in table.collect()] == [("pets", "0.5", "0.75")]


def test_changes_of_the_grid(spark, catalogs, tmp_path):
    models, benchmarks = catalogs
    root = str(tmp_path / "ledger")
    first = init_changes(spark, root, models, benchmarks)
    assert first.added.count() == 6 and first.dropped.isEmpty()
    init_tracking(spark, root, models, benchmarks)
    changed = init_changes(spark, root, models.where("model = 'RN50'"), benchmarks)
    assert changed.added.isEmpty() and {r.model for r in changed.dropped.collect()} == {"ViT-B-32"}


def test_two_writers(spark, catalogs, tmp_path):
    root = str(tmp_path / "ledger")
    ledger = init_tracking(spark, root, *catalogs)
    version = next_version(spark, root)
    write_ledger(ledger, root, version)
    with pytest.raises(VersionTaken):
        write_ledger(ledger, root, version)
    (tmp_path / "ledger" / "view").mkdir()  # other folders are no versions
    for _ in range(4):
        init_tracking(spark, root, *catalogs)
    assert len(list((tmp_path / "ledger").glob("v0*"))) == 3 and read_ledger(spark, root).count() == 6


def test_rows_of_a_file_are_sorted(spark, tmp_path):
    models = spark.createDataFrame([(f"m{i * 7 % 50:02d}", f"w{i % 3}") for i in range(50)], "model string, pretrained string")
    benchmarks = spark.createDataFrame([(t, f"b{i}") for t in (C, R) for i in range(20)], "task_type string, benchmark string")
    init_tracking(spark, str(tmp_path / "ledger"), models, benchmarks)
    files = list((tmp_path / "ledger").glob("data/*/task_type=*/*.parquet"))
    for file in files:
        keys = [(r["model"], r["pretrained"]) for r in pq.read_table(file, columns=["model", "pretrained"], partitioning=None).to_pylist()]
        assert keys == sorted(keys)
    assert len(files) >= 2


def test_import(spark, catalogs, tmp_path):
    root = str(tmp_path / "ledger")
    write_ledger_csv(init_tracking(spark, str(tmp_path / "first"), *catalogs), str(tmp_path / "csv"))
    assert import_ledger(spark, root, str(tmp_path / "csv")).count() == 6
    assert read_ledger(spark, root).count() == 6


def test_grids_with_shared_file_names_are_refused(spark, tmp_path):
    models = spark.createDataFrame([("m", "b_c"), ("m", "c")], "model string, pretrained string")
    benchmarks = spark.createDataFrame([(C, "a"), (C, "a_b")], "task_type string, benchmark string")
    with pytest.raises(ValueError, match="expect the same file"):
        init_tracking(spark, str(tmp_path / "ledger"), models, benchmarks)


def test_written_documents(spark, tmp_path):
    docs = spark.createDataFrame([(f"f{i}.json", "x" * i) for i in range(30)], "file_name string, doc string")
    write_documents(docs, f"file:{tmp_path}/store")
    assert {p.name: p.stat().st_size for p in (tmp_path / "store").iterdir()} == {f"f{i}.json": i for i in range(30)}


def test_shared_folder_is_under_the_checkpoint_folder(spark):
    assert shared_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


# --- incremental updates, reports, files ---


def campaign(spark, tmp_path, models=40):
    root = str(tmp_path / "ledger")
    rows_ = spark.createDataFrame([(f"m{i:02d}", "w") for i in range(models)], "model string, pretrained string")
    benchmarks = spark.createDataFrame([(C, f"b{i}") for i in range(20)], "task_type string, benchmark string")
    with session_setting(spark, "spark.sql.adaptive.coalescePartitions.enabled", "false"):
        init_tracking(spark, root, rows_, benchmarks)
    return root, str(tmp_path / "results"), str(tmp_path / "facts")


def name_of(model, i):
    return f"b{i}_w_m{model:02d}_en_{C}.json"


def data_files(tmp_path):
    return set((tmp_path / "ledger" / "data").rglob("*.parquet"))


def test_one_new_result_rewrites_one_range(spark, result_file, tmp_path):
    root, results, facts = campaign(spark, tmp_path)
    for i in range(20):
        result_file(name_of(3, i), '{"metrics": {"acc1": 0.5}}')
    first = data_files(tmp_path)
    assert len(first) > 2
    update_tracking_incrementally(spark, root, results, facts)
    second = data_files(tmp_path)
    assert 1 <= len(second - first) < len(first)
    result_file(name_of(30, 1), "{}", "2024-01-01T00:00:00")  # late, with an old time stamp
    result_file("stray.json", "{}")
    found = update_tracking_incrementally(spark, root, results, facts)
    assert len(data_files(tmp_path) - second) == 1
    # The same ledger as a batch update of a new one gives.
    other = str(tmp_path / "batch")
    write_ledger(L.new_ledger(read_ledger(spark, root)), other)
    assert rows(found) == rows(update_tracking(spark, other, results).ledger)
    assert rows(stored_status_counts(spark, root)) == rows(L.status_counts(found)) == [(800, 21, 779)]
    # Nothing new: nothing is written.
    versions = sorted(p.name for p in (tmp_path / "ledger").glob("v0*"))
    update_tracking_incrementally(spark, root, results, facts)
    assert sorted(p.name for p in (tmp_path / "ledger").glob("v0*")) == versions


def test_a_file_that_is_put_back_older(spark, result_file, tmp_path):
    root, results, facts = campaign(spark, tmp_path, 4)
    times = []
    for when in ("2025-05-01T00:00:00", "2025-06-01T00:00:00", "2025-01-01T00:00:00"):
        result_file(name_of(1, 1), "{}", when)
        found = update_tracking_incrementally(spark, root, results, facts)
        times += [r.timestamp for r in L.completed_rows(found).collect()]
    assert times == ["2025-05-01T00:00:00", "2025-06-01T00:00:00", "2025-01-01T00:00:00"]


def test_cells_that_come_later_find_old_results(spark, result_file, tmp_path):
    root, results, facts = campaign(spark, tmp_path, 2)
    result_file(name_of(3, 1), "{}")
    assert L.completed_rows(update_tracking_incrementally(spark, root, results, facts)).isEmpty()
    models = spark.createDataFrame([(f"m{i:02d}", "w") for i in range(5)], "model string, pretrained string")
    benchmarks = spark.createDataFrame([(C, f"b{i}") for i in range(20)], "task_type string, benchmark string")
    init_tracking(spark, root, models, benchmarks)
    found = update_tracking_incrementally(spark, root, results, facts)
    assert [(r.model, r.benchmark) for r in L.completed_rows(found).collect()] == [("m03", "b1")]


def test_facts_are_merged_by_size(spark, result_file, tmp_path, monkeypatch):
    monkeypatch.setattr(ingest, "TIER", 3)
    root, results, facts = campaign(spark, tmp_path, 6)
    for n in range(8):
        result_file(name_of(n % 6, n), '{"metrics": {"acc1": 0.%d}}' % n)
        found = update_tracking_incrementally(spark, root, results, facts)
        assert rows(L.status_counts(found)) == [(120, n + 1, 119 - n)]
        assert ingest.read_facts(spark, facts).count() == n + 1
        folders = ingest.fact_folders(spark, facts)
        assert len(folders) <= 7
    merged = [f for f in folders if f.startswith("run=compact")]
    assert merged and ingest.new_folders(spark, facts, folders, folders) == []
    # What a merge is made of counts as applied with it.
    assert ingest.new_folders(spark, facts, merged, [x for f in merged for x in ingest._replaced(spark, facts, f)]) == []


def test_the_store_is_listed_once_a_call(spark, result_file, tmp_path, monkeypatch):
    listed = []
    monkeypatch.setattr(ingest, "list_results", lambda *a, real=ingest.list_results: listed.append(a) or real(*a))
    for i in range(12):
        result_file(f"f{i}.json", "{}")
    ingest.ingest_new_files(spark, str(tmp_path / "results"), str(tmp_path / "facts"), max_files=3)
    assert len(listed) == 1 and ingest.read_facts(spark, str(tmp_path / "facts")).count() == 12
    assert len(ingest.fact_folders(spark, str(tmp_path / "facts"))) >= 4


def test_reports_stay_true(spark, catalogs, result_file, tmp_path):
    models, benchmarks = catalogs
    root, results = str(tmp_path / "ledger"), str(tmp_path / "results")
    init_tracking(spark, root, models, benchmarks)
    assert read_report(spark, root, "added").count() == 6 and read_report(spark, root, "dropped").isEmpty()
    init_tracking(spark, root, models.where("model = 'RN50'"), benchmarks)
    assert {r.model for r in read_report(spark, root, "dropped").collect()} == {"ViT-B-32"}
    result_file("what.json", "{}")
    update = update_tracking(spark, root, results)
    result_file("more.json", "{}")  # after the update
    for _ in range(3):
        init_tracking(spark, root, models, benchmarks)
    assert read_report(spark, root, "unexpected") is None
    kept = {p.name for p in (tmp_path / "ledger" / "reports").iterdir()}
    assert kept == {p.name for p in (tmp_path / "ledger").glob("v0*")}
    update = update_tracking(spark, root, results)
    assert {r.file_name for r in update.unexpected.collect()} == {"what.json", "more.json"}
    assert rows(read_report(spark, root, "unexpected")) == rows(update.unexpected)


def test_an_update_from_a_table_of_files(spark, catalogs, tmp_path):
    root = str(tmp_path / "ledger")
    init_tracking(spark, root, *catalogs)
    name = "pets_openai_RN50_en_zeroshot_classification.json"
    files = [(f"s3a://b/results/{name}", "2025-02-03 04:05:06.789012", 10, "x"), ("s3a://b/results/notes.txt", "2025-02-03 04:05:06", 1, "y")]
    table = spark.createDataFrame(files, "path string, mtime string, length int, etag string")
    update = update_tracking(spark, root, table)
    assert [(r.result_file, r.timestamp) for r in L.completed_rows(update.ledger).collect()] == [(files[0][0], "2025-02-03T04:05:06.789000")]
    assert update.unexpected.isEmpty()


def test_tables_as_single_files(spark, catalogs, result_file, tmp_path):
    root, results, out = [str(tmp_path / n) for n in ("ledger", "results", "out")]
    init_tracking(spark, root, *catalogs)
    result_file("pets_openai_RN50_en_zeroshot_classification.json", '{"metrics": {"acc1": 0.5}}')
    update_tracking(spark, root, results)
    for _ in range(2):  # an older file is replaced
        parse_results(spark, root, results, out, single_files=True)
        lines = (tmp_path / "out" / "classification_metrics.csv").read_text().splitlines()
        assert lines[0].startswith("model,pretrained,benchmark") and lines[1].startswith("RN50,openai,pets") and len(lines) == 2
    assert [p.name for p in (tmp_path / "out").iterdir() if not p.name.startswith(".")] == ["classification_metrics.csv"]
    export_ledger(spark, root, str(tmp_path / "ledger.csv"), single_file=True)
    assert len((tmp_path / "ledger.csv").read_text().splitlines()) == 7
    export_ledger(spark, root, str(tmp_path / "folder.csv"))
    assert (tmp_path / "folder.csv").is_dir()
