import csv

import pytest
from conftest import rows

from gridledger.functions.names import expected_name
from gridledger.operators import ledger as L
from gridledger.operators import matching, metrics
from gridledger.schemas import LEDGER_SCHEMA, MERGED_COLUMNS
from gridledger.sinks.metrics import write_metrics
from gridledger.sources.results import list_results, read_documents

KEY = "model string, pretrained string, task_type string, benchmark string"
C, R = "zeroshot_classification", "zeroshot_retrieval"
CELLS = [("ViT-B-32", "openai", C, "cifar10"), ("ViT-B-32-quickgelu", "openai", C, "cifar10"), ("ViT-B-32", "openai", R, "mscoco_captions")]
# Published results of three runs.
CLASSIFICATION_CSV = [
    ["model", "pretrained", "benchmark", "benchmark_run_at", "accuracy", "top5_accuracy", "mean_per_class_recall"],
    ["ViT-B-32", "openai", "cifar10", "2025-07-29T13:58:14", "0.8653", "0.9922", "0.8652999999999998"],
    ["ViT-B-32-quickgelu", "openai", "cifar10", "2025-07-29T14:15:52", "0.8982", "0.9961", "0.8982999999999999"],
]
RETRIEVAL_CSV = [
    ["model", "pretrained", "benchmark", "benchmark_run_at", "image_retrieval_recall_at_5", "text_retrieval_recall_at_5", "mean_average_precision"],
    ["ViT-B-32", "openai", "mscoco_captions", "2025-07-29T16:19:35", "0.5497800707817078", "0.7333999872207642", ""],
]


@pytest.fixture
def golden(spark, result_file, tmp_path):
    """Ledger and documents of the published runs, read from files."""
    result_file("cifar10_openai_ViT-B-32_en_zeroshot_classification.json", '{"metrics": {"acc1": 0.8653, "acc5": 0.9922, "mean_per_class_recall": 0.8652999999999998}}')
    result_file("cifar10_openai_ViT-B-32-quickgelu_en_zeroshot_classification.json", '{"metrics": {"acc1": 0.8982, "acc5": 0.9961, "mean_per_class_recall": 0.8982999999999999}}', "2025-07-29T14:15:52")
    result_file("mscoco_captions_openai_ViT-B-32_en_zeroshot_retrieval.json", '{"metrics": {"image_retrieval_recall@5": 0.5497800707817078, "text_retrieval_recall@5": 0.7333999872207642}}', "2025-07-29T16:19:35")
    folder = str(tmp_path / "results")
    ledger = L.new_ledger(spark.createDataFrame(CELLS, KEY))
    ledger = L.upsert(ledger, matching.match_by_name(ledger, list_results(spark, folder)))
    return metrics.completed_documents(ledger, read_documents(spark, folder))


def read_csv_folder(path):
    found, header = [], None
    for part in sorted(path.glob("part-*.csv")):
        with open(part) as f:
            lines = list(csv.reader(f))
        header = lines[0]
        found += lines[1:]
    return [header, *sorted(found)]


def test_golden_tables(golden, tmp_path):
    out = tmp_path / "out"
    assert write_metrics(golden, str(out)) == ["classification_metrics", "retrieval_metrics"]
    assert read_csv_folder(out / "classification_metrics.csv") == CLASSIFICATION_CSV
    assert read_csv_folder(out / "retrieval_metrics.csv") == RETRIEVAL_CSV


def test_golden_merged(golden, tmp_path):
    out = tmp_path / "out"
    assert write_metrics(golden, str(out), "merged") == ["all_metrics"]
    table = read_csv_folder(out / "all_metrics.csv")
    assert table[0] == MERGED_COLUMNS and len(table) == 4
    assert ["ViT-B-32", "openai", "mscoco_captions", R, "", "", "", "0.5497800707817078", "0.7333999872207642", "", "2025-07-29T16:19:35"] in table


def test_a_table_without_rows_keeps_its_old_folder(spark, golden, tmp_path):
    out = tmp_path / "out"
    write_metrics(golden, str(out))
    nothing = golden.where("task_type = 'zeroshot_classification'")
    assert write_metrics(nothing, str(out)) == ["classification_metrics"]
    assert read_csv_folder(out / "retrieval_metrics.csv") == RETRIEVAL_CSV


def test_every_kind_of_file(spark, result_file, tmp_path):
    shapes = {
        "full": '{"metrics": {"acc1": 0.5}}', "bare": "{}", "cut": '{"metr', "tail": '{"metrics":{}} x', "list": "[1]",
        "empty": "", "bytes": b'{"metrics": "\xff"}', "bom": b'\xef\xbb\xbf{"metrics": {}}',
    }
    paths = {name: result_file(f"{name}.json", text) for name, text in shapes.items()}
    result_file("ignored.txt", "{}")
    result_file("below.json", "{}", folder="results/deeper")
    paths["lost"] = f"file:{tmp_path}/results/lost.json"
    ledger = spark.createDataFrame(
        [("m", "w", C, n, p, "t", "completed") for n, p in paths.items()]
        + [("m", "w", C, "unset", "", "t", "completed"), ("m", "w", C, "null", None, "t", "completed"),
           ("m", "w", C, "todo", "x", "", "pending"), ("m", "w", "other", "full", paths["full"], "t", "completed")],
        LEDGER_SCHEMA,
    )
    folder = str(tmp_path / "results")
    assert {r.file_name for r in list_results(spark, folder).collect()} == {f"{n}.json" for n in shapes}
    completed = metrics.completed_documents(ledger, read_documents(spark, folder))
    found = {r.benchmark: r.error_class for r in completed.where(f"task_type = '{C}'").collect()}
    assert found == {
        "full": None, "bare": None, "cut": "decode", "tail": "decode", "list": "not_object", "empty": "missing_or_empty",
        "bytes": "other", "bom": "decode", "lost": "missing_or_empty",
    }
    assert rows(metrics.classification_metrics(completed).select("benchmark", "accuracy")) == [("bare", None), ("full", 0.5)]
    assert metrics.parse_errors(completed).count() == 7
    assert metrics.merged_metrics(completed).count() == 2


def test_listing_does_not_read_contents(spark, result_file, tmp_path):
    result_file("a.json", "{}")
    listing = list_results(spark, str(tmp_path / "results"))
    (tmp_path / "results" / "a.json").chmod(0)
    assert [(r.file_name, r.length) for r in listing.collect()] == [("a.json", 2)]
    assert "content" not in listing.columns


def test_merged_rows_are_those_of_both_tables(spark, golden):
    both = metrics.classification_metrics(golden).count() + metrics.retrieval_metrics(golden).count()
    assert metrics.merged_metrics(golden).count() == both


def test_expected_name_of_a_language(spark):
    cell = spark.createDataFrame(CELLS[:1], KEY)
    assert cell.select(expected_name(language="de")).first()[0] == "cifar10_openai_ViT-B-32_de_zeroshot_classification.json"
