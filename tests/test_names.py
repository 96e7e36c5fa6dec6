import pytest
from conftest import rows
from pyspark.sql import functions as F

from gridledger.operators.ledger import latest_by_name
from gridledger.functions.names import expected_name, group_label, with_parsed_name
from gridledger.operators import matching
from gridledger.operators.catalog import default_mapping

C, R = "zeroshot_classification", "zeroshot_retrieval"

PARSED = {
    "cifar10_openai_ViT-B-32_en_zeroshot_classification.json": ("cifar10", "openai", "ViT-B-32", C),
    "mscoco_captions_openai_ViT-B-32_en_zeroshot_retrieval.json": ("mscoco_captions", "openai", "ViT-B-32", R),
    "cifar10_openai_convnext_base_w_en_zeroshot_classification.json": ("cifar10", "openai", "convnext_base_w", C),
    "cifar10_webli_ViT-B-16-SigLIP_en_zeroshot_classification.json": ("cifar10", "webli", "ViT-B-16-SigLIP", C),
    "cifar10_laion2b_s34b_b79k_ViT-B-32_en_zeroshot_classification.json": ("cifar10", "laion2b", "s34b", C),
    "fgvc_aircraft_openai_ViT-B-32_en_zeroshot_classification.json": ("fgvc", "openai", "ViT-B-32", C),
    "mscoco_captions2017_openai_ViT-B-32_en_zeroshot_retrieval.json": ("mscoco", "openai", "ViT-B-32", R),
    "a_openai_en_zeroshot_retrieval.json": ("a", "openai", "unknown", R),
    "a_openai__en_zeroshot_classification.json": ("a", "openai", "", C),
    "a_x_openai_M_n_zeroshot_retrieval.json": ("a", "openai", "M_n", R),
    "a.json_openai_M_en_zeroshot_classification.json": ("a", "openai", "M", C),
    "a_b_c_d_classification_retrieval": ("a", "b", "c", C),
    "x_captions_retrieval_q_r.json": ("x_captions", "retrieval", "q", R),
    "openai_openai_en_x_retrieval": ("openai", "openai", "unknown", R),
    "a_b_c_retrieval_openai": ("a", "openai", "unknown", R),
    "a.json": None,
    "a_b_c_d_e.json": None,
    "": None,
    "____": None,
    "_b_captions_x_retrieval": ("", "b", "captions", R),
}


def test_parsed_names(spark):
    df = spark.createDataFrame([(n,) for n in PARSED], "file_name string").repartition(3)
    found = {r.file_name: r.key and tuple(r.key) for r in with_parsed_name(df).collect()}
    assert found == PARSED


def test_no_python_in_the_parser(spark):
    from conftest import plan

    df = spark.range(1).select(F.lit("a").alias("file_name"))
    assert "Python" not in plan(with_parsed_name(df))


@pytest.mark.parametrize("weights, right", [("openai", 30), ("webli", 30), ("laion2b_s34b_b79k", 0), ("laion400m_e32", 0)])
def test_parsing_loses_keys_that_matching_by_name_keeps(spark, weights, right):
    ledger = default_mapping(spark).select(
        F.lit("ViT-B-32").alias("model"), F.lit(weights).alias("pretrained"),
        F.col("task").alias("task_type"), F.col("name").alias("benchmark"),
    )
    listing = ledger.select(expected_name().alias("file_name")).select(
        F.concat(F.lit("r/"), "file_name").alias("result_file"), "file_name", F.current_timestamp().alias("mtime")
    )
    keys = set(rows(ledger))
    parsed = matching.match_by_parsing(listing).drop("result_file", "mtime")
    assert len(keys & set(rows(parsed))) == right
    named = matching.match_by_name(ledger, listing)
    assert set(rows(named.drop("result_file", "mtime"))) == keys
    assert named.count() == 44
    assert matching.unexpected_files(ledger, listing).isEmpty()
    assert matching.ambiguous_names(ledger).isEmpty()


def test_ambiguous_names_are_found(spark):
    key = "model string, pretrained string, task_type string, benchmark string"
    ledger = spark.createDataFrame([("m", "c", R, "a_b"), ("m", "b_c", R, "a"), ("m", "x", R, "a")], key)
    assert [r.cells for r in matching.ambiguous_names(ledger).collect()] == [2]


def test_unmatched_report_and_orphans(spark):
    names = [f"x{i}.json" for i in range(8)] + ["cifar10_openai_M_en_zeroshot_classification.json"]
    listing = spark.createDataFrame([(f"r/{n}", n, None) for n in names], "result_file string, file_name string, mtime timestamp")
    report = matching.report(matching.unmatched_files(listing).select("file_name"), "file_name")
    assert rows(report) == [(f"x{i}.json", 8) for i in range(5)]
    key = "model string, pretrained string, task_type string, benchmark string"
    ledger = spark.createDataFrame([("N", "openai", C, "cifar10")], key)
    orphans = matching.orphan_results(matching.match_by_parsing(listing), ledger)
    assert [r.model for r in orphans.collect()] == ["M"]


def test_latest_by_name_with_one_name_in_a_third_of_the_files(spark):
    files = spark.range(9_000).select(
        F.when(F.col("id") % 3 == 0, "hot.json").otherwise(F.concat(F.lit("n"), "id")).alias("file_name"),
        F.concat(F.lit("r/"), "id").alias("result_file"),
        F.timestamp_seconds((F.col("id") * 7919) % 5000).alias("mtime"),
    )
    kept = {r.file_name: (r.mtime, r.result_file) for r in latest_by_name(files).collect()}
    brute = {}
    for r in files.collect():
        brute[r.file_name] = max(brute.get(r.file_name, (r.mtime, r.result_file)), (r.mtime, r.result_file))
    assert kept == brute


def test_group_label(spark):
    df = spark.createDataFrame([("hf/a", "b")], "model string, pretrained string")
    assert df.select(group_label("p-group")).first()[0] == "p-group-hf-a-b"
