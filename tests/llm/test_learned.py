"""Quality and language: held-out accuracy, and defined results on odd rows. The pipeline."""

from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

import corpus_pipeline
from brute import FOLDER, ROWS, byte_grams, decoded, first_lines, groups, rule_score, taken, word_set
from gridledger.llm import language, mixing, packing, quality

SF = "/root/testdata/sf0.01"
EDGES = [(1, None), (2, ""), (3, " \n "), (4, "?!"), (5, "12 34"), (6, "the " * 30_000), (7, "É"), (None, "the of and"), (7, "É")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


def crc(doc_id, of):
    import zlib

    return zlib.crc32(str(doc_id).encode()) % of


def test_quality_of_held_out_documents(spark, docs, labels):
    edge = spark.createDataFrame(EDGES, "doc_id long, text string").selectExpr("doc_id + 10000 AS doc_id", "text")
    table = docs.select("doc_id", "text").union(edge).selectExpr("*", "1 AS stats", "2 AS label")
    found = quality.scored(table, labels).collect()
    assert len(found) == docs.count() + len(EDGES)
    known = {r.doc_id: r.quality for r in labels.collect()}
    held = [(r.score, known[r.doc_id]) for r in found if r.held_out and r.doc_id in known]
    good, bad = ([s for s, q in held if q == want] for want in (1, 0))
    assert np.mean([a > b for a in good for b in bad]) > 0.97
    assert np.mean([s >= 0.3 for s in good]) > 0.97 and np.mean([s < 0.3 for s in bad]) > 0.7
    for r in found:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        assert r.held_out == (r.doc_id is not None and crc(r.doc_id, 5) == 0)
    edges = {r.doc_id: r.score for r in found if r.doc_id is None or r.doc_id > 10000}
    assert edges[10001] == edges[10002]


def test_scores_are_those_of_the_rules(spark, docs, labels):
    """The compiled column against a walk of the rules, one text at a time."""
    model = quality.fit(docs, labels)
    assert len(model.rules) > 5
    rules = [(r.bounds, r.weight) for r in model.rules]
    texts = {r.doc_id: r.text for r in docs.collect()}
    found = {r.doc_id: r.score for r in quality.scored(docs, labels).collect()}
    for doc_id, text in texts.items():
        numbers = quality.statistics((text or "").encode())
        assert found[doc_id] == pytest.approx(rule_score(model.intercept, rules, numbers), abs=1e-9)


def test_statistics_of_a_text():
    text = "The cat | the CAT!\n\nThe cat | the CAT!\nA dog, 12 dogs."
    found = dict(zip(quality.STATISTICS, quality.statistics(text.encode()), strict=True))
    words = text.split()
    assert found["words"] == pytest.approx(np.log1p(len(words))) and found["pipes"] == 2 / len(words)
    assert found["distinct"] == len({w.lower() for w in words}) / len(words)
    assert found["commonest"] == 4 / len(words) and found["distinct_lines"] == 2 / 3
    assert found["digits"] == 2 / len(text) and found["lines"] == pytest.approx(np.log1p(3))
    assert found["function_words"] == 5 / len(words) and found["upper_words"] == 3 / len(words)


def test_held_out_labels_teach_nothing(spark, docs, labels):
    other = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (rows(quality.training_rows(docs, x).select("doc_id", "label")) for x in (labels, other))
    assert a == b and a


def test_quality_without_both_classes(spark, docs):
    schema = "doc_id long, quality int, toxic int"
    few = docs.limit(20)
    for data, expected in (([], 0.5), ([(1, 1, 0), (2, 1, 0), (3, None, 0), (None, 1, 1)], 1.0), ([(1, 0, 0)], 0.0)):
        scores = {round(r.score, 3) for r in quality.scored(few, spark.createDataFrame(data, schema)).collect()}
        assert scores == {expected}
    none = spark.createDataFrame([], ROWS)
    assert rows(quality.scored(none, spark.createDataFrame([], schema))) == []


def test_kept_rows_have_all_columns(spark, docs, labels):
    table = docs.selectExpr("*", "1 AS stats", "2 AS row")
    kept = quality.keep_good(table, labels)
    predicted = {r.doc_id for r in quality.scored(docs, labels).collect() if r.predicted}
    assert {r.doc_id for r in kept.collect()} == predicted and kept.columns == table.columns


def test_language_of_held_out_documents(spark, docs):
    found = language.predicted(docs.selectExpr("*", "1 AS score", "'x' AS lang_pred")).collect()
    known = {r.doc_id: r.lang for r in docs.collect()}
    held = [r.lang_pred == known[r.doc_id] for r in found if r.held_out]
    assert len(found) == docs.count() and len(held) > 100 and np.mean(held) > 0.98
    assert all(r.held_out == (crc(r.doc_id, 4) == 2) and 0 <= r.score <= 1 for r in found)
    # Languages of held-out documents teach nothing.
    other = docs.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit("zz")).otherwise(F.col("lang")))
    assert rows(language.predicted(other)) == rows(language.predicted(docs))


def test_decoding_bit_by_bit(spark, docs):
    model = language.fit(docs)
    found = {r.doc_id: (r.lang_pred, r.score) for r in language.predicted(docs).collect()}
    for r in docs.orderBy("doc_id").limit(60).collect():
        buckets = byte_grams(r.text, language._MULTIPLIERS, 14)
        assert sorted(buckets) == sorted(language.grams(r.text.encode()).tolist())
        name, share = decoded(model.languages, model.code, model.weights, model.trust, buckets)
        assert found[r.doc_id] == (name, pytest.approx(share, abs=1e-3))


def test_counts_of_n_grams(spark, docs):
    some = docs.orderBy("doc_id").limit(40).select("text", "lang")
    expected = Counter((r.lang, b) for r in some.collect() for b in byte_grams(r.text, language._MULTIPLIERS, 14))
    found = {(r.lang, r.bucket): r.n for r in language.gram_counts(some.repartition(3)).collect()}
    assert found == dict(expected)


def test_languages_of_odd_texts(spark, docs):
    edge = spark.createDataFrame(EDGES, "doc_id long, text string").selectExpr("doc_id", "text", "CAST(NULL AS STRING) AS lang")
    found = language.predicted(edge.union(docs.selectExpr("doc_id + 1000", "text", "lang"))).collect()
    odd = {r.doc_id: (r.lang_pred, r.score, r.held_out) for r in found if r.doc_id is None or r.doc_id < 10}
    assert all(odd[k][:2] == ("und", 0.0) for k in (1, 2, 3, 4, 5))
    assert odd[6][0] == odd[None][0] == "en" and odd[None][2] is False and odd[7][0] != "und"
    alone = edge.selectExpr("doc_id", "text", "IF(doc_id = 6, 'q', NULL) AS lang")
    assert {r.lang_pred for r in language.predicted(alone).collect()} <= {"und", "q"}
    assert {r.lang_pred for r in language.predicted(edge).collect()} == {"und"}
    assert rows(language.predicted(spark.createDataFrame([], ROWS))) == []


def test_codewords_are_apart():
    for n in (2, 3, 4, 5, 6, 20, 100):
        code = language.codewords(n)
        assert code.shape[0] == n and (np.abs(code.sum(0)) < n).all()
        apart = min(int((a != b).sum()) for k, a in enumerate(code) for b in code[:k])
        assert apart >= max(1, code.shape[1] // 4)


def test_pipeline(spark):
    """Each stage against a plain form of it, on what the stage before has kept."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept, columns = docs, docs.columns
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "lines", "near_dedup", "mixing", "packing"]
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in kept.collect()}
        size = kept.count()
        after = stage(spark, kept, FOLDER)
        found = after.collect()
        if name != "packing":
            assert after.columns == columns
        if name == "quality":
            scores = {r.doc_id: r.score for r in quality.scored(kept, spark.read.parquet(f"{FOLDER}/labels.parquet")).collect()}
            assert {r.doc_id for r in found} == {d for d, s in scores.items() if s >= 0.3}
        elif name == "lines":
            left = first_lines([(d, r.text) for d, r in before.items()])
            assert {r.doc_id: r.text for r in found} == {d: t for d, t in left.items() if t.strip() or not before[d].text.strip()}
        elif name == "near_dedup":
            roots = groups({d: word_set(r.text) for d, r in before.items()})
            assert {r.doc_id for r in found} == set(roots.values())
        elif name == "mixing":
            _, copies = taken([(r.doc_id, r.source, r.size, r.digits) for r in mixing.sized(kept).collect()])
            assert sorted(r.doc_id for r in found) == sorted(d for d, n in copies.items() for _ in range(n))
        else:
            assert len({(r.doc_id, r.sequence_id, r.offset) for r in found}) == len(found)
            whole = {}
            for r in found:
                whole[r.doc_id] = whole.get(r.doc_id, 0) + r.length
            assert set(whole) == set(before) and sum(r.start == 0 for r in found) == size
        path = spark.createDataFrame(found, after.schema) if found else after
        kept = path.repartition(3)


def test_the_pipeline_leaves_what_its_result_reads(spark):
    folder = Path(spark.conf.get("spark.checkpoint.dir"))
    before = {p.name for p in folder.iterdir()}
    result = corpus_pipeline.run(spark, FOLDER)
    left = [p.name.rpartition("-")[0] for p in folder.iterdir() if p.name not in before]
    assert left.count("mixing") == 1 and set(left) <= {"mixing", "sized", "parts", "packs"} and len(left) <= 3
    assert sorted((r.doc_id, r.length) for r in result.collect())


def test_the_pipeline_on_odd_rows(spark, tmp_path):
    text = "\n".join(f"line {n} of a text that is there more than once, with words of its own {n * n}." for n in range(12))
    data = [(1, text, "en", "a", 9)] * 30 + [(2, text + " more", "en", None, 9), (None, text, None, "b", None), (3, None, "en", "b", 0), (4, "", None, None, None), (5, "w " * 30_000, "de", "b", 1)]
    spark.createDataFrame(data, ROWS).selectExpr("*", "1 AS size", "2 AS row", "'x' AS digits").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, 1, 0), (1, 1, 0), (5, 1, 0), (None, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "size", "row", "digits"]
        docs = spark.createDataFrame(docs.collect(), docs.schema)
    left = sorted((r.doc_id or 0) for r in docs.collect())
    assert left == [0, 1, 3, 4, 5]
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in found} <= {None, 1, 3, 4, 5} and found


def test_pipeline_without_documents(spark, tmp_path):
    spark.createDataFrame([], ROWS).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert rows(corpus_pipeline.run(spark, str(tmp_path))) == []
    assert packing.LENGTH == 2048
