import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from gridledger.operators import kernels, scoring
from gridledger.operators.kernels import best_columns, unit_rows

SCHEMA = "key string, id long, label int, vector array<float>"


def unit(x):
    x = np.asarray(x, dtype=np.float32).astype(np.float64)
    n = np.linalg.norm(x, axis=-1, keepdims=True)
    return x / np.where(n == 0, 1, n)


def table(spark, data):
    return spark.createDataFrame([(k, i, c, [float(x) for x in v]) for k, i, c, v in data], SCHEMA).repartition(5)


def make(rng, sizes, classes=4, dim=6, copies=False, start=0):
    data = []
    for key, n in sizes.items():
        vectors = rng.normal(size=(n, dim)).astype(np.float32)
        if copies:  # a third of all items are one vector
            vectors[: n // 3] = vectors[0]
        data += [(key, start + i, int(rng.integers(classes)), vectors[i]) for i in range(n)]
    return data


def brute_matches(queries, candidates, k):
    found = {}
    for key, i, _, v in queries:
        side = [(c[1], c[2], c[3]) for c in candidates if c[0] == key]
        scored = [(-round(float(unit(v) @ unit(w)), 12), j, label) for j, label, w in side]
        found[key, i] = [(j, label) for _, j, label in sorted(scored)[:k]]
    return found


def spark_matches(df):
    return {(r.key, r.id): [(m.id, m.label) for m in r.matches] for r in df.collect()}


@pytest.mark.parametrize("copies", [False, True])
def test_matches_by_broadcast_and_by_blocks(spark, monkeypatch, copies):
    monkeypatch.setattr(scoring, "PACK_ROWS", 16)
    rng = np.random.default_rng(3)
    # One key holds most rows, one has fewer candidates than k, one has none.
    queries = make(rng, {"big": 90, "small": 7, "few": 5, "none": 3}, copies=copies)
    candidates = make(rng, {"big": 70, "small": 9, "few": 2, "unused": 4}, copies=copies, start=1000)
    expected = brute_matches(queries, candidates, 5)
    q, c = table(spark, queries), table(spark, candidates)
    assert spark_matches(scoring.nearest(q, c, 5, ["key"], blocked=False)) == expected
    blocked = spark_matches(scoring.nearest(q, c, 5, ["key"], blocked=True))
    assert blocked == expected


def test_blocks_without_keys(spark, monkeypatch):
    monkeypatch.setattr(scoring, "PACK_ROWS", 10)
    rng = np.random.default_rng(4)
    queries, candidates = make(rng, {"a": 40}), make(rng, {"a": 35}, start=100)
    q, c = table(spark, queries), table(spark, candidates)
    found = scoring.nearest(q, c, 3, blocked=True)
    assert {(r.id): [m.id for m in r.matches] for r in found.collect()} == {
        i: [j for j, _ in m] for (_, i), m in brute_matches(queries, candidates, 3).items()
    }


def test_small_side_needs_no_shuffle(spark):
    rng = np.random.default_rng(5)
    q, c = spark.createDataFrame([], SCHEMA), table(spark, make(rng, {"a": 5}))
    assert "Exchange" not in plan(scoring.nearest(q, c, 5, ["key"]))


def test_large_side_goes_by_blocks(spark, monkeypatch):
    monkeypatch.setattr(scoring, "BROADCAST_BYTES", 100)
    rng = np.random.default_rng(5)
    c = table(spark, make(rng, {"a": 5}))
    assert "_low" in plan(scoring.nearest(c, c, 5, ["key"]))


ODD = [
    ("a", 1, 0, [1.0, 0.0]), ("a", 1, 0, [1.0, 0.0]), ("a", 1, 0, [0.0, 1.0]), (None, 2, 0, [1.0, 0.0]), ("a", 3, 1, None),
    ("a", 4, 1, []), ("a", 5, 1, [1.0, None]), ("a", 6, 1, [float("nan"), 1.0]), ("a", 7, 1, [1.0, 2.0, 3.0]), ("a", 8, 2, [0.0, 0.0]),
    ("b", 9, None, [1.0, 1.0]), ("c", 10, 1, [1.0, 0.0]),
]


@pytest.mark.parametrize("size", [1, 3, 1000])
@pytest.mark.parametrize("k", [2, 40])
def test_odd_rows_have_the_same_matches_each_way(spark, monkeypatch, size, k):
    monkeypatch.setattr(scoring, "PACK_ROWS", size)
    df = spark.createDataFrame(ODD, SCHEMA).repartition(3)
    candidates = df.where("key <> 'c' OR key IS NULL")
    found = [
        sorted(
            ((r.key, r.id, r.label, [(m.id, m.label, m.score) for m in r.matches]) for r in scoring.nearest(df, candidates, k, ["key"], blocked).collect()),
            key=repr,
        )
        for blocked in (False, True)
    ]
    assert found[0] == found[1] and len(found[0]) == len(ODD)
    by_id = {}
    for _, i, _, matches in found[0]:
        by_id.setdefault(i, []).append(matches)
    assert by_id[2] == by_id[3] == by_id[4] == by_id[5] == by_id[6] == by_id[10] == [[]]
    assert by_id[7] == [[(7, 1, 1.0)]] and by_id[9] == [[(9, None, 1.0)]]
    assert sorted(m[0][2] for m in by_id[1]) == [1.0, 1.0, 1.0] and by_id[8][0][0][:1] == (1,)


def test_what_is_shuffled_grows_with_the_packs(spark, monkeypatch):
    monkeypatch.setattr(scoring, "PACK_ROWS", 64)
    c = table(spark, make(np.random.default_rng(1), {"a": 640}))
    packs = scoring._packs(c, ["key"], "given")
    assert packs.count() <= 10 + 5  # full ones, and one for each partition
    assert sum(r.n for r in packs.groupBy("key").count().withColumnRenamed("count", "n").collect()) == packs.count()


def test_places_grow_with_the_packs(spark, monkeypatch):
    monkeypatch.setattr(scoring, "PACK_ROWS", 8)
    monkeypatch.setattr(scoring, "CELL_BYTES", 50 * (6 * 8 + 16))  # fifty candidates in a task
    rng, sent = np.random.default_rng(2), []
    for n in (400, 800):
        q, c = (table(spark, make(rng, {"a": n}, start=start)).repartition(4) for start in (0, 1000))
        grid = scoring._grid(q, c, [])
        low, high = grid.first()
        assert high == n // 50 and low >= 1 and low * high >= 8
        left, right = scoring._packs(q, [], "pack"), scoring._packs(c, [], "pack")
        rows = scoring._on_grid(left, grid, [], "low", "high", 1).union(scoring._on_grid(right, grid, [], "high", "low", 0))
        cells = rows.groupBy("_low", "_high", "_side").count().collect()
        sent.append(sum(r["count"] for r in cells))
        assert sent[-1] == left.count() * high + right.count() * low
        assert max(r["count"] for r in cells if r["_side"] == 0) < right.count() / 2  # no task has all candidates
        found = scoring.nearest(q, c, 3, blocked=True)
        whole = scoring.nearest(q, c, 3, blocked=False)
        best = [{r.id: [(m.id, m.score) for m in r.matches] for r in df.collect()} for df in (found, whole)]
        assert best[0] == best[1]
    # Twice the packs along twice the side: what travels is bounded by their product.
    assert sent[1] <= 4 * sent[0] * 1.3


def test_a_grid_without_parts_is_not_merged(spark, monkeypatch):
    c = table(spark, make(np.random.default_rng(5), {"a": 50}))
    text = plan(scoring.nearest(c, c, 5, ["key"], blocked=True))
    assert "Aggregate" not in text.split("_low")[0]


def test_scores_in_memory_are_few_whatever_the_candidates():
    rng, peaks = np.random.default_rng(3), []
    for n in (2_000, 8_000):
        rows = pa.table({"id": np.arange(n), "label": np.zeros(n, np.int64), "vector": list(rng.normal(size=(n, 8)))})
        side, shape = kernels.search_side(rows), pa.schema([("row", pa.int64()), ("score", pa.float64()), ("id", pa.int64()), ("label", pa.int64())])
        tracemalloc.start()
        kernels.best_matches(rows["vector"].slice(0, 2_000).combine_chunks(), side, 5, shape)
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert max(peaks) < 48 << 20


def test_numbers_of_many_partitions(spark, monkeypatch):
    """A pack of partition 10^6 has a place of its own."""

    class Far:
        @staticmethod
        def get():
            return Far()

        @staticmethod
        def partitionId():
            return 10**6

    monkeypatch.setattr(scoring, "TaskContext", Far)
    q = table(spark, make(np.random.default_rng(5), {"a": 30})).coalesce(1)
    c = table(spark, make(np.random.default_rng(6), {"a": 30}, start=100)).coalesce(1)
    found = scoring.nearest(q, c, 3, ["key"], blocked=True).collect()
    assert len(found) == 30 and all(len(r.matches) == 3 for r in found)


def test_scores_below_the_bound_are_left_out():
    rows = pa.table({"id": [1, 2, 3], "label": [0, 0, 0], "vector": [[1.0, 0.0], [0.0, 1.0], [1.0, 1.0]]})
    schema = pa.schema([("row", pa.int64()), ("score", pa.float64()), ("id", pa.int64()), ("label", pa.int64())])
    vectors = pa.array([[1.0, 0.0], [0.0, 1.0]])
    found = kernels.best_matches(vectors, kernels.search_side(rows), 1, schema)
    assert kernels.least_of(found, 1, 3).tolist() == [1.0, 1.0, -np.inf]
    other = kernels.search_side(pa.table({"id": [9], "label": [0], "vector": [[1.0, 0.0]]}))
    again = kernels.best_matches(vectors, other, 1, schema, kernels.least_of(found, 1, 2))
    assert again["row"].to_pylist() == [0]  # equal scores go on: the smaller id decides


def test_one_product_gives_hits_and_precision(spark, monkeypatch):
    rng = np.random.default_rng(12)
    items = make(rng, {"big": 150, "small": 12, "alone": 4}, classes=6, copies=True)
    protos = [(key, label, label, rng.normal(size=6)) for key in ("big", "small", "unused") for label in range(5)]
    data = table(spark, items).union(spark.createDataFrame(ODD, SCHEMA))
    classes = table(spark, protos).union(spark.createDataFrame([("big", 0, None, [1.0] * 6), ("a", 0, 1, [1.0, 2.0])], SCHEMA))
    keys, k = ["key"], 2
    for few in (True, False):
        monkeypatch.setattr(scoring, "BROADCAST_ROWS", 1000 if few else 3)
        hits, precision = scoring.scored_once(data, classes.drop("id"), keys, k)
        monkeypatch.setattr(scoring, "BROADCAST_ROWS", 1000)
        expected = scoring.class_hits(scoring.nearest(data, classes.withColumn("id", F.col("label")), k, keys), keys, k)
        assert rows(hits) == rows(expected)
        expected = scoring.class_average_precision(data, classes.drop("id"), keys)
        found = {(r.key, r.label): r.average_precision for r in precision.collect()}
        assert found == pytest.approx({(r.key, r.label): r.average_precision for r in expected.collect()}, abs=1e-12)


def test_items_are_multiplied_once(spark, monkeypatch):
    items = table(spark, make(np.random.default_rng(3), {"a": 200}))
    protos = table(spark, [("a", n, n, np.eye(6)[n]) for n in range(4)])
    made = spark.sparkContext.accumulator(0)

    def counted(items, classes, real=scoring.products):
        made.add(len(items) * len(classes))
        return real(items, classes)

    monkeypatch.setattr(scoring, "products", counted)
    hits, precision = scoring.scored_once(items, protos.drop("id"), ["key"])
    assert hits.count() == 4 and precision.count() == 4 and made.value == 200 * 4


def test_ranges_of_scores_are_even(spark):
    """Vectors of a narrow band: no range has many more rows than the others."""
    rng = np.random.default_rng(3)
    centre = rng.normal(size=6) * 20
    data = [("a", n, int(rng.integers(3)), centre + rng.normal(size=6)) for n in range(20_000)]
    items, protos = table(spark, data), table(spark, [("a", n, n, centre + rng.normal(size=6)) for n in range(3)])
    rated = scoring._rated(items.drop("id"), protos.drop("id"), ["key"])
    sample = scoring._rated(items.drop("id").where(F.pmod(F.hash("vector"), F.lit(scoring.SAMPLED)) == 0), protos.drop("id"), ["key"])
    sizes = scoring._in_ranges(rated, scoring._score_bounds(sample, ["key"]), ["key"]).groupBy("label", "range").count().collect()
    counts = sorted(r["count"] for r in sizes)
    assert len(counts) > 3 * scoring.SCORE_RANGES * 0.9 and counts[-1] <= 4 * counts[len(counts) // 2]


def brute_ap(items, protos, key):
    out = {}
    for pk, _, label, p in protos:
        if pk != key:
            continue
        scored = [(round(float(unit(v) @ unit(p)), 12), c == label) for k, _, c, v in items if k == key]
        own = [s for s, mine in scored if mine]
        if own:
            out[label] = float(np.mean([sum(m for t, m in scored if t >= s) / sum(t >= s for t, _ in scored) for s in own]))
    return out


@pytest.mark.parametrize("copies", [False, True])
def test_average_precision(spark, monkeypatch, copies):
    monkeypatch.setattr(scoring, "PACK_ROWS", 16)
    monkeypatch.setattr(scoring, "BROADCAST_ROWS", 3 if copies else 1000)
    rng = np.random.default_rng(6)
    items = make(rng, {"big": 110, "small": 12}, classes=5, copies=copies)
    protos = [(key, 0, label, rng.normal(size=6)) for key in ("big", "small") for label in range(4)]  # none for class 4
    ap = scoring.class_average_precision(table(spark, items), table(spark, protos).drop("id"), ["key"])
    found = {(r.key, r.label): r.average_precision for r in ap.collect()}
    expected = {(k, c): v for k in ("big", "small") for c, v in brute_ap(items, protos, k).items()}
    assert found == pytest.approx(expected, abs=1e-12)
    mean = scoring.mean_average_precision(table(spark, items), table(spark, protos).drop("id"), ["key"])
    for r in mean.collect():
        own = [v for (k, _), v in expected.items() if k == r.key]
        assert (r.classes, r.mean_average_precision) == (len(own), pytest.approx(np.mean(own)))


def test_rows_of_average_precision_grow_with_the_items(spark, monkeypatch):
    monkeypatch.setattr(scoring, "PACK_ROWS", 32)
    rng = np.random.default_rng(9)
    protos = table(spark, [("a", 0, label, rng.normal(size=6)) for label in range(4)])
    rated = []
    for n in (200, 400):
        items = table(spark, make(rng, {"a": n}))
        real = scoring.score_counts
        counted = spark.sparkContext.accumulator(0)

        def count(asked, given, names, real=real, counted=counted):
            found = real(asked, given, names)
            counted.add(len(found))
            return found

        monkeypatch.setattr(scoring, "score_counts", count)
        assert scoring.class_average_precision(items, protos, ["key"]).count() == 4
        monkeypatch.setattr(scoring, "score_counts", real)
        rated.append(counted.value)
    # At most twice, if no exchange is used again, and once more for the sample of the bounds.
    assert rated[0] <= 2.25 * 200 * 4 and rated[1] <= 2.25 * rated[0]


def test_odd_rows_of_average_precision(spark):
    protos = spark.createDataFrame([("a", 0, 0, [1.0, 0.0]), ("a", 0, 1, None), ("a", 0, 2, [1.0, 1.0, 1.0])], SCHEMA)
    found = scoring.class_average_precision(spark.createDataFrame(ODD, SCHEMA), protos, ["key"])
    # Scores 1, 1 and 0 of its own items, and 0 of a zero vector; no other class has an item it can rank.
    assert rows(found) == [("a", 0, pytest.approx((1 + 1 + 3 / 4) / 3))]
    assert rows(scoring.class_average_precision(spark.createDataFrame([], SCHEMA), protos, ["key"])) == []


def test_accuracy_and_recall(spark):
    match = "array<struct<id:long,label:int,score:double>>"
    data = [(1, 0, [(0, 0, 0.9), (1, 1, 0.8)]), (2, 0, [(1, 1, 0.9), (0, 0, 0.8)]), (3, 1, [(1, 1, 0.9), (0, 0, 0.1)]), (4, 2, [])]
    df = spark.createDataFrame(data, f"id long, label int, matches {match}")
    hits = scoring.class_hits(df)
    assert rows(scoring.accuracy(hits)) == [(4, 0.5, 0.75)]
    assert rows(scoring.mean_per_class_recall(hits)) == [(3, 0.5)]
    assert rows(scoring.recall_at_k(df)) == [(4, 0.75)]


def test_evaluate_by_key_equals_one_key_at_a_time(spark):
    rng = np.random.default_rng(8)
    items = make(rng, {"a": 30, "b": 25})
    protos = [(key, 0, label, rng.normal(size=6)) for key in ("a", "b") for label in range(4)]

    def documents(wanted):
        i = table(spark, [r for r in items if r[0] in wanted])
        p = table(spark, [r for r in protos if r[0] in wanted]).drop("id")
        images, texts = i.where("id % 2 = 0"), i.where("id % 2 = 1")
        return rows(scoring.evaluate(i, p, images, texts, ["key"]))

    both = documents("ab")
    assert both == sorted(documents("a") + documents("b"), key=repr) and len(both) == 4


def test_zero_vector_scores_zero():
    assert unit_rows(pa.array([[0.0, 0.0], [3.0, 4.0]])).tolist() == [[0.0, 0.0], [0.6, 0.8]]


def test_best_columns_takes_ties_by_column():
    scores = np.array([[1.0, 3.0, 3.0, 3.0, 2.0], [0.0, 0.0, 0.0, 0.0, 0.0]])
    assert best_columns(scores, 2).tolist() == [[1, 2], [0, 1]]
    assert best_columns(scores, 9).tolist() == [[1, 2, 3, 4, 0], [0, 1, 2, 3, 4]]


def test_best_columns_of_many():
    scores = np.random.default_rng(1).integers(0, 9, size=(40, 60)).astype(float)
    brute = [sorted(range(60), key=lambda c: (-row[c], c)) for row in scores]
    for k in (1, 5, 33, 60, 70):
        assert best_columns(scores, k).tolist() == [b[:k] for b in brute]
