"""Evaluation metrics from tables of embeddings.

Items, queries, candidates and classes have the columns of ``keys`` (one evaluation each, such
as model, weights and benchmark), then id, label and vector; classes need no id. Scores are
cosines; of equal scores the smaller id comes first.
"""

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridledger.operators.kernels import (
    best_matches,
    best_of,
    hit_counts,
    least_of,
    match_lists,
    packed,
    products,
    score_counts,
    search_side,
    split_by_key,
    unpacked,
)
from gridledger.runtime import row_bound, shared_folder
from gridledger.schemas import CLASSIFICATION, RETRIEVAL

# Largest set of vectors that is sent whole to every executor.
BROADCAST_BYTES = 64 << 20
BROADCAST_ROWS = 100_000
# Vectors that travel as one row, rows that a task holds while it packs them, and places that the
# packs of one key are dealt to where items are scored for all classes.
PACK_ROWS = 4_096
HELD_ROWS = 65_536
SPREAD = 16
# Bytes of candidates that a task of a search holds, and tasks for each core that a search is cut into.
CELL_BYTES = 64 << 20
TASKS_PER_CORE = 3
# Scores that a task holds at once.
CELLS = 1 << 22
# Ranges of scores that a class's items are dealt to, the part of the items whose scores bound them,
# and classes whose bounds are sent whole to every executor.
SCORE_RANGES = 128
SAMPLED = 16
BOUNDS_ROWS = 20_000


def _fits_in_broadcast(candidates: DataFrame) -> bool:
    """True if the candidates are few and small; looks at so many rows at most."""
    names = [F.col(c).cast("string") for c in ("id", "label") if c in candidates.columns]
    text = F.octet_length(F.concat_ws("", *names))
    size = F.coalesce(F.size("vector"), F.lit(0)) * 8 + text
    seen = candidates.limit(BROADCAST_ROWS + 1).agg(F.count("*").alias("rows"), F.sum(size).alias("size")).first()
    return seen["rows"] <= BROADCAST_ROWS and (seen["size"] or 0) <= BROADCAST_BYTES


def _match_type(candidates: DataFrame) -> T.StructType:
    return T.StructType([candidates.schema["id"], candidates.schema["label"], T.StructField("score", T.DoubleType())])


def _arrow_matches(candidates: DataFrame) -> pa.Schema:
    """Of rows (row, score, id, label)."""
    empty = candidates.select("id", "label").limit(0).toArrow().schema
    return pa.schema([("row", pa.int64()), ("score", pa.float64()), ("id", empty.field("id").type), ("label", empty.field("label").type)])


def nearest(queries: DataFrame, candidates: DataFrame, k: int = 5, keys=(), blocked=None) -> DataFrame:
    """Each query with ``matches``: its k best candidates of the same key, best first.

    Exact. A small candidate side goes to the queries, which then need no shuffle. A larger one
    meets them in packs of many vectors. Both ways give the same rows: one for each row of
    ``queries``, repeated ones too; a row with a null key has no matches, and so has one whose vector
    is null, empty, or holds a null, NaN or infinity. Such candidates match nothing, and vectors of
    different lengths don't match. Candidate ids are not null.
    """
    keys = list(keys)
    columns = [*keys, "id", "label", "vector"]
    queries, candidates = queries.select(columns), candidates.select(columns).dropna(subset=["id", *keys])
    if blocked is None:
        blocked = not _fits_in_broadcast(candidates)
    fields = [queries.schema[c] for c in [*keys, "id", "label"]]
    schema = T.StructType([*fields, T.StructField("matches", T.ArrayType(_match_type(candidates)))])
    if blocked:
        return _nearest_by_packs(queries, candidates, k, keys, schema)

    shape = _arrow_matches(candidates)
    sides = {key: search_side(part) for key, part in split_by_key(candidates.toArrow(), keys)}
    shared = queries.sparkSession.sparkContext.broadcast(sides)

    def search(batches):
        for batch in batches:
            for key, part in split_by_key(pa.Table.from_batches([batch]), keys):
                found = best_matches(part["vector"].combine_chunks(), shared.value.get(key, {}), k, shape)
                found = best_of(found, k)
                matches = match_lists(found, len(part))
                yield from part.drop_columns(["vector"]).append_column("matches", matches).to_batches()

    return queries.mapInArrow(search, schema)


def _packs(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Rows (keys, task, number, ``name``): up to PACK_ROWS rows of one key, packed where they are."""

    def pack(batches):
        held: dict = {}
        task, number = TaskContext.get().partitionId(), 0

        def flush(key):
            nonlocal number
            table = pa.concat_tables(held.pop(key))
            number += 1
            columns = [table[c].combine_chunks().slice(0, 1) for c in keys]
            numbers = [pa.array([x], pa.int64()) for x in (task, number)]
            values = [*columns, *numbers, pa.array([packed(table)], pa.binary())]
            return pa.RecordBatch.from_arrays(values, [*keys, "_task", "_number", name])

        for batch in batches:
            for start in range(0, batch.num_rows, PACK_ROWS):
                part = pa.Table.from_batches([batch.slice(start, PACK_ROWS)])
                for key, rows in split_by_key(part, keys):
                    key = repr(key)  # so that nulls are equal
                    held.setdefault(key, []).append(rows)
                    if sum(map(len, held[key])) >= PACK_ROWS:
                        yield flush(key)
            while sum(len(t) for tables in held.values() for t in tables) > HELD_ROWS:
                yield flush(max(held, key=lambda key: sum(map(len, held[key]))))
        for key in list(held):
            yield flush(key)

    fields = [df.schema[c] for c in keys]
    fields += [T.StructField(c, T.LongType()) for c in ("_task", "_number")] + [T.StructField(name, T.BinaryType())]
    return df.mapInArrow(pack, T.StructType(fields))


def _bytes(df: DataFrame, keys: list[str], rows: str, size: str) -> DataFrame:
    vectors = F.sum(F.coalesce(F.size("vector"), F.lit(0)).cast("long") * 8 + 16)
    return df.groupBy(*keys).agg(F.count("*").alias(rows), F.coalesce(vectors, F.lit(0)).alias(size))


def _grid(queries: DataFrame, candidates: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, low, high): how many parts the queries and the candidates of each key are dealt to.

    Every part of the one side meets every part of the other, in a task of its own. A part of the
    candidates is what a task may hold; beyond that, there are about as many tasks as the cores need,
    divided among the keys by their products, and among the two sides of a key so that the packs that
    travel are few: those of the queries times the parts of the candidates, and the other way round.
    """
    spark = queries.sparkSession
    sizes = _bytes(queries, keys, "_asked", "_asked_bytes")
    given = _bytes(candidates, keys, "_given", "_given_bytes")
    if keys:
        other = given.withColumnsRenamed({c: f"_{c}" for c in keys})
        same = [F.col(c) == F.col(f"_{c}") for c in keys]
        sizes = sizes.join(other, same, "left").drop(*other.columns[: len(keys)])
        every = Window.partitionBy(F.lit(0))
    else:
        sizes = spark.createDataFrame([tuple(sizes.first()) + tuple(given.first())], "_asked long, _asked_bytes long, _given long, _given_bytes long")
        every = Window.partitionBy(F.lit(0))
    work = F.coalesce(F.col("_asked").cast("double") * F.col("_given"), F.lit(0.0))
    tasks = F.greatest(F.lit(spark.sparkContext.defaultParallelism * TASKS_PER_CORE) * work / F.greatest(F.sum(work).over(every), F.lit(1.0)), F.lit(1.0))
    held = F.ceil(F.col("_given_bytes") / CELL_BYTES)
    even = F.ceil(F.sqrt(tasks * F.col("_given") / F.greatest("_asked", F.lit(1))))
    high = F.least(F.greatest(held, even), F.ceil(F.col("_given") / PACK_ROWS))
    high = F.greatest(F.coalesce(high, F.lit(1)), F.lit(1)).cast("int")
    low = F.least(F.ceil(tasks / high), F.ceil(F.col("_asked") / PACK_ROWS))
    low = F.greatest(F.coalesce(low, F.lit(1)), F.lit(1)).cast("int")
    return sizes.select(*keys, low.alias("low"), high.alias("high"))


def _on_grid(packs: DataFrame, grid: DataFrame, keys: list[str], own: str, other: str, side: int) -> DataFrame:
    """The packs, each at one place along its own side of the grid and at all along the other."""
    if keys:
        grid = grid.withColumnsRenamed({c: f"_{c}" for c in keys})
        packs = packs.join(grid, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in keys])
    else:
        row = grid.first()
        packs = packs.withColumns({c: F.lit(row[c]) for c in ("low", "high")})
    places = {
        f"_{own}": F.pmod(F.xxhash64("_task", "_number"), F.col(own)).cast("int"),
        f"_{other}": F.explode(F.sequence(F.lit(0), F.col(other) - 1)),
        "_side": F.lit(side),
    }
    for name, place in places.items():
        packs = packs.withColumn(name, place)
    return packs.select(*keys, "_low", "_high", "_side", "_task", "_number", "pack")


def _nearest_by_packs(queries, candidates, k, keys, schema) -> DataFrame:
    """Every pack of queries meets every pack of candidates of its key, on a grid of tasks.

    A task holds its part of the candidates, bounded in bytes, and takes the packs of its queries one
    by one; what a query has found is the bound that the next candidates have to pass. The best matches
    of a pack are merged once more only if candidates are in several parts.
    """
    shape = _arrow_matches(candidates)
    if keys:
        folder = shared_folder(queries.sparkSession, "grid")
        _grid(queries, candidates, keys).write.parquet(folder)
        grid = queries.sparkSession.read.parquet(folder)
    else:
        grid = _grid(queries, candidates, keys).persist()
    left = _on_grid(_packs(queries, keys, "pack"), grid, keys, "low", "high", 1)
    right = _on_grid(_packs(candidates, keys, "pack"), grid, keys, "high", "low", 0)
    cell = [*keys, "_low", "_high"]
    met = left.union(right).repartition(*cell).sortWithinPartitions(*cell, "_side", "_task", "_number")

    def search(batches):
        here, sides = None, []
        for batch in batches:
            places = list(zip(*(batch[c].to_pylist() for c in cell), strict=True))
            for n, (place, side) in enumerate(zip(places, batch["_side"].to_pylist(), strict=True)):
                if place != here:
                    here, sides = place, []
                table = unpacked(batch["pack"][n].as_py())
                if not side:
                    sides.append(search_side(table))
                    continue
                vectors, found = table["vector"].combine_chunks(), shape.empty_table()
                for candidates in sides:
                    new = best_matches(vectors, candidates, k, shape, least_of(found, k, len(table)))
                    found = best_of(pa.concat_tables([found, new]), k) if len(new) else found
                rows = table.drop_columns(["vector"]).append_column("matches", match_lists(found, len(table)))
                numbers = [np.full(len(table), batch[c][n].as_py()) for c in ("_task", "_number")]
                for name, values in zip(("_task", "_number", "_row"), (*numbers, np.arange(len(table))), strict=True):
                    rows = rows.append_column(name, pa.array(values, pa.int64()))
                yield from rows.combine_chunks().to_batches()

    own = ["_task", "_number", "_row"]
    partial = met.mapInArrow(search, T.StructType([*schema.fields, *(T.StructField(c, T.LongType()) for c in own)]))
    if grid.agg(F.max("high")).first()[0] in (None, 1):
        return partial.drop(*own)
    query = [*keys, "id", "label", *own]
    order = F.transform("matches", lambda m: F.struct((-m.score).alias("score"), m.id.alias("id"), m.label.alias("label")))
    merged = partial.groupBy(*query).agg(F.flatten(F.collect_list(order)).alias("all"))
    best = F.transform(
        F.slice(F.array_sort("all"), 1, k),
        lambda m: F.struct(m.id.alias("id"), m.label.alias("label"), (-m.score).alias("score")),
    )
    return merged.select(*[c for c in query if c not in own], best.alias("matches"))


def _hit(k: int | None = None):
    labels = F.col("matches.label")
    if k is not None:
        labels = F.slice(labels, 1, k)
    return F.coalesce(F.array_contains(labels, F.col("label")), F.lit(False))


def class_hits(matches: DataFrame, keys=(), k: int = 5) -> DataFrame:
    """Items of each class, and how many find it as the best match and among the k best."""
    return matches.groupBy(*keys, "label").agg(
        F.count("*").alias("items"),
        F.count_if(_hit(1)).alias("top1_hits"),
        F.count_if(_hit(k)).alias(f"top{k}_hits"),
    )


def accuracy(hits: DataFrame, keys=(), k: int = 5) -> DataFrame:
    """Share of items whose class is the best match, and among the k best; from `class_hits`."""
    return hits.groupBy(*keys).agg(
        F.sum("items").alias("items"),
        (F.sum("top1_hits") / F.sum("items")).alias("acc1"),
        (F.sum(f"top{k}_hits") / F.sum("items")).alias(f"acc{k}"),
    )


def mean_per_class_recall(hits: DataFrame, keys=()) -> DataFrame:
    """Share of a class's items with it as best match, averaged over classes; from `class_hits`."""
    return hits.groupBy(*keys).agg(
        F.count("*").alias("classes"),
        F.avg(F.col("top1_hits") / F.col("items")).alias("mean_per_class_recall"),
    )


def recall_at_k(matches: DataFrame, keys=(), k: int = 5) -> DataFrame:
    """Share of queries with a candidate of their label among the k best."""
    return matches.groupBy(*keys).agg(
        F.count("*").alias("queries"), F.avg(_hit(k).cast("int")).alias(f"recall_at_{k}")
    )


def _score_bounds(rated: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, label, bounds): for each class, scores that cut its rows in ranges of about as many rows.

    Scores lie close together, so that ranges of equal width would not be equal. What the ranges are
    decides on the tasks only, not on the result.
    """
    cuts = F.array(*(F.lit(n / SCORE_RANGES) for n in range(1, SCORE_RANGES)))
    cuts = F.percentile_approx("score", cuts, F.lit(4 * SCORE_RANGES))
    return rated.groupBy(*keys, "label").agg(F.array_distinct(cuts).alias("bounds"))


def _pairs(items: DataFrame, classes: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Packs of items (``asked``) with packs of classes (``given``) of their key."""
    small = _fits_in_broadcast(classes)
    spread = 1 if small else SPREAD
    place = F.pmod(F.xxhash64("_task", "_number"), F.lit(spread)).cast("int")
    left = _packs(items, keys, "asked").withColumn("_place", place)
    right = _packs(classes, keys, "given").withColumn("_place", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))))
    right = right.drop("_task", "_number")
    return left.join(F.broadcast(right) if small else right, [*keys, "_place"], how).select("asked", "given")


def _rated(items: DataFrame, classes: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, label, score, items, positives) for each pack of items and class."""
    names = [*keys, "label", "score", "items", "positives"]

    def rate(batches):
        for batch in batches:
            for asked, given in zip(batch["asked"].to_pylist(), batch["given"].to_pylist()):
                yield from score_counts(unpacked(asked), unpacked(given), names).to_batches()

    fields = [classes.schema[c] for c in [*keys, "label"]]
    return _pairs(items, classes, keys).mapInArrow(rate, T.StructType([*fields, *_COUNTS]))


_COUNTS = [T.StructField("score", T.DoubleType()), *(T.StructField(c, T.LongType()) for c in ("items", "positives"))]


def _in_ranges(rated: DataFrame, bounds: DataFrame, keys: list[str]) -> DataFrame:
    """The counts of each class and score with the range that the score is in, from the highest down."""
    by = [*keys, "label"]
    bounds = bounds.withColumnsRenamed({c: f"_{c}" for c in by})
    bounds = F.broadcast(bounds) if row_bound(bounds, BOUNDS_ROWS) else bounds
    rated = rated.join(bounds, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by], "left")
    above = F.coalesce(F.size(F.filter("bounds", lambda bound: bound > F.col("score"))), F.lit(0))
    return rated.select(*by, above.alias("range"), "score", "items", "positives")


def _precision(rated: DataFrame, bounds: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, label, average_precision) of the counts of each class and score."""
    by, part = [*keys, "label"], [*keys, "label", "range"]
    rated = _in_ranges(rated, bounds, keys).repartition(*part)
    sums = rated.groupBy(*part).agg(F.sum("items").alias("items"), F.sum("positives").alias("positives"))
    higher = Window.partitionBy(*by).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    above = sums.where(F.col("items") > 0).select(
        *[F.col(c).alias(f"_{c}") for c in part],
        F.coalesce(F.sum("items").over(higher), F.lit(0)).alias("items_higher"),
        F.coalesce(F.sum("positives").over(higher), F.lit(0)).alias("positives_higher"),
    )
    upto = Window.partitionBy(*part).orderBy(F.desc("score")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    reached = rated.select(
        *part,
        "positives",
        F.sum("items").over(upto).alias("items_here"),
        F.sum("positives").over(upto).alias("positives_here"),
    ).where(F.col("positives") > 0)
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in part]
    together = reached.join(above, same)
    precision = (F.col("positives_here") + F.col("positives_higher")) / (F.col("items_here") + F.col("items_higher"))
    return together.groupBy(*by).agg(
        (F.sum(F.col("positives") * precision) / F.sum("positives")).alias("average_precision")
    )


def class_average_precision(items: DataFrame, classes: DataFrame, keys=()) -> DataFrame:
    """Average precision of ranking all items by their score for each class.

    Every item is scored for every class, which gives a row for each class and score of a pack of
    items. These rows are dealt out by class and range of scores, whose bounds come from a sample; the
    ranges' sums give each the counts of those above it, and running sums inside the ranges do the rest.
    So the rows grow with items times classes, and no class is one task's work. Equal scores share one
    threshold.

    Items whose vector can't be compared with a class (see `nearest`) are not ranked for it, nor are
    items with a null key. Items of a class without a prototype compete with others.
    """
    keys = list(keys)
    by = [*keys, "label"]
    items, classes = items.select(*by, "vector"), classes.select(*by, "vector")
    if keys:
        items, classes = items.dropna(subset=keys), classes.dropna(subset=keys)
    sample = items.where(F.pmod(F.hash("vector"), F.lit(SAMPLED)) == 0)
    return _precision(_rated(items, classes, keys), _score_bounds(_rated(sample, classes, keys), keys), keys)


def scored_once(items: DataFrame, classes: DataFrame, keys=(), k: int = 5) -> tuple[DataFrame, DataFrame]:
    """`class_hits` of the items' nearest classes, and `class_average_precision`, of one product.

    For classes that are few enough to go to every pack of items whole: a task takes the product of the
    pack and all classes of its key, and leaves the hits of the pack and its counts of scores. Both are
    kept as one table, and split behind it. Beyond that, the two are computed one after the other.
    """
    keys = list(keys)
    by = [*keys, "label"]
    items, classes = items.select(*by, "vector"), classes.select(*by, "vector")
    ranked = classes.dropna(subset=keys) if keys else classes
    if not _fits_in_broadcast(ranked):
        prototypes = classes.withColumn("id", F.col("label"))
        hits = class_hits(nearest(items.withColumn("id", F.lit(0)), prototypes, k, keys), keys, k)
        return hits, class_average_precision(items, classes, keys)
    names = [*by, "score", "items", "positives"]
    whole = split_by_key(ranked.toArrow(), keys)
    whole = {key: table.sort_by("label") for key, table in whole}
    step = max(1, min(PACK_ROWS, CELLS // max(map(len, whole.values()), default=1)))
    shared = items.sparkSession.sparkContext.broadcast(whole)
    fields = [T.StructField("kind", T.IntegerType()), *(items.schema[c] for c in by), *_COUNTS]
    fields += [T.StructField(c, T.LongType()) for c in ("first", "among")]

    def score(batches):
        def rows(table, kind):
            for field in fields[1:]:
                if field.name not in table.column_names:
                    nothing = pa.float64() if field.name == "score" else pa.int64()
                    table = table.append_column(field.name, pa.nulls(len(table), nothing))
            table = table.append_column("kind", pa.array(np.full(len(table), kind, np.int32)))
            return table.select([field.name for field in fields]).combine_chunks().to_batches()

        for batch in batches:
            for start in range(0, batch.num_rows, step):
                for key, part in split_by_key(pa.Table.from_batches([batch.slice(start, step)]), keys):
                    own = shared.value.get(key)
                    scored = list(products(part, own)) if own is not None else []
                    yield from rows(hit_counts(part, own, k, keys, scored), 0)
                    if own is not None:
                        yield from rows(score_counts(part, own, names, scored), 1)

    folder = shared_folder(items.sparkSession, "scored")
    items.mapInArrow(score, T.StructType(fields)).write.parquet(folder)
    both = items.sparkSession.read.schema(T.StructType(fields)).parquet(folder)
    hits = both.where("kind = 0").groupBy(*by).agg(
        F.sum("items").alias("items"), F.sum("first").alias("top1_hits"), F.sum("among").alias(f"top{k}_hits")
    )
    rated = both.where("kind = 1").select(names)
    return hits, _precision(rated, _score_bounds(rated, keys), keys)


def mean_average_precision(items: DataFrame, classes: DataFrame, keys=()) -> DataFrame:
    return _mean(class_average_precision(items, classes, keys), keys)


def _mean(precision: DataFrame, keys) -> DataFrame:
    return precision.groupBy(*keys).agg(
        F.count("*").alias("classes"), F.avg("average_precision").alias("mean_average_precision")
    )


def evaluate(items: DataFrame, classes: DataFrame, images: DataFrame, texts: DataFrame, keys) -> DataFrame:
    """Result documents of every evaluation: columns of ``keys``, task_type, metrics, doc."""
    keys = list(keys)
    hits, precision = scored_once(items, classes, keys)
    classified = hits.groupBy(*keys).agg(
        (F.sum("top1_hits") / F.sum("items")).alias("acc1"),
        (F.sum("top5_hits") / F.sum("items")).alias("acc5"),
        F.avg(F.col("top1_hits") / F.col("items")).alias("mean_per_class_recall"),
    )
    of_images = recall_at_k(nearest(texts, images, 5, keys), keys)
    of_texts = recall_at_k(nearest(images, texts, 5, keys), keys)
    retrieved = (
        of_images.select(*keys, F.col("recall_at_5").alias("image_retrieval_recall@5"))
        .join(of_texts.select(*keys, F.col("recall_at_5").alias("text_retrieval_recall@5")), keys, "full")
        .join(_mean(precision, keys), keys, "full")
    )
    return _documents(
        classified, keys, CLASSIFICATION, ["acc1", "acc5", "mean_per_class_recall"]
    ).union(
        _documents(
            retrieved,
            keys,
            RETRIEVAL,
            ["image_retrieval_recall@5", "text_retrieval_recall@5", "mean_average_precision"],
        )
    )


def _documents(scores: DataFrame, keys: list[str], task_type: str, metrics: list[str]) -> DataFrame:
    document = F.struct(F.struct(*[F.col(f"`{m}`") for m in metrics]).alias("metrics"))
    return scores.select(*keys, F.lit(task_type).alias("task_type"), F.to_json(document).alias("doc"))
