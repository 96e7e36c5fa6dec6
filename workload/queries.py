"""One query per operator, over the whole of the tables it reads."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridledger.functions import models as model_functions
from gridledger.functions import names
from gridledger.functions.documents import with_metrics
from gridledger.functions.times import iso_timestamp
from gridledger.operators import catalog, matching, metrics, planning, scoring
from gridledger.operators import ledger as L
from gridledger.plans.tracking import update_tracking_incrementally
from gridledger.runtime import by_shuffle, shared_folder
from gridledger.schemas import CLASSIFICATION, KEYS, RETRIEVAL
from gridledger.sinks.documents import remove_folders, write_document_folders, write_documents
from gridledger.sinks.ledger import write_ledger, write_ledger_csv
from gridledger.sinks.metrics import write_metrics
from gridledger.sources.ledger import read_ledger, read_ledger_csv
from gridledger.sources.results import list_results, read_documents
from gridledger.streaming.ingest import read_facts
from workload.tables import Campaign

QUERIES = {}

EVALUATION = ["model", "pretrained", "benchmark"]
# Result files that a query keeps on disk at a time.
WAVE_FILES = 4_000_000


def query(build):
    """Register a function of the campaign under its own name."""
    QUERIES[build.__name__] = lambda spark, sf_dir: build(Campaign(spark, sf_dir))
    return build


# --- sources and sinks ----------------------------------------------------------------


@query
def ledger_read(c):
    """A ledger through CSV import and through its versioned store."""
    folder = shared_folder(c.spark, "ledger")
    write_ledger_csv(c.ledger(), f"{folder}/csv")
    write_ledger(read_ledger_csv(c.spark, f"{folder}/csv"), f"{folder}/store")
    return read_ledger(c.spark, f"{folder}/store")


@query
def dataset_mapping(c):
    name = F.concat_ws(" ", F.col("p_name"), F.col("p_partkey"))
    entry = '"NAME": {"webdataset_name": "wds/NAME", "dataset_root": "hub", "task": "TASK"}'
    doc = (
        '{"retrieval_datasets": {%s}, "classification_datasets": {%s}}'
        % (entry.replace("TASK", "zeroshot_retrieval"), entry.replace("TASK", "zeroshot_classification"))
    )
    docs = c.table("part").select(F.replace(F.lit(doc), F.lit("NAME"), name).alias("value"))
    return catalog.explode_mapping(docs)


def _from_result_store(c, read) -> DataFrame:
    """What ``read`` finds in folders of result files, one file for every document.

    A file takes an inode and a block however short it is, and a disk runs out of these long before its
    bytes. Files are therefore written, read and removed in waves, whatever the number of documents.
    """
    work = shared_folder(c.spark, "results")
    docs = c.documents().select(names.file_name("result_file").alias("file_name"), "doc")
    waves, found = max(1, -(-docs.count() // WAVE_FILES)), []
    if waves > 1:
        wave = F.pmod(F.xxhash64("file_name"), F.lit(waves)).cast("int").alias("wave")
        docs.select("*", wave).write.partitionBy("wave").parquet(f"{work}/docs")
        docs = c.spark.read.schema("file_name string, doc string, wave int").parquet(f"{work}/docs")
    for number in range(waves):
        part = docs.where(F.col("wave") == number).drop("wave") if waves > 1 else docs
        folders = write_document_folders(part, f"{work}/store-{number}")
        rows = read(folders)
        found.append(f"{work}/found-{number}")
        rows.write.parquet(found[-1])
        remove_folders(c.spark, folders)
    return c.spark.read.schema(rows.schema).parquet(*found)


@query
def result_listing(c):
    return _from_result_store(c, lambda folders: list_results(c.spark, *folders).select("file_name", "length"))


@query
def result_file_status(c):
    """Result files read from their folders, each with its error class."""
    status = F.coalesce("error_class", F.lit("ok")).alias("status")
    acc1 = F.col("metrics.acc1").alias("acc1")
    return _from_result_store(c, lambda folders: read_documents(c.spark, *folders).select("file_name", status, acc1))


@query
def json_load_status(c):
    parsed = with_metrics(c.documents())
    return parsed.select(
        "result_file",
        F.coalesce("error_class", F.lit("ok")).alias("status"),
        F.col("metrics.acc1").alias("acc1"),
        F.col("metrics.`text_retrieval_recall@5`").alias("text_recall"),
    )


@query
def model_catalog(c):
    return catalog.model_catalog(c.models())


@query
def metric_tables(c):
    """The merged metric table, written as CSV and read back."""
    folder = shared_folder(c.spark, "metrics")
    write_metrics(_completed(c), folder, "merged")
    schema = metrics.merged_metrics(_completed(c)).schema
    return c.spark.read.schema(schema).csv(f"{folder}/all_metrics.csv", header=True)


# --- catalog and grid -----------------------------------------------------------------


@query
def benchmark_catalog(c):
    run = c.items().where(F.col("task_type") == CLASSIFICATION).select("benchmark")
    return catalog.benchmark_catalog(run, catalog.default_mapping(c.spark))


@query
def pair_grid(c):
    return c.grid()


@query
def dataset_config(c):
    return catalog.with_dataset_config(c.grid(), catalog.default_mapping(c.spark))


# --- ledger ---------------------------------------------------------------------------


@query
def ledger_init(c):
    return L.new_ledger(c.grid())


@query
def ledger_merge(c):
    return L.merge_ledger(c.grid(), c.old_ledger())


@query
def added_cells(c):
    return L.added_cells(c.grid(), c.old_ledger())


@query
def ledger_upsert(c):
    return c.ledger()


@query
def status_counts(c):
    return L.status_counts(c.ledger(), "task_type")


@query
def pending_rows(c):
    return L.pending_rows(c.ledger())


@query
def group_rows(c):
    wanted = c.models().where(F.col("model") == "ViT-L-14").agg(F.min("pretrained")).scalar()
    return L.group_rows(c.ledger(), "ViT-L-14", wanted)


# --- result names ---------------------------------------------------------------------


@query
def filename_parse(c):
    parsed = matching.with_parsed_name(c.listing())
    return parsed.select("file_name", *[F.col(f"key.{k}").alias(k) for k in KEYS])


@query
def expected_name(c):
    return c.grid().select(*KEYS, names.expected_name().alias("file_name"))


@query
def unmatched_files(c):
    return matching.report(matching.unmatched_files(c.listing()).select("file_name"), "file_name")


@query
def latest_by_name(c):
    latest = L.latest_by_name(c.listing())
    return latest.select("file_name", "result_file", iso_timestamp("mtime").alias("timestamp"))


@query
def ambiguous_names(c):
    """File names that several lineitem rows share, of those a run may have."""
    return matching.ambiguous_names(c.items())


@query
def orphan_results(c):
    found = matching.match_by_parsing(c.listing())
    return matching.orphan_results(found, c.grid()).select(*KEYS, "result_file")


@query
def match_by_name(c):
    found = matching.match_by_name(c.grid(), c.listing())
    return found.select(*KEYS, "result_file", iso_timestamp("mtime").alias("timestamp"))


@query
def unexpected_files(c):
    return matching.unexpected_files(c.grid(), c.listing()).select("file_name")


# --- metric extraction ----------------------------------------------------------------


def _completed(c) -> DataFrame:
    documents = c.documents()
    ledger = L.upsert(L.new_ledger(c.grid()), documents)
    parsed = with_metrics(documents.select("result_file", "doc"))
    return metrics.completed_documents(ledger, parsed)


@query
def completed_docs(c):
    return _completed(c).select(
        *KEYS, "benchmark_run_at", "result_file", "error_class", F.col("metrics.acc1").alias("acc1")
    )


@query
def classification_metrics(c):
    return metrics.classification_metrics(_completed(c))


@query
def retrieval_metrics(c):
    return metrics.retrieval_metrics(_completed(c))


@query
def merged_metrics(c):
    return metrics.merged_metrics(_completed(c))


@query
def parse_errors(c):
    return metrics.parse_errors(_completed(c))


# --- planning -------------------------------------------------------------------------


def _runs_as_text():
    each = F.transform("runs", lambda r: F.concat_ws(":", r["task_type"], r["benchmark"]))
    return F.array_join(each, ",").alias("runs")


@query
def pending_groups(c):
    groups = planning.pending_groups(c.ledger())
    return groups.select("model", "pretrained", _runs_as_text(), "num_benchmarks")


@query
def sampled_groups(c):
    groups = planning.sampled_groups(planning.pending_groups(c.ledger()), 100, 7)
    return groups.select("model", "pretrained", "num_benchmarks")


@query
def group_plan(c):
    return planning.group_plan(planning.pending_groups(c.ledger())).drop("runs")


@query
def plan_summary(c):
    plan = planning.group_plan(planning.pending_groups(c.ledger()))
    return planning.plan_summary(plan)


@query
def first_n_per_group(c):
    return planning.first_n_per_group(c.ledger(), 3).select(KEYS)


@query
def group_label(c):
    return c.models().select("model", "pretrained", names.group_label("eval/group").alias("label"))


@query
def run_summary(c):
    return planning.run_summary(c.run_log())


@query
def model_requirement(c):
    return model_functions.with_requirement(c.models())


def _estimates(c) -> DataFrame:
    sized = model_functions.with_requirement(c.grid())
    return sized.select(
        *KEYS, "recommended_gpu", model_functions.runtime_minutes().alias("minutes")
    )


@query
def runtime_estimate(c):
    return _estimates(c).drop("recommended_gpu")


@query
def cost_estimate(c):
    hours = F.col("minutes") / 60.0
    spot = F.col("task_type") == CLASSIFICATION
    cost = model_functions.gpu_cost(model_functions.one_gpu(), hours, spot)
    return _estimates(c).select(*KEYS, F.round(cost, 6).alias("cost"))


# --- incremental ingest ---------------------------------------------------------------


@query
def incremental_ingest(c):
    """Ledger and facts after all documents of each cell arrived in three waves.

    The first of a cell comes under its expected name; those between under names of their own; the last
    one, which only the listing finds, is written in the place of the first.
    """
    work = shared_folder(c.spark, "ingest")
    root, store, facts = (f"{work}/{name}" for name in ("ledger", "store", "facts"))
    write_ledger(L.new_ledger(c.grid()), root)
    cell = Window.partitionBy(*KEYS)
    place, count = F.row_number().over(cell.orderBy("mtime", "result_file")), F.count("*").over(cell)
    own_name = names.file_name("result_file").alias("own_name")
    docs = c.documents().select(*KEYS, own_name, "doc", place.alias("place"), count.alias("count"))
    wave = F.when(F.col("place") == 1, 1).when(F.col("place") == F.col("count"), 3).otherwise(2)
    docs.withColumn("wave", wave).write.parquet(f"{work}/docs")
    docs = c.spark.read.parquet(f"{work}/docs")
    file_name = F.when(F.col("wave") == 2, F.col("own_name")).otherwise(names.expected_name()).alias("file_name")
    for number in (1, 2, 3):
        write_documents(docs.where(F.col("wave") == number).select(file_name, "doc"), store)
        update_tracking_incrementally(c.spark, root, store, facts, f"{work}/checkpoint" if number < 3 else None)
    found = read_facts(c.spark, facts).select("file_name", "metrics.acc1")
    arrived = docs.where("wave < 3").select(*KEYS, file_name).join(by_shuffle(found), "file_name", "left_semi")
    files = arrived.groupBy(*KEYS).agg(F.count("*").alias("files"))
    ledger = read_ledger(c.spark, root).join(by_shuffle(files), KEYS, "left")
    name = names.file_name("result_file").alias("file_name")
    ledger = ledger.select(*KEYS, name, "status", F.coalesce("files", F.lit(0)).alias("files"))
    return ledger.join(by_shuffle(found), "file_name", "left")


# --- evaluation -----------------------------------------------------------------------


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(
        *[F.round(f.name, 6).alias(f.name) if f.dataType.simpleString() == "double" else f.name for f in df.schema]
    )


def _class_hits(c):
    classes = c.prototypes().withColumn("id", F.col("label"))
    return scoring.class_hits(scoring.nearest(c.vectors(), classes))


@query
def zeroshot_accuracy(c):
    return _rounded(scoring.accuracy(_class_hits(c)))


@query
def mean_per_class_recall(c):
    return _rounded(scoring.mean_per_class_recall(_class_hits(c)))


@query
def retrieval_recall_at_5(c):
    texts = scoring.recall_at_k(scoring.nearest(c.images(), c.texts()))
    images = scoring.recall_at_k(scoring.nearest(c.texts(), c.images()))
    named = texts.withColumn("found", F.lit("texts")).union(images.withColumn("found", F.lit("images")))
    return _rounded(named)


@query
def retrieval_recall_by_blocks(c):
    """As retrieval_recall_at_5, the way it is done when no side is small."""
    texts = scoring.recall_at_k(scoring.nearest(c.images(), c.texts(), blocked=True))
    images = scoring.recall_at_k(scoring.nearest(c.texts(), c.images(), blocked=True))
    return _rounded(texts.withColumn("found", F.lit("texts")).union(images.withColumn("found", F.lit("images"))))


@query
def class_average_precision(c):
    return _rounded(scoring.class_average_precision(c.vectors(), c.prototypes()))


@query
def mean_average_precision(c):
    return _rounded(scoring.mean_average_precision(c.vectors(), c.prototypes()))


@query
def grouped_evaluation(c):
    """Documents of every evaluation, read back into the merged metric table."""
    docs = scoring.evaluate(
        c.vectors(True), c.prototypes(EVALUATION), c.images(True), c.texts(True), EVALUATION
    )
    parsed = with_metrics(docs).withColumn("benchmark_run_at", F.lit(""))
    return _rounded(metrics.merged_metrics(parsed).drop("benchmark_run_at"))
