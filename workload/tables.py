"""An evaluation campaign made of the given tables.

part: a model and weights per part. nation: the benchmarks. lineitem: runs of a part's model on
the benchmark its supplier falls on, some cells often and some never. events: result documents
of the models whose part number is the user's. embeddings: items to evaluate.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridledger import fixed
from gridledger.functions.names import expected_name
from gridledger.operators import ledger as L
from gridledger.operators.catalog import pair_grid
from gridledger.schemas import CLASSIFICATION, KEYS, LEDGER_COLUMNS, RETRIEVAL

# Names that are in the metadata table, then names that are not.
MODELS = [row[0] for row in fixed.MODEL_METADATA] + [
    "ViT-B-32-quickgelu",
    "EVA01-g-99",
    "xlm-roberta-large-ViT-H-14",
    "convnext_large",
    "EVA02-E-14",
    "vit-b-32",
    "coca_ViT-L-14",
    "ViT-SO400M-14-SigLIP",
    "RN50-quickgelu",
]
# By nation key. Where it is empty, the benchmark has the nation's own name.
BENCHMARKS = [
    "mscoco_captions", "imagenet1k", "cifar10", "cifar100", "caltech101",
    "flickr30k", "dtd", "eurosat", "flowers", "food101",
    "mscoco_captions2017", "pets", "pcam", "resisc45", "fgvc_aircraft",
    "flickr8k", "imagenet_sketch", "diabetic_retinopathy", "cars", "mnist",
    "", "sun397_official_splits", "svhn", "clevr_count_all", "",
]


def _pick(names: list[str], position) -> F.Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), (position + 1).cast("int"))


class Campaign:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def parts(self) -> DataFrame:
        key = F.col("p_partkey")
        return self.table("part").select(
            "p_partkey",
            _pick(MODELS, key % len(MODELS)).alias("model"),
            F.concat(F.lower("p_type"), F.lit("_s"), key.cast("string")).alias("pretrained"),
        )

    def models(self) -> DataFrame:
        return self.parts().select("model", "pretrained")

    def nations(self) -> DataFrame:
        named = _pick(BENCHMARKS, F.col("n_nationkey"))
        return self.table("nation").select(
            "n_nationkey",
            F.when(F.col("n_regionkey") == 0, RETRIEVAL).otherwise(CLASSIFICATION).alias("task_type"),
            F.when(named == "", F.col("n_name")).otherwise(named).alias("benchmark"),
        )

    def benchmarks(self) -> DataFrame:
        return self.nations().select("task_type", "benchmark")

    def grid(self) -> DataFrame:
        return pair_grid(self.models(), self.benchmarks())

    def _with_keys(self, rows: DataFrame, part, number) -> DataFrame:
        return rows.join(self.parts(), part == F.col("p_partkey")).join(
            self.nations(), number % len(BENCHMARKS) == F.col("n_nationkey")
        )

    def items(self) -> DataFrame:
        """lineitem with the key of the run each row stands for."""
        rows = self.table("lineitem").select(
            "l_partkey", "l_suppkey", "l_orderkey", "l_linenumber", "l_returnflag", "l_shipdate"
        )
        return self._with_keys(rows, F.col("l_partkey"), F.col("l_suppkey"))

    def runs(self) -> DataFrame:
        number = F.concat_ws("-", F.col("l_orderkey"), F.col("l_linenumber"))
        path = F.concat(F.lit("r/"), number, F.lit(".json"))
        return self.items().select(*KEYS, path.alias("result_file"), F.col("l_shipdate").alias("mtime"))

    def ledger(self) -> DataFrame:
        return L.upsert(L.new_ledger(self.grid()), self.runs())

    def old_ledger(self) -> DataFrame:
        """An earlier ledger: no unrun cells, no status for retrieval, models since retired."""
        status = F.when(F.col("task_type") == CLASSIFICATION, "completed")
        kept = L.latest_results(self.runs()).select(
            *KEYS,
            "result_file",
            F.date_format("mtime", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
            status.alias("status"),
        )
        retired = self.table("customer").select(
            F.lit("retired").alias("model"),
            F.col("c_name").alias("pretrained"),
            F.lit(CLASSIFICATION).alias("task_type"),
            F.lit("imagenet1k").alias("benchmark"),
            F.lit("").alias("result_file"),
            F.lit("").alias("timestamp"),
            F.lit("pending").alias("status"),
        )
        return kept.select(LEDGER_COLUMNS).union(retired)

    def listing(self) -> DataFrame:
        """A file per lineitem row: some logs, some named for other weights than the ledger's."""
        number = F.concat_ws("-", F.col("l_orderkey"), F.col("l_linenumber"))
        log = F.concat(F.lit("log_"), number, F.lit(".json"))
        weights = F.when(F.col("l_linenumber") % 2 == 0, "openai").otherwise(F.col("pretrained"))
        name = F.when(F.col("l_returnflag") == "R", log).otherwise(expected_name(pretrained=weights))
        return self.items().select(
            F.concat(F.lit("results/"), name).alias("result_file"),
            name.alias("file_name"),
            F.col("l_shipdate").alias("mtime"),
        )

    def documents(self) -> DataFrame:
        """Key, result_file, mtime and doc of every event."""
        number = F.regexp_extract("props", "([0-9]+)", 1)
        kind = F.col("event_type")

        def metrics(template: str):
            return F.replace(F.lit(template), F.lit("N"), number)

        doc = (
            F.when(F.col("value") < 5, "")
            .when(kind == "error", F.substring("props", 1, 4))
            .when(kind == "signup", "{}")
            .when(kind == "view", F.concat(F.lit("["), "props", F.lit("]")))
            .when(kind == "click", metrics(CLASSIFICATION_DOC))
            .when(F.col("value") > 100, F.concat(metrics(RETRIEVAL_DOC), F.lit(" end")))
            .otherwise(metrics(RETRIEVAL_DOC))
        )
        path = F.concat(F.lit("results/"), F.col("event_id"), F.lit(".json"))
        rows = self.table("events")
        return self._with_keys(rows, F.col("user_id"), F.col("event_id")).select(
            *KEYS, path.alias("result_file"), F.col("ts").alias("mtime"), doc.alias("doc")
        )

    def run_log(self) -> DataFrame:
        failed = F.col("event_type") == "error"
        length = F.round(F.col("value") * 1_000_000).cast("long")
        end = F.timestamp_micros(F.unix_micros(F.col("ts").cast("timestamp")) + length)
        rows = self.table("events")
        return self._with_keys(rows, F.col("user_id"), F.col("event_id")).select(
            *KEYS,
            F.when(failed, "failed").otherwise("completed").alias("status"),
            F.when(~failed | (F.col("value") >= 5), F.col("value")).alias("runtime_seconds"),
            F.col("ts").cast("timestamp").alias("started_at"),
            end.alias("ended_at"),
        )

    def vectors(self, keyed: bool = False) -> DataFrame:
        keys = []
        if keyed:
            keys = [
                F.concat(F.lit("model-"), (F.col("vec_id") % 3).cast("string")).alias("model"),
                F.lit("laion400m_e32").alias("pretrained"),
                F.lit("embeddings").alias("benchmark"),
            ]
        return self.table("embeddings").select(
            *keys, F.col("vec_id").alias("id"), "label", F.col("embedding").alias("vector")
        )

    def prototypes(self, keys=()) -> DataFrame:
        """The first vector of each class. Ids are compared first, without the vectors."""
        vectors = self.vectors(bool(keys))
        first = vectors.groupBy(*keys, "label").agg(F.min("id").alias("id"))
        return vectors.join(first, [*keys, "label", "id"]).select(*keys, "label", "vector")

    def images(self, keyed: bool = False) -> DataFrame:
        return self.vectors(keyed).where(F.col("id") % 2 == 0)

    def texts(self, keyed: bool = False) -> DataFrame:
        return self.vectors(keyed).where(F.col("id") % 2 == 1)


CLASSIFICATION_DOC = '{"metrics": {"acc1": 0.N, "acc5": 0.9N, "mean_per_class_recall": 0.N5}}'
RETRIEVAL_DOC = (
    '{"metrics": {"image_retrieval_recall@5": 0.N, "text_retrieval_recall@5": 0.N7, '
    '"mean_average_precision": null}}'
)
