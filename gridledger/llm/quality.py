"""Quality of documents by a sparse rule ensemble over text statistics.

Shallow trees of a random forest propose rules: every path from a root is a conjunction of bounds on
statistics. A lasso logistic regression weighs the rules and drops most. What is left is compiled
into one Spark column expression, a sum of CASE terms under a sigmoid.

The model is fitted on at most ``TRAIN_ROWS`` labelled rows, those with the smallest hashes of their
doc_id among the rows that aren't held out; the statistics are of whole texts, and all documents are
scored. Labels, language, source and doc_id are no inputs of a score.

Defined results: a null text is as an empty one, with all statistics zero; rows without doc_id are
scored too, and are not held out; repeated rows are scored alike; labels without quality or for no
document teach nothing, and a document that has several teaches each. With labels of one class
only, or none, every score is the share of good ones (0.5 without labels). Extra columns are passed
over. No rows give no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridledger.llm.common import remainder, saved

#: Most rows that the model is fitted on, the forest's size, and the lasso's strength.
TRAIN_ROWS, TREES, DEPTH, LASSO = 20_000, 16, 3, 0.002
THRESHOLD, FOLDS = 0.3, 5

STATISTICS = (
    "words",
    "word_length",
    "upper",
    "digits",
    "symbols",
    "pipes",
    "exclaims",
    "marks",
    "spaces",
    "distinct",
    "repeated",
    "commonest",
    "function_words",
    "symbol_words",
    "upper_words",
    "lines",
    "distinct_lines",
    "line_words",
    "stops",
    "compressed",
)

#: Frequent function words of four languages.
FUNCTION_WORDS = frozenset(
    b"the of and to in is that it for on with as by at from this are be was or an a "
    b"le la les de des du et en un une que qui dans pour est au sur par "
    b"der die das und ist von zu den mit auf ein eine nicht im dem als "
    b"el los las y por con del se es su para una no lo".split()
)

_UPPER = np.arange(ord("A"), ord("Z") + 1)
_DIGITS = np.arange(ord("0"), ord("9") + 1)
_SYMBOLS = np.frombuffer(b"#$%&*+/<=>@\\^_`{|}~[]", np.uint8)
_MARKS = np.frombuffer(b".,;:?'\"()-", np.uint8)
_ODD_ENDS = frozenset(b"#$%&*+/<=>@\\^_`{|}~!")


def statistics(text: bytes) -> list[float]:
    """The numbers of ``STATISTICS`` for a text in UTF-8."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(STATISTICS)
    size = len(text)
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    letters = max(1, size - int(counts[:65].sum()))
    lowered = Counter(text.lower().split())
    lines = [x for x in text.split(b"\n") if x.strip()]
    repeats = sum(map(bytes.__eq__, words, words[1:]))
    return [
        math.log1p(n),
        size / n,
        counts[_UPPER].sum() / letters,
        counts[_DIGITS].sum() / size,
        counts[_SYMBOLS].sum() / n,
        counts[ord("|")] / n,
        counts[ord("!")] / n,
        counts[_MARKS].sum() / n,
        counts[ord(" ")] / size,
        len(lowered) / n,
        repeats / n,
        max(lowered.values()) / n,
        sum(c for w, c in lowered.items() if w in FUNCTION_WORDS) / n,
        sum(w[-1] in _ODD_ENDS for w in words) / n,
        sum(map(bytes.isupper, words)) / n,
        math.log1p(len(lines)),
        len(set(lines)) / len(lines),
        n / len(lines),
        sum(x.rstrip()[-1:] in b".?!" for x in lines) / len(lines),
        len(set(zip(words, words[1:], words[2:]))) / max(1, n - 2),
    ]


def _of_texts(texts: pd.Series) -> pd.Series:
    return pd.Series([np.array(statistics(x or b"")) for x in texts])


def with_statistics(df: DataFrame, name: str) -> DataFrame:
    of_texts = F.pandas_udf(_of_texts, "array<double>")
    return df.withColumn(name, of_texts(F.col("text").cast("binary")))


@dataclass(frozen=True)
class Rule:
    """Bounds (statistic, above, value) that hold together, and what they add to the log-odds."""

    bounds: tuple[tuple[int, bool, float], ...]
    weight: float = 0.0

    def holds(self, of: Column) -> Column:
        out = F.lit(True)
        for at, above, value in self.bounds:
            out = out & ((of[at] > value) if above else (of[at] <= value))
        return out


@dataclass(frozen=True)
class RuleModel:
    intercept: float
    rules: tuple[Rule, ...] = ()

    def score(self, of: Column) -> Column:
        """The probability of good quality, as an expression over a column of statistics."""
        total = F.lit(self.intercept)
        for rule in self.rules:
            total = total + F.when(rule.holds(of), F.lit(rule.weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def _paths(node, above: tuple = ()) -> list[tuple]:
    """The bounds on the way to each node below ``node`` of a fitted tree."""
    if node.subtreeDepth() == 0:
        return []
    split, out = node.split(), []
    for child, side in ((node.leftChild(), False), (node.rightChild(), True)):
        bounds = (*above, (split.featureIndex(), side, split.threshold()))
        out += [bounds, *_paths(child, bounds)]
    return out


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(stats, label): at most ``TRAIN_ROWS`` labelled rows that aren't held out."""
    chosen = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("label"))
        .filter(F.col("label").isin(0.0, 1.0) & (remainder(F.col("doc_id"), FOLDS) != 0))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "label")
        .limit(TRAIN_ROWS)
    )
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # The side that is sent to all tasks has TRAIN_ROWS rows at most.
    rows = with_statistics(own.join(F.broadcast(chosen), "doc_id"), "stats")
    return rows.select("doc_id", "label", "stats")


def fit(docs: DataFrame, labels: DataFrame) -> RuleModel:
    # A document that repeats may bring more rows than were chosen.
    rows = training_rows(docs, labels).orderBy("doc_id", "label", F.xxhash64("stats")).limit(TRAIN_ROWS)
    rows = saved(rows.coalesce(1), "training")
    shares = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    total = sum(shares.values())
    if len(shares) < 2:
        share = shares.get(1.0, 0) / total if total else 0.5
        return RuleModel(math.log((share + 1e-6) / (1 - share + 1e-6)))
    rows = rows.withColumn("features", array_to_vector("stats"))
    forest = RandomForestClassifier(
        numTrees=TREES, maxDepth=DEPTH, seed=7, featureSubsetStrategy="sqrt", subsamplingRate=0.7
    ).fit(rows.coalesce(1))
    paths = dict.fromkeys(p for tree in forest.trees for p in _paths(tree._java_obj.rootNode()))
    rules = [Rule(p) for p in paths]
    if not rules:
        return RuleModel(math.log(shares[1.0] / shares[0.0]))
    held = F.array(*(r.holds(F.col("stats")).cast("double") for r in rules))
    known = rows.select("label", array_to_vector(held).alias("features")).coalesce(1).persist()
    fitted = LogisticRegression(elasticNetParam=1.0, regParam=LASSO, maxIter=60).fit(known)
    known.unpersist()
    weights = fitted.coefficients.toArray()
    kept = tuple(Rule(r.bounds, float(w)) for r, w in zip(rules, weights, strict=True) if w)
    return RuleModel(float(fitted.intercept), kept)


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of ``docs``."""
    model = fit(docs, labels)
    score = model.score(F.col("stats"))
    out = with_statistics(docs.select("doc_id", "text"), "stats")
    out = out.select("doc_id", (F.coalesce(remainder(F.col("doc_id"), FOLDS), F.lit(-1)) == 0).alias("held_out"), score.alias("score"))
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without those that are predicted to be bad; all columns stay."""
    model = fit(docs, labels)
    rows = docs.select(F.struct("*").alias("row"), "text")
    good = with_statistics(rows, "stats").filter(model.score(F.col("stats")) >= THRESHOLD)
    return good.select("row.*")
