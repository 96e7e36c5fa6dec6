"""Mixing sources to target weights, by hash-threshold histograms. DataFrame functions only.

Every source has a budget of words. Rows are taken by a hash of their own: all rows below a
threshold. The threshold is found without sorting: words are summed by source and by the hash's
first digits, the budget falls into one of these buckets, and only that boundary bucket is summed
again by the next digits, until all digits are used. What is then left of the budget is smaller
than the row at the threshold, so that further passes over the rows that still fit fill it up. In
the end, one row more is taken if that brings the sum nearer to the budget than leaving it.

Budgets are nested: a target up to the source's size takes rows once; beyond it, all rows are taken
once and the rest of the target takes rows a second time.

Defined results: a null text has no words; null sources are one source, the last; rows of no words
are taken as their hash says and count nothing; rows equal in doc_id and text are told apart by their
number among these, so that any part of them may be taken, and which of them that is doesn't matter;
a null doc_id counts as any other value. Extra columns are passed over. No rows give no rows. Reruns
agree: the hash is of doc_id, text and that number alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridledger.llm.common import WORD, saved
from gridledger.runtime import row_bound

WEIGHTS = (5, 2, 1)
#: Parts of 100 of all words that the targets share, and how often a source may be taken.
SHARE, EPOCHS = 150, 2
#: Hexadecimal digits of the hash, those of one histogram, and passes over what is left.
DIGITS, STEP, PASSES = 12, 4, 3


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def own_hash(doc_id: Column, text: Column) -> Column:
    """The digits of a hash of the row, as text."""
    of = F.concat_ws("|", F.coalesce(doc_id.cast("string"), F.lit("-")), F.coalesce(F.md5(text.cast("binary")), F.lit("-")))
    return F.substring(F.md5(of.cast("binary")), 1, DIGITS)


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, digits) for each row."""
    return docs.select(
        "doc_id",
        F.col("source").cast("string").alias("source"),
        words(F.col("text")).alias("size"),
        own_hash(F.col("doc_id"), F.col("text")).alias("digits"),
    )


def source_targets(rows: DataFrame) -> DataFrame:
    """(source, source_size, target): the share of each source by weight, none above its bound.

    One row per source. With the sources in order of bound by weight, those before some point are at
    their bounds, and the others share what is left by weight.
    """
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = sources.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("rank") % len(WEIGHTS) + 1).cast("int"))
    bound = F.col("source_size") * EPOCHS
    ranked = ranked.select("source", "source_size", weight.alias("weight"), bound.alias("bound"))
    order = Window.orderBy(F.col("bound") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(0))
    left = F.sum("source_size").over(everything) * (SHARE / 100) - F.coalesce(F.sum("bound").over(before), F.lit(0))
    weights = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    ranked = ranked.withColumn("level", left / weights)
    # The first source that its share doesn't bring to its bound sets the level for those after it.
    fits = F.when(F.col("level") * F.col("weight") <= F.col("bound"), F.col("level"))
    level = F.first(fits, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    target = F.when(level.isNull(), F.col("bound").cast("double")).otherwise(
        F.least(level * F.col("weight"), F.col("bound").cast("double"))
    )
    return ranked.select("source", "source_size", target.alias("target"))


def repeated(rows: DataFrame) -> DataFrame:
    """The digits that several rows have."""
    return saved(rows.groupBy("digits").agg(F.count("*").alias("n")).filter("n > 1").select("digits"), "repeated")


def told_apart(rows: DataFrame, shared: DataFrame) -> DataFrame:
    """``rows`` whose shared digits are replaced by a hash of them and of the row's number among these.

    The rows of each partition are numbered by themselves, on top of those before, so that digits which
    a third of all rows have are not one task's work. The first row keeps its digits.
    """
    if not shared.take(1):
        return rows
    some = F.broadcast(shared) if row_bound(shared) else shared
    again = rows.join(some, "digits", "left_semi").withColumn("_part", F.spark_partition_id())
    again = saved(again, "again")
    sums = again.groupBy("digits", "_part").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("digits").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("digits", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    own = F.row_number().over(Window.partitionBy("digits", "_part").orderBy("_part")) - 1
    again = again.withColumn("_own", own).join(sums, ["digits", "_part"])
    number = F.col("_start") + F.col("_own")
    of = F.concat_ws("|", "digits", number.cast("string")).cast("binary")
    again = again.withColumn("digits", F.when(number == 0, F.col("digits")).otherwise(F.substring(F.md5(of), 1, DIGITS)))
    return rows.join(some, "digits", "left_anti").unionByName(again.drop("_part", "_own", "_start"))


def _once() -> Column:
    """True for sources all of whose rows are taken once, and some a second time."""
    return F.col("target") >= F.col("source_size")


def _with(df: DataFrame, facts: DataFrame, few: bool) -> DataFrame:
    """``df`` joined with facts of each source, sent to all tasks only if they are few; null is a source."""
    facts = facts.withColumnRenamed("source", "_source")
    facts = F.broadcast(facts) if few else facts
    return df.join(facts, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")


def _threshold(rows: DataFrame, budgets: DataFrame, few: bool) -> DataFrame:
    """(source, cut, used): rows whose digits sort before ``cut`` sum to ``used``, at most ``room``.

    The cut falls into the boundary bucket of each histogram in turn; without a cut, all rows fit.
    """
    state = budgets.select("source", "room", F.lit("").alias("cut"), F.lit(0).cast("long").alias("used"))
    for depth in range(STEP, DIGITS + 1, STEP):
        near = _with(rows, state.filter("cut is not null"), few).filter(F.col("digits").startswith(F.col("cut")))
        sums = near.groupBy("source", F.substring("digits", 1, depth).alias("bucket")).agg(
            F.sum("size").alias("n"), F.first("room").alias("room"), F.first("used").alias("used")
        )
        upto = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        sums = sums.withColumn("total", F.col("used") + F.sum("n").over(upto))
        over = F.col("total") > F.col("room")
        found = sums.groupBy(F.col("source").alias("_source")).agg(
            F.min(F.when(over, F.col("bucket"))).alias("new_cut"),
            F.max(F.when(~over, F.col("total"))).alias("new_used"),
        )
        state = state.join(found, F.col("source").eqNullSafe(F.col("_source")), "left")
        new_cut, new_used = F.when(F.col("cut").isNotNull(), F.col("new_cut")), F.coalesce("new_used", "used")
        state = saved(state.select("source", "room", new_cut.alias("cut"), new_used.alias("used")), "cuts")
    return state.select("source", "cut", "used")


class Mix:
    """The takes of a mix: which rows of ``sized`` are taken, and how often.

    What decides on a row is one row of facts for its source: size, target, the room and the cut of each
    pass, and the digits taken last.
    """

    def __init__(self, rows: DataFrame) -> None:
        targets = saved(source_targets(rows), "targets")
        self.few = row_bound(targets)
        room = F.when(_once(), F.col("target") - F.col("source_size")).otherwise(F.col("target"))
        self.facts, open_rows = targets.withColumn("room0", room), rows
        for k in range(PASSES):
            if k:
                # Rows above the cut that still fit are open for what the pass before has left.
                kept = (F.col("digits") >= F.col(f"cut{k - 1}")) & (F.col("size") <= F.col(f"room{k}"))
                open_rows = _with(open_rows, self.facts, self.few).filter(kept).select("source", "size", "digits")
                open_rows = saved(open_rows, "open")
            budgets = self.facts.select("source", F.col(f"room{k}").alias("room"))
            cut = _threshold(open_rows, budgets, self.few).withColumnRenamed("cut", f"cut{k}")
            facts = _with(self.facts, cut, self.few).withColumn(f"room{k + 1}", F.col(f"room{k}") - F.col("used"))
            self.facts = saved(facts.drop("used"), "facts")
        left = f"room{PASSES}"
        rest = _with(rows, self.facts, self.few).filter(~self._taken())
        rest = rest.filter(f"size > 0 and size < 2 * {left}").groupBy("source", "digits")
        rest = rest.agg(F.sum("size").alias("size"), F.first(left).alias("left")).filter("size < 2 * left")
        last = F.min(F.struct(F.abs(F.col("size") - F.col("left")).alias("off"), "digits"))
        last = rest.groupBy(F.col("source").alias("_source")).agg(last.alias("last"))
        facts = self.facts.join(last, F.col("source").eqNullSafe(F.col("_source")), "left")
        self.facts = saved(facts.withColumn("last", F.col("last.digits")).drop("_source"), "facts")

    def _taken(self) -> Column:
        """Whether the passes take a row: the first one that it fits into and whose cut it lies below."""
        taken = F.lit(False)
        for k in range(PASSES):
            fits = F.col("size") <= F.col(f"room{k}") if k else F.lit(True)
            taken = taken | (fits & (F.col(f"cut{k}").isNull() | (F.col("digits") < F.col(f"cut{k}"))))
        return taken

    def with_copies(self, rows: DataFrame) -> DataFrame:
        """``rows`` (source, size, digits and others) with source_size, target and copies."""
        taken = self._taken() | F.coalesce(F.col("digits") == F.col("last"), F.lit(False))
        copies = (taken.cast("int") + _once().cast("int")).alias("copies")
        return _with(rows, self.facts, self.few).select(*rows.columns, "source_size", "target", copies)


def mix(docs: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken) for each row of ``docs``."""
    rows = saved(sized(docs), "sized")
    rows = told_apart(rows, repeated(rows))
    out = Mix(rows).with_copies(rows)
    return out.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).cast("long").alias("taken")
    )


def mixed(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it; all columns stay."""
    rows = saved(sized(docs).select("source", "size", "digits"), "sized")
    shared = repeated(rows)
    whole = docs.select(
        F.struct("*").alias("row"),
        F.col("source").cast("string").alias("source"),
        words(F.col("text")).alias("size"),
        own_hash(F.col("doc_id"), F.col("text")).alias("digits"),
    )
    # Texts stay in their tasks but for rows that are there twice: one join with the facts decides.
    out = Mix(told_apart(rows, shared)).with_copies(told_apart(whole, shared)).filter("copies > 0")
    return out.select("row", F.explode(F.sequence(F.lit(1), "copies"))).select("row.*")
