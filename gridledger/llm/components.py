"""Connected components of a table of links, by alternating large and small stars.

Every round sends each node its smallest neighbour (a sum over the links, combined before the
shuffle) and rewires the links to it, so that the links' number never grows. Rounds end when nothing
changes: all links are stars then. Their number grows with the logarithm of the longest chain.

Spark splits a node with very many links only where a join stands directly above its two shuffles. In
tables of many links the sums are therefore saved before they are joined; in small ones a node's links
are few whatever their share.
"""

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from gridledger.llm.common import Scratch

#: Links from which on sums are saved before they are joined.
MANY_LINKS = 1_000_000


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """(node, component): the smallest node reachable, for every node that has a link to another.

    Null ends and links of a node to itself count for nothing; links may repeat.
    """
    ends = links.select(F.col(left).alias("u"), F.col(right).alias("v")).filter("u <> v")
    scratch, seen = Scratch(), Observation()
    edges = ends.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    edges = scratch.saved(edges.observe(seen, F.count("*").alias("links")), "links")
    many, changed = (seen.get["links"] or 0) >= MANY_LINKS, True
    while changed:

        def kept(df: DataFrame, label: str, many: bool = many, scratch: Scratch = scratch) -> DataFrame:
            return scratch.saved(df, label) if many else df

        # Large star: the larger neighbours of a node go to the smallest of it and its neighbours.
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(kept(least, "least"), "u")
        large = large.select(F.col("v").alias("u"), F.col("m").alias("v"), (F.col("m") < F.col("u")).alias("changed"))
        large = kept(large, "large")
        # Small star: a node and its smaller neighbours go to the smallest of them.
        floor = large.groupBy("u").agg(F.min("v").alias("m"), F.max("changed").alias("changed"))
        floor = kept(floor, "floor")
        small = large.select("u", "v").join(floor.select("u", "m"), "u").filter("v <> m")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v"), F.lit(True).alias("changed"))
        small = small.union(floor.select("u", "m", "changed")).groupBy("u", "v").agg(F.max("changed").alias("changed"))
        seen = Observation()
        before, scratch = scratch, Scratch()
        edges = scratch.saved(small.observe(seen, F.max("changed").alias("changed")), "links").select("u", "v")
        changed = seen.get["changed"]
        before.clear()
    scratch.hand_over()
    roots = edges.groupBy("v").agg(F.lit(0)).select(F.col("v").alias("node"), F.col("v").alias("component"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
