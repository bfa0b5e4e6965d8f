"""Connected components in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tallyroll.llm.shared import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of `edges` (a, b): the least node it is connected to.

    Each round links a node and all its neighbours to the least of them, until nothing changes
    (then every node is linked to its component's least node, and to that alone). Minima
    combine before the shuffle, and a hot node's edges are on the side of the join that Spark
    can split. What is reached doubles, so rounds grow with the logarithm of the longest path.
    """
    now, mark = _stored(edges.select(F.col("a").alias("u"), F.col("b").alias("v")))
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        to_least = both.join(least.hint("merge"), "u").select("v", "m")
        before = mark
        now, mark = _stored(to_least.toDF("u", "v").union(least.toDF("u", "v")))
        if mark == before:
            break
    member = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return member.union(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _stored(pairs: DataFrame) -> tuple[DataFrame, dict]:
    """Distinct edges from the larger node u to the smaller v, with their number and checksum."""
    seen = Observation()
    checksum = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("checksum")
    edges = pairs.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    table = stored(edges.observe(seen, F.count(F.lit(1)).alias("edges"), checksum), "links")
    return table, seen.get
