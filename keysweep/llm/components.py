"""Connected components of a table of links, by alternating steps that hang nodes below smaller ones.

Each step is an aggregation, which shrinks before its shuffle, and a join of stored tables, of which Spark splits hot
nodes; no neighbourhood is gathered in one place. The number of steps grows with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keysweep.llm.staging import Stage


def components(links: DataFrame, stage: Stage) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b: long) but the roots; a root is the least node it reaches."""
    edges = stage(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        edges = stage(hung(both, stage).filter("b0 > a").select(F.col("b0").alias("a"), F.col("m").alias("b")).distinct(), "large")
        found = hung(edges, stage)
        small = found.select(F.col("b0").alias("a"), F.col("m").alias("b")).union(found.select("a", F.col("m").alias("b")))
        edges = stage(small.filter("a <> b").distinct(), "small")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % (1 << 31))).first()
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now


def hung(edges: DataFrame, stage: Stage) -> DataFrame:
    """Edges a-b0 with m, the least of a and its neighbours."""
    least = stage(edges.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least")
    return edges.withColumnRenamed("b", "b0").join(least.hint("merge"), "a")
