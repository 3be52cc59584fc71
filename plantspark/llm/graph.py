"""Connected components by star contraction, on tables of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantspark.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """edges: a, b (long). Returns node, root: the smallest node reachable, for every node that has an edge.

    Alternates two steps until nothing changes: each node's larger neighbours are linked to its smallest
    neighbour, then each node's smaller ones are. Every step is an aggregate and a join on one column; a node with
    very many edges is a hot key of that join only, which Spark splits. Every round is written to the shared folder.
    """
    now = stored(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "edges"
    )
    mark = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = stored(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        was, mark = mark, now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == was:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
