"""Connected components of a graph given as pairs of ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barograph.llm.common import stored


def _pairs(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.where("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of the links ``u, v``; the root is the smallest node.

    Alternates large and small stars until nothing changes, a logarithmic
    number of rounds; each round is written to the shared folder. Minima are
    combined before the shuffle, and a hot node's join is split by Spark.
    """
    edges = stored(_pairs(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))), "links")
    state = None
    while True:
        both = edges.union(edges.select("v", "u")).toDF("u", "v")
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = _pairs(both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        edges = stored(_pairs(small.select(F.col("v").alias("u"), F.col("m").alias("v")),
                              least.select("u", F.col("m").alias("v"))), "links")
        found = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if found == state:
            break
        state = found
    roots = edges.groupBy("u").agg(F.min("v").alias("root")).withColumnRenamed("u", "node")
    return roots.union(roots.select(F.col("root").alias("node"), "root").distinct())
