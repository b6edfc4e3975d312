"""Connected components of an undirected graph, as DataFrame jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changecapture.llm.common import discard, written


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node with an edge; the root is the component's least node.

    ``edges`` has two columns ``u, v`` of one orderable type. Alternating stars: each round
    links the larger neighbours of a node, then its smaller ones, to the least of them, until
    every edge leads to a root. The number of rounds grows with the logarithm of the
    component, and each is written, so lineage stays short.
    """
    edges = written(
        edges.where("u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )
    while True:
        # large star: larger neighbours to the least neighbour
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select(F.col("u").alias("c"), F.least("u", "m").alias("m"))
        large = written(
            both.join(least, both["u"] == least["c"])
            .where("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v")
            .distinct()
        )
        discard(edges)
        # small star: a node and its smaller neighbours to the least of these
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        edges = written(
            large.join(least.withColumnRenamed("u", "c"), F.col("u") == F.col("c"))
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.withColumnRenamed("m", "v"))
            .where("u <> v")
            .distinct()
        )
        discard(large)
        parents = edges.select(F.col("v").alias("p")).distinct()
        inner = edges.join(parents, edges["u"] == parents["p"], "left_semi")
        many = edges.groupBy("u").count().where("count > 1")
        if inner.isEmpty() and many.isEmpty():
            break
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        roots.withColumn("root", F.col("node"))
    )
