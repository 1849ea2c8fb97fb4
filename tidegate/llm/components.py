"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.frames import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node points to the smallest node around it."""
    both = edges.select("u", "v").union(edges.select(F.col("v"), F.col("u")))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours point to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    across = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return across.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node that has an edge and is not itself the root of its component.

    ``edges`` has two columns of one ordered type; loops, repeats and null ends are
    left out. The root is the component's smallest node. Each round is written to
    the shared folder, so rounds do not pile up in the lineage; the number of rounds
    grows with the logarithm of the longest path. An empty table gives no rows.
    """
    u, v = (F.col(f"_{i}") for i in (0, 1))
    now = stored(
        edges.toDF("_0", "_1")
        .where(u != v)
        .select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v"))
        .distinct(),
        "edges",
    )
    state = None
    while True:
        after = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if tuple(after) == state:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = tuple(after)
        now = stored(_small_star(_large_star(now)), "edges")
