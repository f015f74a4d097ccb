"""Connected components of a graph whose edges are spread over the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from signalloom.operators.staging import staged


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a long, b long): root is the smallest node it reaches.

    Large-star and small-star in turn: each node's neighbours are hung on the smallest one, larger ones
    first, until nothing changes. Rounds grow with the logarithm of the longest path. Each round is
    written to the shared folder, so lineage stays short and nothing is gathered on the driver but two
    numbers a round. Edges of null ends and loops are ignored; no edges give no rows.
    """
    tree = staged(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges"
    )
    before = None
    while True:
        seen = Observation()
        tree = staged(
            _small_star(_large_star(tree)).observe(
                seen, F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0)).alias("h")
            ),
            "edges",
        )
        now = (seen.get["n"], seen.get["h"])
        if now == before:
            break
        before = now
    roots = tree.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(tree.select("v", "v").distinct())


def _large_star(tree: DataFrame) -> DataFrame:
    both = tree.union(tree.select("v", "u"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(tree: DataFrame) -> DataFrame:
    least = tree.groupBy("u").agg(F.min("v").alias("m"))
    moved = tree.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least).distinct()
