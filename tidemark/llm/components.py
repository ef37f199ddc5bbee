"""Connected components of an edge table by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.session import materialise


def star(edges: DataFrame, smaller: bool) -> DataFrame:
    """Large star: every larger neighbour to the least of a node's neighbourhood; small star: the smaller ones.

    A node's least neighbour is a map-side aggregate, so that a node with very many edges is no
    hot group; the join back meets it once for each of its edges.
    """
    if smaller:
        pairs = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    else:
        pairs = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    met = pairs.join(least, "u")
    if smaller:
        hung = met.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        hung = hung.union(least.where("u <> m").select("u", F.col("m").alias("v")))
    else:
        hung = met.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return hung.distinct()


def components(edges: DataFrame) -> DataFrame:
    """(u, root) for every node of ``edges(u long, v long)``: the least node it is connected with.

    Each round is written to the shared folder and the next one starts from there; the rounds end
    when the table no longer changes. Only its row count and a checksum come to the driver.
    """
    now = materialise(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges"
    )
    seen = None
    while True:
        total = now.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")
        ).first()
        if seen == (total["n"], total["h"]) or not total["n"]:
            break
        seen = (total["n"], total["h"])
        now = materialise(star(star(now, False), True), "edges")
    return now.groupBy("u").agg(F.min("v").alias("root")).union(
        now.select("v").distinct().select("v", F.col("v").alias("root"))
    ).groupBy("u").agg(F.min("root").alias("root"))
