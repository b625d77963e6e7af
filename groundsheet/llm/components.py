"""Connected components over an edge table, by alternating stars, with built-in functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundsheet.operators.lineage import materialize

#: A node's minimum is laid on so many salts, so the edges of one hub meet it in as many tasks.
SALTS = 8


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node, root`` for every node of an edge between different nodes; root is the smallest node reachable.

    Edges may repeat, point both ways, join a node to itself or hold nulls (both ignored); no edges
    give no rows.  Each round links larger neighbours to the smallest one and then smaller ones to
    it, which ends in stars after a number of rounds logarithmic in the longest path; a round is
    written to the shared folder, so a lost executor costs one round at most.  Minima are taken
    before the shuffle, so hubs are no hot groups.
    """
    links = edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    links = materialize(links.distinct(), "links")
    seen = None
    while True:
        mark = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen or not mark[0]:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                links.select(F.col("v"), F.col("v"))
            ).groupBy("node").agg(F.min("root").alias("root"))
        seen = mark
        links = materialize(_small_star(_large_star(links)), "links")


def _to_minimum(pairs: DataFrame) -> DataFrame:
    """Pairs (u, v) with m, the smallest v of their u or u itself."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    least = least.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = pairs.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int"))
    return salted.join(least, ["u", "salt"]).withColumn("m", F.least("m", "u"))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _to_minimum(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    near = _to_minimum(links)
    return (
        near.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        .union(near.select("u", F.col("m").alias("v")))
        .where("u <> v").distinct()
    )
