"""Connected components of a link table, by alternating large and small stars.

Every round replaces links by links to the smallest known neighbour, with
grouped aggregates only; a component shrinks to a star in a number of rounds
about logarithmic in its size. The links of each round are stored in the
shared checkpoint folder, so lineage stays short and a lost executor costs one
round at most. A node with very many neighbours is no single group: its
minimum is combined map-side and joined back, and Spark may split that join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def _star(links: DataFrame, large: bool) -> DataFrame:
    """links (u, v), u > v. Large: every larger neighbour of a node points to
    the node's smallest neighbour (or itself); small: the smaller ones do."""
    if large:
        near = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        near = links
    least = near.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    if large:
        out = near.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = near.join(least, "u").select("u", "v", "m")
        out = out.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")) \
                 .unionByName(least.select("u", F.col("m").alias("v")))
    return out.filter("u <> v").distinct()


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) of every node in ``links`` (columns a, b; any order,
    repeats and self links allowed); component: its smallest node."""
    now = links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now = cut(now)
    print_of = None
    for _ in range(max_rounds):
        now = cut(_star(_star(now, True), False))
        r = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if print_of == (r["n"], r["s"]):
            break
        print_of = (r["n"], r["s"])
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")) \
              .unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
