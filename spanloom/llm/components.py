"""Connected components of a table of links, by alternating large and small stars; nothing is gathered on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Scratch, drop_path, written


def _mins(e: DataFrame) -> DataFrame:
    return e.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(e: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the least of the node and its neighbours."""
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    m = _mins(both).select("u", F.least("u", "m").alias("m"))
    return both.join(m, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).filter(F.col("u") != F.col("v")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the least of them."""
    down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter(F.col("u") != F.col("v"))
    m = _mins(down)
    moved = down.join(m, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter(F.col("u") != F.col("v"))
    return moved.unionByName(m.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """links: ``u, v`` of one type that has an order. Returns ``u, component`` for every node that isn't the least of its component.

    Rounds go on until nothing changes, which takes about the logarithm of the longest chain. Each round's table replaces the last.
    """
    e, path = written(links.filter(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    state = None
    while True:
        old = path
        e, path = written(_small_star(_large_star(e)), "stars")
        drop_path(e.sparkSession, old)
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            scratch.paths.append(path)
            return e.select("u", F.col("v").alias("component"))
        state = now
