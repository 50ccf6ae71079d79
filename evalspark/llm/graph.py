"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(a, b) edges of integer nodes -> (node, root): the smallest node that
    each non-root node reaches. Alternates two steps that keep connectivity:
    every node's larger neighbours, then all its smaller ones, are tied to its
    smallest neighbour, until nothing changes. Only counts reach the driver.
    """
    def smallest(e: DataFrame) -> DataFrame:
        return e.groupBy("u").agg(F.min("v").alias("m"))

    e = common.stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    mark = None
    for _ in range(rounds):
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == mark or not now[0]:
            break
        mark = now
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (both.join(smallest(both), "u").where("v > u")
                 .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).where("u <> v").distinct())
        small = smallest(large)
        e = common.stored(large.join(small, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                          .unionByName(small.select("u", F.col("m").alias("v"))).distinct())
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
