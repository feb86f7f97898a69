"""Connected components by alternating star rounds (Kiveris et al., "Connected Components in MapReduce and Beyond", 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._util import Scratch


def _large_star(e: DataFrame, scratch: Scratch) -> DataFrame:
    both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = scratch.save(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "large")
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")


def _small_star(e: DataFrame, scratch: Scratch) -> DataFrame:
    down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")
    least = scratch.save(down.groupBy("u").agg(F.min("v").alias("m")), "small")
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v")))


def connected(edges: DataFrame, scratch: Scratch, rounds: int = 60) -> DataFrame:
    """(fp, root) for every node of ``edges(u, v)``, roots included; the root is the group's smallest node.

    Each step is written in the shared folder. A star's centre may hold most edges: what is least of each node is written before it
    is joined, so that the join has two written sides and can split the centre.
    """
    e, seen = edges.where("u <> v"), None
    for k in range(rounds):
        e = scratch.save(_large_star(e, scratch), f"half{k}")
        e = scratch.save(_small_star(e, scratch).distinct(), f"stars{k}")
        scratch.drop(f"half{k}", f"stars{k - 1}", "large", "small")
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen or now[0] == 0:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return e.select(F.col("u").alias("fp"), F.col("v").alias("root")).unionByName(e.select(F.col("v").alias("fp"), F.col("v").alias("root")).distinct())
