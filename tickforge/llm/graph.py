"""Connected components of an edge table, by alternating star contractions.

Every step is a grouped minimum and a join, so a hub with many neighbours is
pre-aggregated and its join partition can be split; no neighbourhood is
gathered.  Each round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("hi").alias("lo"), F.col("lo").alias("hi")))
    least = both.groupBy("hi").agg(F.min("lo").alias("_m")).select("hi", F.least("_m", "hi").alias("_m"))
    moved = both.join(least, "hi").where(F.col("lo") > F.col("hi"))
    return moved.select(F.col("_m").alias("lo"), F.col("lo").alias("hi"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("hi").agg(F.min("lo").alias("_m"))
    moved = edges.join(least, "hi").where(F.col("lo") != F.col("_m"))
    return moved.select(F.col("_m").alias("lo"), F.col("lo").alias("hi")).unionByName(
        least.select(F.col("_m").alias("lo"), "hi")
    )


def connected_components(edges: DataFrame, path: str, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges`` (columns a, b; any ordered type).

    ``component`` is the smallest node reachable.  Loops and repeated edges are
    allowed; nodes without edges do not appear.
    """
    known = edges.where(F.col("a") != F.col("b"))
    stars = stored(known.select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).distinct(), f"{path}/0")
    before = None
    for i in range(1, max_rounds + 1):
        stars = stored(_small_star(_large_star(stars).distinct()).distinct(), f"{path}/{i}")
        now = stars.agg(F.count("*"), F.sum(F.xxhash64("lo", "hi").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("connected components did not settle")
    return stars.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(
        stars.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    )
