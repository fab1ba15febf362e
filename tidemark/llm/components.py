"""Connected components of a distributed edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import Workspace, files


def stars(edges: DataFrame, ws: Workspace, most: int | None = None) -> DataFrame:
    """node, root (the smallest node reachable) for every node that is not its own root; columns of ``edges``: a, b (long).

    Alternates large-star and small-star steps until nothing changes, so the number of rounds grows with the logarithm of
    the longest path. Every round is written to the shared folder: a lost executor repeats one round at most. Neighbour lists
    are never gathered in one row: a step is a minimum over the edges of a node, which Spark sorts and spills, and a round takes three shuffles.
    A round never has more edges than the one before and is written to as many files as those fill; ``most``: files of the first.
    """
    now = ws.write(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges", most)
    least = F.min("v").over(Window.partitionBy("u"))
    before = None
    while True:
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or state[0] == 0:
            break
        before = state
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.withColumn("m", F.least("u", least)).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # repeated edges are told apart where the edges of their node are
        small = large.repartition("u").distinct().withColumn("m", least)
        now = ws.write(small.select(F.when(F.col("v") != F.col("m"), F.col("v")).otherwise(F.col("u")).alias("u"), F.col("m").alias("v")).distinct(), "edges", files(state[0]))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
