"""Connected components of a graph that no task has to hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from idweave.runtime import Workspace

#: More rounds than any graph that fits a cluster should need.
ROUNDS = 60


def connected(edges: DataFrame, work: Workspace, name: str = "components", rounds: int = ROUNDS) -> DataFrame:
    """``node, component`` (the least node of its component) of all nodes of ``edges``, which has the columns ``a, b`` of
    one type without nulls.

    Large stars and small stars in turn, each a window function that spills, until nothing changes: the number of
    rounds grows with the logarithm of the longest path. Each round is a stored table, of which the last one stays. Raises an error if
    ``rounds`` are not enough; nothing is left out."""
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = work.store(now, f"{name}-0")
    mark = None
    for k in range(1, rounds):
        both = now.union(now.select("b", "a"))
        least = F.least(F.col("a"), F.min("b").over(Window.partitionBy("a")))
        large = both.withColumn("m", least).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        # Here a is the larger end of each edge: its smaller neighbours and itself go to the least of them.
        low = F.min("b").over(Window.partitionBy("a"))
        small = large.withColumn("m", low)
        small = small.select(F.col("b").alias("x"), "m").union(small.select(F.col("a").alias("x"), "m"))
        now = work.store(small.where("x <> m").select(F.col("x").alias("a"), F.col("m").alias("b")).distinct(), f"{name}-{k}")
        work.drop(f"{name}-{k - 1}")
        work.clean()
        last, mark = mark, tuple(now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())
        if mark == last:
            break
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.select("b", "b").distinct())
