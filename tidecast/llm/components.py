"""Connected components by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of ``edges``; nodes are longs.

    In a round each node joins the neighbour (or itself) of the smallest hash, and
    edges are redrawn between what the nodes joined. Hashes keep long chains from
    shrinking by one link a round, so rounds grow with the logarithm. Roots are
    arbitrary members of their component.
    """
    pairs = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where(F.col("u") != F.col("v"))
    both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    left = written(both.distinct(), "links")
    members = left.select(F.col("u").alias("node")).distinct().withColumn("root", F.col("node"))
    turn = 0
    while not left.isEmpty():
        turn += 1
        order = lambda c: F.struct(F.xxhash64(F.lit(turn), c).alias("h"), F.col(c).alias("n"))
        joins = left.groupBy("u").agg(F.min(order("v")).alias("m"))
        joins = written(
            joins.select(
                F.col("u").alias("from"), F.least(F.col("m"), order("u"))["n"].alias("to")
            ),
            "joins",
        )
        members = members.join(joins, F.col("root") == F.col("from"), "left").select(
            "node", F.coalesce("to", "root").alias("root")
        )
        members = written(members, "members")
        one = left.join(joins, F.col("u") == F.col("from")).select(F.col("to").alias("u"), "v")
        two = one.join(joins, F.col("v") == F.col("from")).select("u", F.col("to").alias("v"))
        left = written(two.where(F.col("u") != F.col("v")).distinct(), "links")
    return members
