"""Connected components of links between numbered things, as Spark jobs.

Large-star and small-star steps alternate.  A node with many neighbours is
met by several tasks: its smallest neighbour is taken by salt first, then over
the salts, and the join back is by node and salt.  Every round is landed in
the shared folder and the one before it is removed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafstat.llm.common import landed, landed_so_far, release, with_group_value


def _star(pairs: DataFrame, large: bool) -> DataFrame:
    ways = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else pairs
    met = with_group_value(ways, ["a"], "b", F.min("b"), F.min, "m").withColumn("m", F.least("m", "a"))
    if large:
        out = met.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = met.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            met.select("a", F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b): root is the smallest node of its component.

    The steps end when the edges do not change any more, which their count
    and the sum of their hashes tell; they always do, in rounds that grow with
    the logarithm of the nodes.  Edges may repeat and may link a node to itself;
    a node whose only edge is such a loop has no row.
    """
    spark = edges.sparkSession
    down = F.struct(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = landed(edges.where("a <> b").select(down.alias("e")).select("e.*").distinct(), "edges")
    state = None
    while True:
        sums = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if sums == state:
            break
        state, mark = sums, landed_so_far() - 1
        now = landed(_star(_star(now, True), False), "edges")
        release(spark, mark, keep=1)
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
