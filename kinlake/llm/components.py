"""Connected components of a table of links, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise

ROUNDS = 60


def _star(edges: DataFrame, large: bool) -> DataFrame:
    if large:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    # dealt anew and evenly, so that the join below has exchanges of its own and may split a node with very many links
    least = least.repartition(int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    linked = both.join(least, "a")
    if large:
        out = linked.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = linked.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node that has a link; root is the smallest node reachable.

    edges: (a, b) of one orderable type, in any direction, repeats and loops allowed. Each round is a table in the
    shared folder; a node's links meet as a minimum, which is combined before the shuffle. Stops when a round
    changes nothing; after ROUNDS rounds it raises rather than return half-merged groups.
    """
    now = materialise(edges.select("a", "b").where("a <> b").distinct(), "links")
    seen = None
    for _ in range(ROUNDS):
        now = materialise(_star(_star(now, True), False), "links")
        mark = now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen:
            roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
            return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
        seen = mark
    raise RuntimeError(f"components: not settled after {ROUNDS} rounds")
