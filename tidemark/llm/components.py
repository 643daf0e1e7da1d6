"""Connected components of a link table, by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of ``links``; ``root`` is some node of its component.

    Each round every node moves to its neighbour (or itself) of smallest hash,
    the links are relabelled, and loops and repeats drop out. The hash changes
    by round, so that no order of ids makes long chains: the number of links
    left falls by a constant factor per round on average. Each round is cut
    through the shared checkpoint folder. Rows with a NULL end are ignored.
    """
    ends = links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a IS NOT NULL AND b IS NOT NULL")
    edges = cut(ends.where("a <> b").union(ends.where("a <> b").select("b", "a")).distinct())
    nodes = cut(ends.select(F.explode(F.array("a", "b")).alias("node")).distinct()
                .withColumn("root", F.col("node")))
    turn = 0
    while not edges.isEmpty():
        near = edges.groupBy("a").agg(F.min(F.struct(F.xxhash64("b", F.lit(turn)).alias("h"),
                                                     F.col("b").alias("to"))).alias("best"))
        own = F.struct(F.xxhash64("a", F.lit(turn)).alias("h"), F.col("a").alias("to"))
        move = cut(near.select(F.col("a").alias("_from"), F.least(own, "best")["to"].alias("_to")))
        first = edges.join(move, F.col("a") == F.col("_from")).select(F.col("_to").alias("a"), "b")
        both = first.join(move, F.col("b") == F.col("_from")).select("a", F.col("_to").alias("b"))
        edges = cut(both.where("a <> b").distinct())
        nodes = cut(nodes.join(move, F.col("root") == F.col("_from"), "left")
                    .select("node", F.coalesce("_to", "root").alias("root")))
        turn += 1
    return nodes
