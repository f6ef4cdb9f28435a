"""Connected components of a table of links."""

from pyspark.sql import functions as F

from deskpulse.llm.common import checkpointed


def _directed(edges):
    turned = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    return edges.select("a", "b").union(turned)


def _with_least(edges):
    """Edges with the least node met at their first end.

    The least nodes are dealt out anew before the join, so that both its sides are
    shuffled for it alone and a node with very many links can be split.
    """
    least = edges.groupBy("a").agg(F.min("b").alias("low"))
    least = least.select("a", F.least("a", "low").alias("low"))
    parts = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return edges.join(least.repartition(parts), "a")


def components(edges):
    """(node, root) for every node of the links (a, b); root is the least node reachable.

    Links are turned into stars round by round: every node hangs its larger, then its
    smaller neighbours on the least of them, until nothing moves. Each round ends in a
    checkpoint. A table without links gives no rows.
    """
    edges = checkpointed(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where("a <> b")
        .distinct()
    )
    before = None
    while True:
        large = (
            _with_least(_directed(edges))
            .where("b > a")
            .select(F.col("b").alias("a"), F.col("low").alias("b"))
            .where("a <> b")
            .distinct()
        )
        small = _with_least(large).select("a", "b", "low")
        small = (
            small.select(F.col("b").alias("a"), F.col("low").alias("b"))
            .union(small.select("a", F.col("low").alias("b")))
            .where("a <> b")
            .distinct()
        )
        edges = checkpointed(small)
        state = edges.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if state == before:
            break
        before = state
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
