"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.staging import stage

#: Nodes with more than this share of all ends of edges have their rows dealt to all tasks; there are fewer than 64.
HOT_SHARE = 1 / 64


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``root`` (the smallest node reachable) of every node with an edge to another one.

    Alternating stars: each node hands its larger neighbours, then its smaller ones, to the
    smallest node in sight, until every edge ends in a root. The number of rounds grows with the
    logarithm of a component's size. Each round writes its edges to the shared folder, so a lost
    executor repeats one round at most. Minima are combined before each shuffle, and the rows of a
    node with many edges, such as the centre of a star, are dealt by a hash of their other ends.
    """
    pairs = edges.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).where("hi > lo").distinct()
    current, before = stage(pairs, "edges"), None
    while (state := _state(current)) != before:
        before, hot = state, _hot(current, state[0])
        current = stage(_to_smallest(_to_smallest(current, hot, larger=True), hot, larger=False).distinct(), "edges")
    return current.select(F.col("hi").alias("node"), F.col("lo").alias("root"))


def _hot(edges: DataFrame, n: int) -> list[int]:
    """Nodes at more than ``HOT_SHARE`` of the ends of all ``n`` edges, so fewer than its inverse."""
    ends = edges.select(F.explode(F.array("hi", "lo")).alias("node"))
    return [r.node for r in ends.groupBy("node").count().where(F.col("count") > HOT_SHARE * 2 * n).collect()]


def _to_smallest(edges: DataFrame, hot: list[int], larger: bool) -> DataFrame:
    """Move the larger (or else the smaller) neighbours of each node to the smallest node it sees."""
    seen = edges.select(F.col("hi").alias("node"), F.col("lo").alias("other"))
    if larger:
        seen = seen.union(edges.select("lo", "hi"))
    least = seen.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("least"))
    moved = _joined(seen, least, hot)
    if larger:
        return moved.where("other > node").select(F.col("other").alias("hi"), F.col("least").alias("lo"))
    own = least.select(F.col("node").alias("hi"), F.col("least").alias("lo"))
    return own.union(moved.where("other > least").select(F.col("other").alias("hi"), F.col("least").alias("lo")))


def _joined(seen: DataFrame, least: DataFrame, hot: list[int]) -> DataFrame:
    """Join by node; the rows of hot nodes go to all tasks, and their one row of ``least`` to each."""
    if not hot:
        return seen.join(least, "node")
    slots, is_hot = int(seen.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.col("node").isin(hot)
    every = F.sequence(F.lit(0), F.when(is_hot, slots - 1).otherwise(0))
    dealt = seen.withColumn("slot", F.when(is_hot, F.pmod(F.xxhash64("other"), F.lit(slots)).cast("int")).otherwise(0))
    return dealt.join(least.withColumn("slot", F.explode(every)), ["node", "slot"]).drop("slot")


def _state(edges: DataFrame) -> tuple:
    mixed = F.xxhash64("hi", "lo")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(mixed.bitwiseAND(F.lit(0xFFFFFFFF))), F.sum(F.shiftright(mixed, 32))).first())
