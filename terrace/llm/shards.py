"""Shards of near equal size by Karmarkar-Karp differencing.

A partial partition is a list of shard sizes. Of all partial partitions the two with the largest
spread (largest minus smallest shard) are combined in opposite order, the largest shard of one with
the smallest of the other, until one is left. Documents of equal texts are one indivisible group.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm.rows import text_of
from terrace.operators.keys import rank_in_group
from terrace.staging import stage

SHARDS = 16
#: Groups of more than this part of all bytes, and so fewer than this many, are differenced by one task.
LARGE = 200_000
#: Smaller groups that one task differences, and how many times as many the last one does.
GROUPS, LAST = 25_000, 4


def assigned(docs: DataFrame, shards: int = SHARDS, groups: int = GROUPS, large: int = LARGE) -> DataFrame:
    """``doc_id``, ``size`` (bytes of the text and 1), ``text_crc32``, ``shard``, ``slot`` (gapless from 0 in its shard).

    NULL and empty texts have size 1 and are one group. Equal rows are different rows of one group,
    and get different slots. A group that exceeds the mean shard has a shard to itself, as far as
    the others fill up without it.

    Texts are read twice and never shuffled. Groups are combined on the map side. The large ones,
    fewer than ``large`` by their definition, are differenced by one task. The others are dealt by hash
    into blocks of about ``groups``; each block gets its part of what the large ones put into each shard, as one
    more partial partition, and is differenced by one task, so that the small groups make up for the
    large ones. The last block has :data:`LAST` times as many groups. It is differenced with the sums of all others as a partial
    partition, so the shards lie about as near as if one task had seen all groups. The rows of a large group are the skewed side of a join, which can be split; slots
    are numbered by ranges of rows.
    """
    sized = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("_text")).select(
        "doc_id",
        (F.octet_length("_text") + 1).cast("bigint").alias("size"),
        F.crc32("_text").alias("text_crc32"),
        F.xxhash64("_text").alias("group"),
    )
    weights = stage(sized.groupBy("group").agg(F.sum("size").alias("size")), "groups")
    total = weights.agg(F.sum("size")).first()[0] or 0
    is_large = F.col("size") * large > total
    first = stage(_differenced(_leaves(weights.where(is_large), F.lit(0)), shards), "large")
    held = dict(first.groupBy("shard").agg(F.sum("size")).collect())  # one number per shard
    rest = weights.where(~is_large)
    blocks = max(1, -(-rest.count() // groups))
    early_blocks = max(0, blocks - LAST)
    leaves = _leaves(rest, F.least(F.pmod(F.xxhash64("group"), F.lit(blocks)), F.lit(early_blocks)))
    others = docs.sparkSession.range(early_blocks).select(F.col("id").alias("block"))
    early = leaves.where(F.col("block") < early_blocks).union(_fixed(others, {s: n // blocks for s, n in held.items()}, shards))
    early = stage(_differenced(early, shards), "early")
    placed = dict(early.groupBy("shard").agg(F.sum("size")).collect())
    end = docs.sparkSession.range(1).select(F.lit(early_blocks).cast("bigint").alias("block"))
    late = leaves.where(F.col("block") == early_blocks).union(_fixed(end, {s: held.get(s, 0) + placed.get(s, 0) for s in range(shards)}, shards))
    where = first.union(early).union(stage(_differenced(late, shards), "late")).select("group", "shard")
    return rank_in_group(sized.join(where, "group"), ["shard"], ["group", "doc_id"], "slot").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("slot") - 1).alias("slot")
    )


def _leaves(weights: DataFrame, block: Column) -> DataFrame:
    return weights.select(block.cast("bigint").alias("block"), "group", F.lit(0).alias("label"), "size", F.lit(False).alias("fixed"))


def _fixed(blocks: DataFrame, held: dict[int, int], shards: int) -> DataFrame:
    """One more partial partition for each of the ``blocks``: what the shards themselves hold."""
    rows = F.explode(F.array(*(F.struct(F.lit(s).alias("label"), F.lit(held.get(s, 0)).cast("bigint").alias("size")) for s in range(shards))))
    return blocks.select("block", rows.alias("_p")).select("block", F.lit(0).cast("bigint"), "_p.label", "_p.size", F.lit(True))


def _differenced(parts: DataFrame, shards: int) -> DataFrame:
    """``group``, ``size`` and ``shard`` of each group, differenced per block.

    Fixed rows belong to no group; they are one partial partition whose labels are the shards themselves.
    """

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        small, fixed = rows[~rows["fixed"]].sort_values("group"), rows[rows["fixed"]]
        partials = [[(int(size), 0)] for size in small["size"]]
        if len(fixed):
            partials.append([(int(size), int(label)) for size, label in zip(fixed["size"], fixed["label"])])
        to = differencing(partials, shards)
        shard_at = {place: label for label, place in to.pop().items()} if len(fixed) else {p: p for p in range(shards)}
        found = np.array([shard_at[place[0]] for place in to], np.int32)
        return pd.DataFrame({"group": small["group"].to_numpy(), "size": small["size"].to_numpy(), "shard": found})

    return parts.groupBy("block").applyInPandas(run, "group bigint, size bigint, shard int")


def differencing(partials: list[list[tuple[int, int]]], shards: int) -> list[dict[int, int]]:
    """Shard of each label, per partial partition (pairs of size and label, fewer than shards: the rest is empty)."""
    # A node is a leaf (labels by falling size) or two nodes and the order of their summed shards by falling size.
    nodes: list[tuple] = []
    heap: list[tuple] = []
    for pairs in partials:
        pairs = sorted(pairs, key=lambda p: (-p[0], p[1]))
        sizes = [size for size, _ in pairs] + [0] * (shards - len(pairs))
        heap.append((sizes[-1] - sizes[0], len(nodes), sizes))
        nodes.append(([label for _, label in pairs],))
    heapq.heapify(heap)
    while len(heap) > 1:
        _, a, sizes_a = heapq.heappop(heap)
        _, b, sizes_b = heap[0]
        sums = [x + y for x, y in zip(sizes_a, reversed(sizes_b))]
        order = sorted(range(shards), key=sums.__getitem__, reverse=True)
        sums = [sums[i] for i in order]
        heapq.heapreplace(heap, (sums[-1] - sums[0], len(nodes), sums))
        nodes.append((a, b, order))
    found: list[dict[int, int]] = [{} for _ in partials]
    todo = [(heap[0][1], list(range(shards)))]  # a node, and the final shard of each of its places
    while todo:
        node, final = todo.pop()
        if len(nodes[node]) == 1:
            found[node] = dict(zip(nodes[node][0], final))
            continue
        a, b, order = nodes[node]
        at = [0] * shards
        for place, origin in enumerate(order):
            at[origin] = final[place]
        todo += [(a, at), (b, at[::-1])]
    return found
