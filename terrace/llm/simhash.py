"""SimHash near-dedup: 64-bit fingerprints, joined with themselves by walking a binary trie.

Two documents are linked if their fingerprints differ in at most ``budget`` bits. The walk starts
at pairs of trie nodes, adds up the bits in which the two sides differ, and leaves a pair as soon
as the budget is exceeded. To share it among tasks, the bits are cut into ``budget + 1`` blocks or more: two
linked fingerprints agree in all blocks but ``budget`` at least, so each choice of that many blocks in turn becomes the top of the trie,
and the subtries below one value of it are walked by one task. More blocks make longer tops, for more fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm.components import components
from terrace.llm.rows import aside
from terrace.staging import stage

BITS = 64
SHINGLE = 3
BUDGET = 3
SEED = 42
#: Fingerprints below one value of a top that are walked together; more are walked in pairs of chunks.
CHUNK = 20_000
#: Values of tops that are broadcast, if all were hot; with more of them Spark decides by their size.
MOST_BROADCAST = 1 << 18
#: Rows per walking task, and pairs of trie nodes that a task holds at a time.
ROWS_PER_TASK = 60_000
PAIRS_AT_ONCE = 1 << 19


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """Bit i is set if it is set in more than half of the hashes of all shingles, repeats included."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        parts = [b" ".join(words)]
    else:
        parts = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    n = max(1, len(words) - shingle + 1)
    hashes = np.fromiter((xxhash.xxh64_intdigest(x, SEED) for x in parts), np.uint64, n)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, 1 << 15):
        some = hashes[at : at + (1 << 15)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(some, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def with_fingerprint(docs: DataFrame, name: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and the fingerprint as a signed long of the same bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.array(prints, np.uint64).view(np.int64))], names=["doc_id", name]
            )

    # bytes.lower() and bytes.split() are exactly the contract: A-Z only, and the six blanks.
    source = docs.select(F.col(id).cast("bigint").alias("doc_id"), F.col(text).cast("binary").alias("_text"))
    return source.mapInArrow(run, f"doc_id bigint, {name} bigint")


def tops(blocks: int, budget: int = BUDGET) -> tuple[list[list[tuple[int, int, int]]], int]:
    """The orders of the bits that are walked, and how many bits at the top are the same in all fingerprints of a subtrie.

    An order is a list of moves of a block: its lowest bit, its size, and its lowest bit in the trie.
    """
    sizes = [BITS // blocks + (i < BITS % blocks) for i in range(blocks)]
    lows = [BITS - sum(sizes[: i + 1]) for i in range(blocks)]
    orders = []
    for chosen in combinations(range(blocks), blocks - budget):
        moves, to = [], BITS
        for block in (*chosen, *(i for i in range(blocks) if i not in chosen)):
            to -= sizes[block]
            moves.append((lows[block], sizes[block], to))
        orders.append(moves)
    return orders, sum(sizes[budget:])


def blocks_for(rows: int, budget: int = BUDGET) -> int:
    """As few blocks as leave a quarter of :data:`CHUNK` rows, on the average, below a value of the top; ``budget + 3`` at most."""
    able = (n for n in (budget + 1, budget + 2) if rows <= CHUNK * 2 ** tops(n, budget)[1] // 4)
    return next(able, budget + 3)


def links(prints: DataFrame, budget: int = BUDGET, blocks: int | None = None) -> DataFrame:
    """Edges between distinct fingerprints (column ``fp``) that connect all linked ones.

    Of the links that one task finds, only a spanning star per component is returned: at most one
    edge per row, instead of all pairs of a large group of near copies. Fingerprints travel once per top: with a budget of
    three, 4 times under tops of 16 bits, 10 times under 25 bits beyond 3 x 10^8 of them, 20 times under 31 bits beyond 10^11.
    Values of a top that more than :data:`CHUNK` fingerprints share in spite of that are walked in pairs of chunks.
    """
    count = prints.count()
    orders, width = tops(blocks or blocks_for(count, budget), budget)
    turned = F.explode(F.array(*(F.struct(F.lit(i).alias("shift"), _moved(F.col("fp"), moves).alias("key")) for i, moves in enumerate(orders))))
    keyed = prints.select(turned.alias("_b")).select("_b.*").withColumn("top", F.shiftrightunsigned("key", BITS - width))
    # Spark broadcasts them if they are few: of 16-bit tops there are 262,144 at most.
    hot = keyed.groupBy("shift", "top").count().where(F.col("count") > CHUNK)
    chunks = F.ceil(F.col("count") / CHUNK).cast("int")
    hot = hot.select("shift", "top", chunks.alias("chunks"))
    hot = F.broadcast(hot) if len(orders) << width <= MOST_BROADCAST else hot
    own = F.pmod(F.xxhash64("key"), F.coalesce("chunks", F.lit(1))).cast("int")
    dealt = (
        keyed.join(hot, ["shift", "top"], "left")
        .withColumn("chunk", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.coalesce("chunks", F.lit(1)) - 1)))
        .select("shift", "top", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"), "chunk", "key")
    )
    tasks = max(1, -(-len(orders) * count // ROWS_PER_TASK))
    group = ["shift", "top", "low", "high"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in _whole_groups(batches):
            a, b = _walk(*columns, orders, width, budget)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    sorted_rows = dealt.repartition(tasks, *group).sortWithinPartitions(*group, "chunk")
    return sorted_rows.mapInArrow(run, "a bigint, b bigint")


def near_duplicates(prints: DataFrame, budget: int = BUDGET) -> DataFrame:
    """``fp``, ``root`` (one fingerprint of the component) and ``component_id`` (smallest id reachable).

    ``prints`` is a written table of ``doc_id`` and ``fp``. Copies are combined to one row per
    fingerprint first. Fingerprints whose documents have no id at all get a NULL component.
    """
    distinct = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "prints")
    roots = components(links(distinct, budget))
    rooted = distinct.join(roots, distinct.fp == roots.node, "left").select(
        "fp", "least_id", F.coalesce("root", "fp").alias("root")
    )
    rooted = stage(rooted, "rooted")
    ids = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    return rooted.join(ids, "root").select("fp", "root", "component_id")


def grouped(docs: DataFrame, shingle_budget: int = BUDGET) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits), ``component_id``; one row per input row.

    NULL, empty and blank texts have fingerprint zero and are linked like any other. Equal rows
    get equal results.
    """
    prints = stage(with_fingerprint(docs, "fp"), "documents")
    found = near_duplicates(prints, shingle_budget)
    return prints.join(found, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame, budget: int = BUDGET) -> DataFrame:
    """``docs`` with one document per component: that of the smallest id, NULL ids last.

    If rows share that id, the one with the smallest fingerprint, then row hash, stays; of
    equal rows one.
    """
    # Rows meet by hashes of the whole row, so equal rows meet and no id, NULL or hot, is a shuffle key.
    keyed = aside(docs, doc_id=F.col("doc_id").cast("bigint"), text="text").withColumns(
        {"_key": F.xxhash64("_row"), "_check": F.crc32(F.coalesce("text", F.lit("")))}
    )
    prints = stage(_with_key(keyed), "documents")
    found = near_duplicates(prints.select("doc_id", "fp"), budget).select("fp", "root")
    best = F.min_by(F.struct("_key", "_check"), F.struct(F.col("doc_id").isNull(), "doc_id", "fp", "_key"))
    kept = prints.join(found, "fp").groupBy("root").agg(best.alias("best")).select("best.*")
    kept = stage(kept, "kept")
    return keyed.join(kept, ["_key", "_check"], "left_semi").dropDuplicates(["_key", "_check"]).select("_row.*")


def _with_key(keyed: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t.as_py()) for t in batch.column(3)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(prints)], names=["doc_id", "_key", "_check", "fp"]
            )

    source = keyed.select("doc_id", "_key", "_check", F.col("text").cast("binary").alias("_text"))
    return source.mapInArrow(run, "doc_id bigint, _key bigint, _check bigint, fp bigint")


def _moved(fp, moves: list[tuple[int, int, int]]):
    parts = (F.shiftleft(F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << size) - 1)), to) for low, size, to in moves)
    return reduce(lambda a, b: a.bitwiseOR(b), parts)


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """Columns of the sorted rows, cut between groups, each with at least one group and not many more rows than a group."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= 4 * CHUNK:
            columns = _columns(held)
            last = np.all([c[:-1] == c[1:] for c in columns[:4]], axis=0)
            cut = len(last) - int(np.argmin(last[::-1])) if not last.all() else 0
            if cut:
                yield tuple(c[:cut] for c in columns)
                held = [pa.RecordBatch.from_arrays([pa.array(c[cut:]) for c in columns], names=held[0].schema.names)]
                size = held[0].num_rows
    if size:
        yield _columns(held)


def _columns(held: list[pa.RecordBatch]) -> tuple[np.ndarray, ...]:
    table = pa.Table.from_batches([b.cast(held[0].schema) for b in held])
    return tuple(c.to_numpy() for c in table.columns)


def _walk(shift, top, low, high, chunk, key, orders: list, width: int, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Walk the tries of all groups at once; returns edges between fingerprints."""
    keys = key.view(np.uint64)
    order = np.lexsort((keys, chunk, high, low, top, shift))
    shift, top, low, high, chunk, keys = (c[order] for c in (shift, top, low, high, chunk, keys))
    new_group = _changes(shift, top, low, high)
    starts = np.flatnonzero(new_group | _changes(chunk))
    ends = np.append(starts[1:], len(keys))
    # The root nodes: a chunk with itself, or the two chunks of a group with each other.
    alone = low[starts] == high[starts]
    group_of = np.cumsum(new_group)[starts]
    both = np.flatnonzero(~alone[:-1] & ~alone[1:] & (group_of[:-1] == group_of[1:]))
    a = np.concatenate([np.flatnonzero(alone), both])
    b = np.concatenate([np.flatnonzero(alone), both + 1])
    pairs = np.stack([starts[a], ends[a], starts[b], ends[b], np.zeros(len(a), np.int64)])
    labels = np.arange(len(keys))
    ones: dict[int, np.ndarray] = {}
    stack = [(BITS - width - 1, pairs[:, i : i + PAIRS_AT_ONCE]) for i in range(0, pairs.shape[1], PAIRS_AT_ONCE)]
    while stack:
        bit, pairs = stack.pop()
        pairs = _leaves_out(pairs, keys, labels, budget)
        if not pairs.shape[1]:
            continue
        if bit not in ones:
            ones[bit] = np.append(0, np.cumsum((keys >> np.uint64(bit)) & np.uint64(1), dtype=np.int32))
        below = _children(pairs, ones[bit], budget)
        stack += [(bit - 1, below[:, i : i + PAIRS_AT_ONCE]) for i in range(0, below.shape[1], PAIRS_AT_ONCE)]
    linked = np.flatnonzero(labels != np.arange(len(keys)))
    prints = np.zeros(len(keys), np.uint64)
    for number in np.unique(shift):
        own = shift == number
        for from_, size, to in orders[number]:
            prints[own] |= ((keys[own] >> np.uint64(to)) & np.uint64((1 << size) - 1)) << np.uint64(from_)
    prints = prints.view(np.int64)
    return prints[linked], prints[labels[linked]]


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Whether a row differs from the one before in any of the columns."""
    return np.append(True, np.any([c[1:] != c[:-1] for c in columns], axis=0))


def _children(pairs: np.ndarray, ones: np.ndarray, budget: int) -> np.ndarray:
    """The pairs one bit further down that are within the budget. A node is a run of sorted keys."""
    a0, a9, b0, b9, bits = pairs
    a5, b5 = a9 - (ones[a9] - ones[a0]), b9 - (ones[b9] - ones[b0])
    itself = a0 == b0
    crossed = bits + 1
    below = np.concatenate(
        [
            np.stack([a0, a5, b0, b5, bits]),
            np.stack([a5, a9, b5, b9, bits]),
            np.stack([a0, a5, b5, b9, crossed]),
            np.stack([a5, a9, b0, b5, crossed])[:, ~itself],
        ],
        axis=1,
    )
    a, b = below[1] - below[0], below[3] - below[2]
    return below[:, (a > 0) & (b > 0) & (below[4] <= budget) & ~((below[0] == below[2]) & (a == 1))]


def _leaves_out(pairs: np.ndarray, keys: np.ndarray, labels: np.ndarray, budget: int) -> np.ndarray:
    """Decide the pairs of single keys, join the labels of linked ones, and return the other pairs."""
    single = (pairs[1] - pairs[0] == 1) & (pairs[3] - pairs[2] == 1)
    a, b = pairs[0, single], pairs[2, single]
    near = (a != b) & (np.bitwise_count(keys[a] ^ keys[b]) <= budget)
    a, b = a[near], b[near]
    while len(a):
        la, lb = labels[a], labels[b]
        open_ = la != lb
        a, b, la, lb = a[open_], b[open_], la[open_], lb[open_]
        least = np.minimum(la, lb)
        np.minimum.at(labels, la, least)
        np.minimum.at(labels, lb, least)
        while len(a) and (labels[labels] != labels).any():
            labels[:] = labels[labels]
    return pairs[:, ~single]
