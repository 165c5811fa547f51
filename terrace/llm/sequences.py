"""Sum-of-squares packing of documents into sequences of a fixed number of tokens.

An open sequence has a residual gap. A piece goes where, afterwards, the sum over all gaps of the
squared number of open sequences with that gap is smallest, so that no gap piles up. Pieces are placed by falling length, and
a new sequence is begun only for a piece that fits into no open one.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm import tokens
from terrace.llm.rows import text_of
from terrace.staging import stage

CAPACITY = 2048
END = 0
#: Pieces that one task packs.
BLOCK = 100_000
#: Sequences of a block with a larger part empty are packed again with those of the other blocks.
LOOSE = 1 / 32

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def pieces(docs: DataFrame, capacity: int = CAPACITY, ranks: str | None = None) -> DataFrame:
    """The documents' token ids and an end id, cut into pieces of ``capacity``; only the first may be shorter."""
    path = ranks or tokens.ranks_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokens.encoder(path)
        for batch in batches:
            rows: list[tuple] = []
            for id_, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.array([*encode(text.as_py()), END], "<u4")
                cuts = [0, *range(len(ids) % capacity or capacity, len(ids) + 1, capacity)]
                for place, (start, end) in enumerate(zip(cuts, cuts[1:])):
                    rows.append((id_, place, start, end - start, zlib.crc32(ids[start:end].tobytes())))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()])],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("_text")).mapInArrow(run, PIECES)


def packed(docs: DataFrame, capacity: int = CAPACITY, ranks: str | None = None, block: int = BLOCK) -> DataFrame:
    """One row per piece: :data:`PIECES`, ``sequence_id``, ``offset``.

    A NULL text counts as empty: its one piece is the end id. Equal rows are packed like different
    ones. Only lengths travel: the pieces are written without their ids, dealt evenly into blocks
    of ``block`` pieces at most, and each block is packed by one task. What lies in sequences that a block leaves
    part empty is dealt into blocks again, until one block holds it. A task sorts its pieces by length and
    hash, so a repeated task packs them the same way.
    """
    left, found, level, before = stage(pieces(docs, capacity, ranks), "pieces"), [], 0, None
    while True:
        n = left.count()
        # What does not get fewer is packed for good.
        last = n <= block or before is not None and 2 * n > before
        made = left.repartition(max(1, -(-n // block))).mapInArrow(_packed_blocks(capacity, level, last), f"{PIECES}, sequence_id bigint, offset bigint, loose boolean")
        if last:
            return reduce(DataFrame.unionAll, [*found, made.drop("loose")])
        made = stage(made, "packed")
        found.append(made.where("not loose").drop("loose"))
        left, level, before = made.where("loose").select(*left.columns), level + 1, n


def _packed_blocks(capacity: int, level: int, last: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held).combine_chunks()
        length, crc = (table.column(c).to_numpy() for c in ("length", "ids_crc32"))
        ids = table.column("doc_id").fill_null(-1).to_numpy()
        order = np.lexsort((table.column("piece").to_numpy(), ids, crc))
        sequence, offset = pack(length[order], capacity)
        gap = capacity - np.bincount(sequence, length[order])
        loose = np.zeros(len(order), bool) if last else (gap > LOOSE * capacity)[sequence]
        first = level << 56 | TaskContext.get().partitionId() << 32
        table = table.take(order).append_column("sequence_id", pa.array(sequence + first)).append_column("offset", pa.array(offset))
        yield from table.append_column("loose", pa.array(loose)).to_batches(max_chunksize=10_000)

    return run


def pack(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each piece. Pieces of equal length are placed in the given order."""
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for number, members in enumerate(_place(lengths, np.argsort(-lengths, kind="stable"), capacity)):
        at = 0
        for i in members:
            sequence[i], offset[i] = number, at
            at += int(lengths[i])
    return sequence, offset


def _place(lengths: np.ndarray, order, capacity: int) -> list[list[int]]:
    counts = np.zeros(capacity + 1, np.int64)  # open sequences by gap
    open_: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins: list[list[int]] = []
    never = np.iinfo(np.int64).max
    for i in order:
        size = int(lengths[i])
        before, after = counts[size:], counts[: capacity - size + 1]
        # Moving a sequence from gap g to g - size changes the sum by 2 (n[g - size] - n[g] + 1); one that is full has no gap.
        change = 2 * (after - before + 1)
        change[0] = 1 - 2 * before[0]
        change = np.where(before > 0, change, never)
        gap = int(change.argmin())
        if before[gap]:
            number = open_[size + gap].pop()
            counts[size + gap] -= 1
            bins[number].append(i)
        else:
            number, gap = len(bins), capacity - size
            bins.append([i])
        if gap:
            counts[gap] += 1
            open_[gap].append(number)
    return bins
