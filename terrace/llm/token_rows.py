"""Packed token-id rows: best-fit-decreasing, with a segment tree over free capacities.

A document longer than a row is cut into whole rows and a rest, without loss; rests and short documents
are placed by falling length, each into the open row whose free space is smallest but enough.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm import tokens
from terrace.llm.rows import text_of

ROW_TOKENS = 2048
END = 0
#: Tokens that a task packs at a time. Rests of one block are packed among themselves, so each block may leave one row part empty.
BLOCK_TOKENS = 1 << 23

SCHEMA = (
    "row_id bigint, ids binary, n_tokens int, segment_ends array<int>, position_ids binary, doc_ids array<bigint>, starts array<bigint>"
)


def rows(docs: DataFrame, row_tokens: int = ROW_TOKENS, ranks: str | None = None, block: int = BLOCK_TOKENS) -> DataFrame:
    """One row of ``row_tokens`` ids per output row (:data:`SCHEMA`).

    ``ids`` is a row of the id matrix: little-endian unsigned 16-bit numbers, filled up with the end id.
    ``segment_ends`` are the cumulative lengths of its segments, starting with 0, ``doc_ids`` and
    ``starts`` say what each segment holds (``starts``: ids of that document before it), and
    ``position_ids`` (little-endian unsigned 32-bit) restart at 0 with each segment, the filling included.
    Each document is followed by the end id; a NULL text counts as empty and is its end id alone.
    Equal rows are packed like different ones. ``row_id`` is any number.

    One pass without a shuffle: each task packs blocks of consecutive documents of its part of the
    scan, so it holds one block and the ids of one document, and a repeated task repeats its rows.
    """
    path = ranks or tokens.ranks_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokens.encoder(path)
        first = TaskContext.get().partitionId() << 32
        held: list[tuple[int | None, int, np.ndarray]] = []
        size = 0
        for batch in batches:
            for id_, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.array([*encode(text.as_py()), END], "<u2")
                held += [(id_, at, ids[at : at + row_tokens]) for at in range(0, len(ids), row_tokens)]
                size += len(ids)
                if size >= block:
                    for out in _batches(held, row_tokens, first):
                        first += out.num_rows
                        yield out
                    held, size = [], 0
        yield from _batches(held, row_tokens, first)

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("_text")).mapInArrow(run, SCHEMA)


def write(packed: DataFrame, path: str) -> None:
    """Write the rows as Parquet; ``ids`` of a file, one after the other, are a matrix of ids."""
    packed.write.parquet(path)


class FreeSpace:
    """A segment tree over free capacities: the smallest one that is enough, in logarithmic time."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.open: list[list[int]] = [[] for _ in range(self.leaves)]
        self.count = [0] * (2 * self.leaves)

    def add(self, free: int, row: int) -> None:
        self.open[free].append(row)
        self._change(free, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """The row with the smallest free space of at least ``need``, and that space."""
        at = need + self.leaves
        if not self.count[at]:
            # Up to the first right neighbour that has something, then down to its left-most leaf.
            while at > 1 and (at & 1 or not self.count[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.leaves:
                at = 2 * at if self.count[2 * at] else 2 * at + 1
        free = at - self.leaves
        self._change(free, -1)
        return self.open[free].pop(), free

    def _change(self, free: int, by: int) -> None:
        at = free + self.leaves
        while at:
            self.count[at] += by
            at >>= 1


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Places of ``lengths`` by row."""
    space, found = FreeSpace(capacity), []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        row = space.take(lengths[i])
        if row is None:
            row = (len(found), capacity)
            found.append([])
        found[row[0]].append(i)
        if row[1] > lengths[i]:
            space.add(row[1] - lengths[i], row[0])
    return found


def _batches(held: list, row_tokens: int, first: int) -> Iterator[pa.RecordBatch]:
    packed = best_fit([len(ids) for _, _, ids in held], row_tokens)
    count = np.arange(row_tokens, dtype="<u4")
    for at in range(0, len(packed), 512):
        columns: list[list] = [[] for _ in _ARROW]
        for number, members in enumerate(packed[at : at + 512]):
            ends = np.cumsum([0, *(len(held[i][2]) for i in members)], dtype=np.int32)
            ids = np.full(row_tokens, END, "<u2")
            ids[: ends[-1]] = np.concatenate([held[i][2] for i in members])
            restart = np.zeros(row_tokens, "<u4")
            restart[ends[ends < row_tokens]] = ends[ends < row_tokens]
            positions = count - np.maximum.accumulate(restart)
            row = (first + at + number, ids.tobytes(), int(ends[-1]), ends, positions.astype("<u4").tobytes(), [held[i][0] for i in members], [held[i][1] for i in members])
            for column, value in zip(columns, row):
                column.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW)


_ARROW = pa.schema(
    [
        ("row_id", pa.int64()),
        ("ids", pa.binary()),
        ("n_tokens", pa.int32()),
        ("segment_ends", pa.list_(pa.int32())),
        ("position_ids", pa.binary()),
        ("doc_ids", pa.list_(pa.int64())),
        ("starts", pa.list_(pa.int64())),
    ]
)
