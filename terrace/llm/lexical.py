"""Ranked lexical search over bit-sliced Bloom signatures.

A signature is a Bloom filter of a document's terms, one entry per term and level of occurrences. Signatures of
documents of similar size are stored as slices: one bitmap over the documents for each bit. The slices of a
term's bits, and-ed, are a bitmap of the documents that may hold it so often; they overestimate only. The sum of
the bitmaps of an item's terms, by weight and by the most that the level is worth in a document of that length,
is an upper bound of each document's score. Documents whose bound is below a score that is known to be reached
often enough are excluded; all others are scored from their texts.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.llm.jaccard import mixed
from terrace.staging import stage

#: Bits and hash functions of an entry: one absent entry in 50,000 at most looks present.
ENTRY_BITS, HASHES = 24, 10
#: Occurrences at which a level begins: 1, 2, 3, 4, 6, 8, 12, ..., more than a text can hold.
LEVELS = np.array(sorted([1, *(1 << i for i in range(1, 33)), *(3 << i for i in range(32))]))
#: Size of the slices of one block of documents, and its most documents.
BLOCK_BYTES, BLOCK_DOCS = 1 << 20, 4096
#: Documents per item whose scores give the bound that others have to reach.
PROBES = 400
#: Terms of items that are broadcast at a time. More items are taken in several batches.
BATCH_TERMS = 200_000
_WANTED_BITS = 22
_FLUSH = 200_000
_SEED = 42
_STEP = 0x9E3779B97F4A7C15
_SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))

_INDEX = "width int, keys array<bigint>, lengths array<bigint>, slices binary, term string, df bigint, n_docs bigint, n_terms bigint"
_SCHEMA = pa.schema(
    [("width", pa.int32()), ("keys", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("slices", pa.binary()),
     ("term", pa.string()), ("df", pa.int64()), ("n_docs", pa.int64()), ("n_terms", pa.int64())]
)


def terms_of(text: bytes | None) -> list[bytes]:
    """All terms in order: runs of digits, letters and whatever is not ASCII; only A-Z lower-cased."""
    return (text or b"").translate(_LOWER).split()


def ranked(
    docs: DataFrame, items: DataFrame, top: int = 50, id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
    batch_terms: int = BATCH_TERMS, probes: int = PROBES,
) -> DataFrame:
    """``item_id``, ``rank`` (from 1), ``doc_id``, ``score``: the ``top`` best documents of each item with a score above 0.

    Equal scores are ordered by id, NULL last. Repeated rows of ``docs`` are ranked as different documents, and repeated rows of
    ``items`` are one item; rows of one item id with different texts are ranked apart. Items and documents
    without terms, and NULL texts, find nothing and are not found, and count in no statistic.

    The index covers every document and all terms, is as exact for long texts as for short ones (a block's bits follow the size of its documents), and
    is written once. Two passes over it per batch of items: the first finds the best bounds, whose documents are
    scored; the second returns what reaches the ``top``-th best of these scores. A table of 4 MB tells which
    terms any item may use, so only their counts are shuffled, by term. Texts are read for the index, and for what is scored.
    """
    spark = docs.sparkSession
    given = items.select(F.col(item_id).cast("bigint").alias("item_id"), F.col(item_text).alias("text")).distinct()
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    split = F.filter(F.split(F.translate("text", upper, upper.lower()), _SEPARATORS), lambda t: t != "")
    queries = stage(given.select(F.monotonically_increasing_id().alias("item"), "item_id", F.array_distinct(split).alias("terms")), "items")
    asked = queries.select("item", F.explode("terms").alias("term"))
    source = docs.select(F.col(id).cast("bigint").alias("doc_id"), F.xxhash64(text).alias("key"), F.col(text).cast("binary").alias("text"))
    index = stage(source.mapInArrow(_indexed(spark.sparkContext.broadcast(_wanted(asked))), _INDEX), "signatures")

    n_docs, n_terms = index.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    df = index.where("term is not null").groupBy("term").agg(F.sum("df").alias("df"))
    rarity = (F.lit(2 * (n_docs or 0) + 2) / (2 * F.col("df") + 1)).cast("double")
    weighted = asked.join(df, "term").select("item", "term", F.floor(F.log(rarity) * 1000).cast("bigint").alias("weight"))
    batches = max(1, -(-asked.count() // batch_terms))
    weighted = stage(weighted.withColumn("batch", F.pmod(F.xxhash64("item"), F.lit(batches))), "weights")
    blocks = index.where("slices is not null").select("width", "keys", "lengths", "slices")
    found = [_best(source, blocks, weighted.where(F.col("batch") == b), n_docs or 0, n_terms or 1, top, probes) for b in range(batches)]
    return reduce(DataFrame.unionAll, found).join(queries.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def _wanted(asked: DataFrame) -> np.ndarray:
    """Cells of the hashes of all terms of items: a fixed number, whatever the items."""
    cells = asked.select(F.shiftrightunsigned(F.xxhash64("term"), 64 - _WANTED_BITS).cast("int").alias("cell")).distinct()
    found = np.zeros(1 << _WANTED_BITS, bool)
    found[np.array([r.cell for r in cells.collect()], np.int64)] = True
    return found


def entries(counts: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Hashes of a document's entries: of each term, one per level that its occurrences reach."""
    levels = np.searchsorted(LEVELS, counts, "right")
    return np.concatenate([entry(hashes[levels > level], level) for level in range(int(levels.max(initial=0)))])


def entry(hashes: np.ndarray, level: int) -> np.ndarray:
    return mixed(hashes + np.uint64(level * _STEP % 2**64))


def places(entries: np.ndarray, width: int) -> np.ndarray:
    """The bits of each entry in a signature of so many bits: entries times :data:`HASHES`."""
    first, step = entries % np.uint64(width), (entries >> np.uint64(32)) % np.uint64(width - 1) + np.uint64(1)
    return ((first[:, None] + step[:, None] * np.arange(HASHES, dtype=np.uint64)) % np.uint64(width)).astype(np.int64)


def width_of(n: int) -> int:
    """Bits for ``n`` entries: steps of a quarter, so that documents of similar size share a block."""
    step = max(0, math.ceil(math.log(max(n, 1) / 16, 1.25)))
    return ENTRY_BITS * max(n, math.ceil(16 * 1.25**step))


def _indexed(wanted):
    """Blocks of slices; for terms that items may use, in how many documents they are; and the numbers of documents and terms."""

    def block(width: int, docs: list) -> pa.RecordBatch:
        bits = np.zeros((width, len(docs)), bool)
        for at, (_, _, hashes) in enumerate(docs):
            bits[places(hashes, width).reshape(-1), at] = True
        row = {"width": width, "keys": [d[0] for d in docs], "lengths": [d[1] for d in docs], "slices": np.packbits(bits, axis=1).tobytes()}
        return _row(row)

    def counted(df: Counter) -> pa.RecordBatch:
        terms = pa.array([t.decode() for t in df], pa.string())
        none = [pa.nulls(len(df), f.type) for f in _SCHEMA]
        none[4:6] = [terms, pa.array(df.values(), pa.int64())]
        return pa.RecordBatch.from_arrays(none, schema=_SCHEMA)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: dict[int, list] = {}
        df: Counter = Counter()
        n_docs = n_terms = 0
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                terms = terms_of(text.as_py())
                if not terms:
                    continue
                n_docs, n_terms = n_docs + 1, n_terms + len(terms)
                counts = Counter(terms)
                hashes = np.fromiter((xxhash.xxh64_intdigest(t, _SEED) for t in counts), np.uint64, len(counts))
                own = wanted.value[(hashes >> np.uint64(64 - _WANTED_BITS)).astype(np.int64)]
                if own.any():
                    df.update(t for t, is_own in zip(counts, own.tolist()) if is_own)
                    if len(df) > _FLUSH:
                        yield counted(df)
                        df.clear()
                held = entries(np.fromiter(counts.values(), np.int64, len(counts)), hashes)
                width = width_of(len(held))
                docs = open_.setdefault(width, [])
                docs.append((key, len(terms), held))
                if len(docs) >= max(8, min(BLOCK_DOCS, BLOCK_BYTES * 8 // width)):
                    yield block(width, open_.pop(width))
        for width, docs in open_.items():
            yield block(width, docs)
        if n_docs:
            yield counted(df)
            yield _row({"n_docs": n_docs, "n_terms": n_terms})

    return lambda batches: run(b.select(["key", "text"]) for b in batches)


def _row(values: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([{f.name: values.get(f.name) for f in _SCHEMA}], schema=_SCHEMA)


class Queries:
    """Items of one batch: their terms' hashes and weights, for the index, and by term, for texts."""

    def __init__(self, rows: list[tuple[int, str, int]], n_docs: int, n_terms: int):
        self.n_docs, self.n_terms = n_docs, n_terms
        self.weights: dict[int, dict[bytes, int]] = {}
        for item, term, weight in rows:
            self.weights.setdefault(item, {})[term.encode()] = weight
        terms = sorted({t for own in self.weights.values() for t in own})
        at = {t: i for i, t in enumerate(terms)}
        self.hashes = np.array([xxhash.xxh64_intdigest(t, _SEED) for t in terms], np.uint64)
        self.items = [(item, np.array([at[t] for t in own]), np.array(list(own.values()), float)) for item, own in self.weights.items()]

    def shortness(self, lengths: list[int]) -> np.ndarray:
        """The number that a document's length makes the score fall by, in hundredths of the mean."""
        return np.array([50 + 50 * n * self.n_docs // self.n_terms for n in lengths], np.int64)

    def bounds(self, width: int, lengths: list[int], slices: bytes) -> Iterator[tuple[int, np.ndarray]]:
        """Of each item an upper bound for each document of a block."""
        n, shortness = len(lengths), self.shortness(lengths)
        bitmaps = np.frombuffer(slices, np.uint8).reshape(width, -1)
        levels, before = [], np.zeros(n)
        rows, present = np.arange(len(self.hashes)), None
        for level in range(len(LEVELS) - 1):
            some = self._present(bitmaps, rows, width, level)
            if present is not None:
                some &= present
            any_ = some.any(axis=1)
            rows, present = rows[any_], some[any_]
            if not len(rows):
                break
            most = LEVELS[level + 1] - 1
            worth = (1_000_000_000 * most // (1000 * most + 20 * shortness)).astype(float)
            place = np.full(len(self.hashes), -1)
            place[rows] = np.arange(len(rows))
            levels.append((place, present, worth - before))
            before = worth
        for item, terms, weights in self.items:
            total = np.zeros(n)
            for place, present, worth in levels:
                at = place[terms]
                held = at >= 0
                if not held.any():
                    break
                some = np.unpackbits(present[at[held]], axis=1, count=n)
                total += (weights[held] @ some.astype(float)) * worth
            yield item, total

    def _present(self, bitmaps: np.ndarray, rows: np.ndarray, width: int, level: int) -> np.ndarray:
        found = np.empty((len(rows), bitmaps.shape[1]), np.uint8)
        for start in range(0, len(rows), 8192):
            bits = places(entry(self.hashes[rows[start : start + 8192]], level), width)
            part = bitmaps[bits[:, 0]]
            for i in range(1, HASHES):
                part &= bitmaps[bits[:, i]]
            found[start : start + 8192] = part
        return found

    def score(self, item: int, counts: Counter, shortness: int) -> int:
        return sum(
            weight * (1_000_000_000 * counts[term] // (1000 * counts[term] + 20 * shortness)) for term, weight in self.weights[item].items() if term in counts
        )


def _best(source: DataFrame, blocks: DataFrame, weighted: DataFrame, n_docs: int, n_terms: int, top: int, probes: int) -> DataFrame:
    """``item``, ``rank``, ``doc_id``, ``score`` of one batch of items."""
    spark = source.sparkSession
    rows = [tuple(r) for r in weighted.select("item", "term", "weight").collect()]  # of one batch
    queries = spark.sparkContext.broadcast((rows, n_docs, n_terms))
    by_score = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    each = max(1, -(-probes // max(1, blocks.rdd.getNumPartitions())))
    by_bound = Window.partitionBy("item").orderBy(F.col("bound").desc(), "key")
    likely = blocks.mapInArrow(_bounded(queries, each, None), "item bigint, key bigint, bound double")
    likely = likely.withColumn("place", F.row_number().over(by_bound)).where(F.col("place") <= 2 * top).select("item", "key").distinct()
    least = _scored(source, likely, queries).withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") == top)
    reached = {row.item: row.score for row in least.select("item", "score").collect()}
    able = blocks.mapInArrow(_bounded(queries, 0, spark.sparkContext.broadcast(reached)), "item bigint, key bigint, bound double")
    scores = _scored(source, able.select("item", "key").distinct(), queries)
    return scores.withColumn("rank", F.row_number().over(by_score).cast("int")).where(F.col("rank") <= top).select("item", "rank", "doc_id", "score")


def _bounded(queries, each: int, reached):
    """Documents with the ``each`` best bounds of an item in a task, or those whose bound is as high as the score that is reached."""

    def rows(item: int, keys: np.ndarray, bounds: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), item)), pa.array(keys), pa.array(bounds)], names=["item", "key", "bound"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        asked = Queries(*queries.value)
        for batch in batches:
            for i in range(batch.num_rows):
                width, keys, lengths, slices = (c[i] for c in batch.columns)
                keys = keys.values.to_numpy()
                for item, bounds in asked.bounds(width.as_py(), lengths.as_py(), slices.as_buffer()):
                    if reached is not None:
                        able = np.flatnonzero(bounds >= max(1, reached.value.get(item, 1)))
                        if len(able):
                            yield rows(item, keys[able], bounds[able])
                        continue
                    some = np.flatnonzero(bounds)
                    if item in best:
                        held, least = best[item]
                        some = some[bounds[some] > least.min()] if len(least) >= each else some
                        new = np.append(held, keys[some]), np.append(least, bounds[some])
                    else:
                        new = keys[some], bounds[some]
                    if len(new[0]) > each:
                        kept = np.argpartition(-new[1], each - 1)[:each]
                        new = new[0][kept], new[1][kept]
                    best[item] = new
        for item, (keys, bounds) in best.items():
            if len(keys):
                yield rows(item, keys, bounds)

    return run


def _scored(source: DataFrame, pairs: DataFrame, queries) -> DataFrame:
    """``item``, ``doc_id``, ``score`` above 0 of all documents with the texts of ``pairs``, which are written."""
    wanted = stage(pairs.groupBy("key").agg(F.collect_list("item").alias("items")), "to_score")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = Queries(*queries.value)
        for batch in batches:
            found: list[tuple] = []
            for id_, text, items in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                counts = Counter(terms_of(text.as_py()))
                shortness = int(asked.shortness([sum(counts.values())])[0])
                for item in items:
                    score = asked.score(item, counts, shortness)
                    if score > 0:
                        found.append((item, id_, score))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], names=["item", "doc_id", "score"])

    return source.join(wanted, "key").select("doc_id", "text", "items").mapInArrow(run, "item bigint, doc_id bigint, score bigint")
