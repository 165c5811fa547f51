"""N-gram Jaccard join: sets of word shingles that overlap enough, by prefixes under several global token orders.

A global order of all tokens (hashes of shingles) is the same for every set. If two sets are similar enough, then
under *any* order the first tokens of one, its prefix, hold a token of the other's prefix. So a pair is a
candidate only if it shares a prefix token under each of several orders; what passes all of them is verified.
The orders put rare tokens first, by a table of counts over all documents, and differ in how they order
tokens of like frequency.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm.components import components
from terrace.staging import stage

SHINGLE = 3
#: Least overlap in hundredths of the union.
PERCENT = 90
ORDERS = 3
#: Bytes of text per cell of the table of token counts, and the logarithms of its least and most cells, one byte each. Tokens in
#: fewer documents than an average cell counts cannot be told from rare ones, which costs time, not links.
CELL_BYTES, LEAST_BITS, MOST_BITS = 16, 16, 26
#: Logarithm of the bits of the bitmap that tells tokens which lie in several prefixes: 16 MB.
BITMAP_BITS = 27
_PARTS = 64
#: Sets of one bucket that are compared at a time, at least and at most, and their tokens.
CHUNK, MOST_CHUNK, CHUNK_TOKENS = 200, 4_000, 1 << 20
#: Multipliers of a public 64-bit mixing function.
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_STEP = 0x9E3779B97F4A7C15

_DOCS = "doc_id bigint, key bigint, check bigint, n int, d1 bigint, d2 bigint, bits binary, part int, counts binary"


def shingle_set(text: bytes | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles; fewer words than ``size`` are one, no word none."""
    words = (text or b"").lower().split()  # A-Z only, and the six blanks
    if len(words) < size:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), 1)] if words else [], np.uint64)
    each = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    n = len(words) - size + 1
    found = each[:n]
    for i in range(1, size):
        found = mixed(found) + each[i : i + n]
    return np.unique(mixed(found))


def mixed(values: np.ndarray) -> np.ndarray:
    """A one-to-one mixing of 64-bit numbers."""
    values = (values ^ (values >> np.uint64(30))) * _MIX[0]
    values = (values ^ (values >> np.uint64(27))) * _MIX[1]
    return values ^ (values >> np.uint64(31))


def probe_length(n, percent: int):
    """Tokens of a set of ``n`` of which a similar set of at most ``n`` holds one in its first."""
    return n - (percent * n + 99) // 100 + 1


def short_length(n, percent: int):
    """The same for the smaller of both sets, or for sets of equal size."""
    return n - (2 * percent * n + 99 + percent) // (100 + percent) + 1


def ranks(tokens: np.ndarray, classes: np.ndarray, order: int) -> np.ndarray:
    """Place of each token in a global order: by class of frequency, then by a hash that differs from order to order."""
    rarity = classes[cells(tokens, len(classes))].astype(np.uint64)
    salt = np.uint64((order + 1) * _STEP % 2**64)
    return (rarity << np.uint64(58)) | (mixed(tokens ^ salt) >> np.uint64(6))


def cells(tokens: np.ndarray, n: int) -> np.ndarray:
    """Cell of each token in a table of ``n``, a power of two."""
    return (tokens >> np.uint64(65 - n.bit_length())).astype(np.int64)


def grouped(
    docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, percent: int = PERCENT, orders: int = ORDERS, chunk: int = CHUNK
) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` (smallest id reachable by links); one row per input row.

    Documents without a word have an empty set and no links: their component is their own id. Equal sets are one
    node, so copies and repeated rows get equal components. A NULL id never is the smallest one; a component
    without any id is NULL. Documents of fewer words than a shingle link with equal sequences only.

    Three passes over texts: sizes and digests of the sets with token counts; prefixes under the first order, about a
    tenth of the tokens, which alone are shuffled; and the sets that have a candidate. Tokens whose sets mostly meet
    under an earlier token are handled with that one. Buckets are cut into chunks, and pairs of chunks are compared
    by tasks that return a spanning star of what they find, so no pair of a large group is a row: first by size and by
    one bit per token, in which two sets never differ more than in their tokens. Sets that this leaves connected
    travel once as a whole, to be compared by all orders.
    """
    source = docs.select(
        F.col(id).cast("bigint").alias("doc_id"), F.xxhash64(text).alias("key"), F.crc32(F.coalesce(F.col(text), F.lit(""))).alias("check"), F.col(text).cast("binary").alias("text")
    )
    size = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_cells = 1 << min(MOST_BITS, max(LEAST_BITS, (size // CELL_BYTES).bit_length() - 1))
    described = stage(source.mapInArrow(_describe(shingle, n_cells), _DOCS), "shingle_sets")
    classes = source.sparkSession.sparkContext.broadcast(_classes(described.where("part is not null").select("part", "counts"), n_cells))
    rows = described.where("part is null").select("doc_id", "key", "check", "n", "d1", "d2")
    same_set = ["n", "d1", "d2"]
    nodes = rows.where("n > 0").groupBy(*same_set).agg(F.min("doc_id").alias("least_id"), F.min("key").alias("key"), F.min_by("check", "key").alias("check"))
    nodes = stage(nodes.withColumn("node", F.monotonically_increasing_id()), "distinct_sets")

    members = _members(source, classes, shingle, percent)
    bits = described.where("n > 0").select(F.col("d1").alias("set"), "bits").join(members.select("set").distinct(), "set", "left_semi")
    likely = stage(_dealt(members, chunk), "dealt").join(bits.groupBy("set").agg(F.first("bits").alias("bits")), "set")
    likely = components(_in_units(likely.select("bucket", "low", "high", "chunk", "set", "n", "bits")).mapInArrow(_likely(percent), "a bigint, b bigint"))
    members = likely.select(F.col("root").alias("bucket"), F.col("node").alias("set")).unionAll(likely.select("root", "root").distinct())
    members = stage(members.join(nodes.select(F.col("d1").alias("set"), "n"), "set"), "likely_sets")
    wanted = stage(nodes.join(members.select(F.col("set").alias("d1")).distinct(), "d1", "left_semi"), "wanted_sets")
    texts = source.join(wanted.select("key", "check"), ["key", "check"], "left_semi").groupBy("key", "check").agg(F.first("text").alias("text"))
    sets = texts.mapInArrow(_sets(shingle), "n int, d1 bigint, d2 bigint, tokens binary").join(wanted, same_set)
    sets = stage(sets.select(F.col("d1").alias("set"), "node", "tokens"), "candidate_sets")
    whole = stage(_dealt(members, chunk), "dealt").join(sets, "set").select("bucket", "low", "high", "chunk", "node", "tokens")
    edges = _in_units(whole).mapInArrow(_verified(classes, percent, orders), "a bigint, b bigint")

    roots = components(edges)
    rooted = stage(nodes.join(roots, "node", "left").select(*same_set, "least_id", F.coalesce("root", "node").alias("root")), "rooted")
    least = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    found = rows.join(rooted.join(least, "root").drop("root", "least_id"), same_set, "left")
    return found.select(
        "doc_id", F.col("n").cast("bigint").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")
    )


def _digest(tokens: np.ndarray) -> tuple[int, int]:
    return tuple(np.frombuffer(xxhash.xxh3_128_digest(tokens.tobytes()), "<i8").tolist())


def parities(tokens: np.ndarray) -> np.ndarray:
    """One bit per token, or up to two: whether the number of tokens with these last bits is odd.

    The bits in which two sets differ are at most the tokens in which they differ. The upper half xor the
    lower one are the parities of half as many bits.
    """
    size = max(64, 1 << (len(tokens) - 1).bit_length()) if len(tokens) else 64
    odd = np.bincount((tokens & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(bool), bitorder="little").view(np.uint64)


def sparse(counts: np.ndarray) -> bytes:
    """Counts of a byte each, without the zeros, in about a byte per count: gaps between places, byte by byte, and the counts."""
    at = np.flatnonzero(counts)
    gaps = np.diff(at, prepend=0).astype("<u4").view(np.uint8).reshape(-1, 4)
    return zlib.compress(gaps.T.tobytes() + counts[at].tobytes(), 1)


def unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The places and the counts of :func:`sparse`."""
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(5, -1)
    return np.cumsum(np.ascontiguousarray(planes[:4].T).view("<u4").reshape(-1), dtype=np.int64), planes[4].astype(np.uint64)


def _describe(shingle: int, n_cells: int):
    """Size, digest and parities of each set, and at the end of the task how many sets, up to 255, have a token in each cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(n_cells, np.uint8)
        schema = pa.schema([(c, pa.int64()) for c in ("doc_id", "key", "check")] + [("n", pa.int32()), ("d1", pa.int64()), ("d2", pa.int64()), ("bits", pa.binary()), ("part", pa.int32()), ("counts", pa.binary())])
        for batch in batches:
            sizes, digests, bits = [], [], []
            for text in batch.column(3):
                tokens = shingle_set(text.as_py(), shingle)
                own, n = np.unique(cells(tokens, n_cells), return_counts=True)
                counts[own] = np.minimum(counts[own] + n, 255)
                sizes.append(len(tokens))
                digests.append(_digest(tokens))
                bits.append(parities(tokens).tobytes())
            d1, d2 = zip(*digests) if digests else ((), ())
            none = [None] * len(sizes)
            columns = [*batch.columns[:3], sizes, d1, d2, bits, none, none]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) if not isinstance(c, pa.Array) else c for c, f in zip(columns, schema)], schema=schema)
        for part, some in enumerate(counts.reshape(_PARTS, -1)):
            if some.any():
                row = {"n": 0, "part": part, "counts": sparse(some)}
                yield pa.RecordBatch.from_pylist([{f.name: row.get(f.name) for f in schema}], schema=schema)

    return run


def _classes(parts: DataFrame, n_cells: int) -> np.ndarray:
    """Binary logarithm of each cell's count over all documents, a byte each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, counts in zip(batch.column(0).to_pylist(), batch.column(1)):
                at, some = unpacked(counts.as_py())
                sums.setdefault(part, np.zeros(n_cells // _PARTS, np.uint64))[at] += some
        for part, total in sums.items():
            logs = np.frexp(total.astype(float))[1].astype(np.uint8)
            yield pa.RecordBatch.from_pylist([{"part": part, "logs": logs.tobytes()}], schema=pa.schema([("part", pa.int32()), ("logs", pa.binary())]))

    found = np.zeros((_PARTS, n_cells // _PARTS), np.uint8)
    for row in parts.repartition(_PARTS, "part").mapInArrow(run, "part int, logs binary").collect():
        found[row.part] = np.frombuffer(row.logs, np.uint8)
    return found.reshape(-1)


def _members(source: DataFrame, classes, shingle: int, percent: int) -> DataFrame:
    """``bucket``, ``set``, ``n``: which sets have to be compared with each other. Similar sets share a bucket.

    A bucket is a token that at least two sets have in their prefix under the first order, one of them in its short
    prefix. If an eighth of its sets or more have the same token as their first, the bucket is joined with that one's, so
    that near copies, which share most of their tokens but not the same ones, meet once and not under each token.
    """

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["token", "set", "place"]  # place: size and position in one number
        seen: set[tuple[int, int]] = set()  # copies in one task need to be sent once
        for batch in batches:
            parts: list[list[np.ndarray]] = [[] for _ in names]
            for text in batch.column(0):
                tokens = shingle_set(text.as_py(), shingle)
                n, digest = len(tokens), _digest(tokens)
                if not n or digest in seen:
                    continue
                seen.add(digest)
                first = tokens[np.argsort(ranks(tokens, classes.value, 0), kind="stable")[: probe_length(n, percent)]]
                for column, values in zip(parts, (first.view(np.int64), np.full(len(first), digest[0]), (n << 32) + np.arange(len(first)))):
                    column.append(values)
            if parts[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in parts], names=names)

    posted = stage(source.select("text").mapInArrow(prefixes, "token bigint, set bigint, place bigint"), "prefixes")
    # Most tokens are in one row. Of the rest, copies from other tasks are combined before their sets are counted.
    again = stage(posted.groupBy("token").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select("token"), "repeated_tokens")
    again = _may_hold(posted, again).join(again, "token").groupBy("token", "set").agg(F.min("place").alias("place"))
    n, at = F.shiftright("place", 32), F.col("place").bitwiseAND(F.lit(2**32 - 1))
    again = stage(again.select("token", "set", n.cast("int").alias("n"), at.cast("int").alias("at")), "repeated_prefixes")
    short = F.col("at") < F.col("n") - F.floor((2 * percent * F.col("n") + 99 + percent) / (100 + percent)) + 1
    shared = again.groupBy("token").agg(F.count(F.lit(1)).alias("sets"), F.max(short).alias("any")).where("sets > 1 and any").select("token")
    shared = stage(again.join(shared, "token").select("token", "set", "n", "at"), "shared_prefixes")
    first = shared.groupBy("set").agg(F.min_by("token", "at").alias("first"))
    counted = shared.join(first, "set").groupBy("token", "first").agg(F.count(F.lit(1)).alias("sets"))
    usual = counted.groupBy("token").agg(F.max(F.struct("sets", "first")).alias("most"), F.sum("sets").alias("all"))
    bucket = F.when(8 * F.col("most.sets") >= F.col("all"), F.col("most.first")).otherwise(F.col("token"))
    return stage(shared.join(usual.select("token", bucket.alias("bucket")), "token").select("bucket", "set", "n").distinct(), "buckets")


def _may_hold(rows: DataFrame, tokens: DataFrame) -> DataFrame:
    """``rows`` without most of those whose token is not among ``tokens``, so that they are not shuffled.

    A bitmap over the first bits of the tokens, of fixed size, filled part by part.
    """
    bits = BITMAP_BITS - _PARTS.bit_length() + 1

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, np.ndarray] = {}
        for batch in batches:
            first = batch.column(0).to_numpy().view(np.uint64) >> np.uint64(64 - BITMAP_BITS)
            for part in np.unique(first >> np.uint64(bits)).tolist():
                own = first[first >> np.uint64(bits) == part] & np.uint64((1 << bits) - 1)
                parts.setdefault(part, np.zeros(1 << bits, bool))[own.astype(np.int64)] = True
        for part, held in parts.items():
            schema = pa.schema([("part", pa.int32()), ("bits", pa.binary())])
            yield pa.RecordBatch.from_pylist([{"part": part, "bits": np.packbits(held).tobytes()}], schema=schema)

    by_part = tokens.repartition(_PARTS, F.shiftrightunsigned("token", 64 - _PARTS.bit_length() + 1))
    bitmap = np.zeros((_PARTS, (1 << bits) // 8), np.uint8)
    for row in by_part.mapInArrow(fill, "part int, bits binary").collect():
        bitmap[row.part] = np.frombuffer(row.bits, np.uint8)
    held = rows.sparkSession.sparkContext.broadcast(bitmap.reshape(-1))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first = (batch.column(0).to_numpy().view(np.uint64) >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)
            yield batch.filter(pa.array((held.value[first >> 3] >> (7 - (first & 7)).astype(np.uint8)) & 1 == 1))

    return rows.mapInArrow(keep, rows.schema)


def _in_units(dealt: DataFrame) -> DataFrame:
    unit = ["bucket", "low", "high"]
    return dealt.repartition(*unit).sortWithinPartitions(*unit)


def _dealt(members: DataFrame, chunk: int) -> DataFrame:
    """``members`` dealt into pairs of chunks: ``bucket``, ``low``, ``high`` name the pair, ``chunk`` is the row's own.

    Written before it is joined, Spark knows its size, and does not shuffle the sets twice where it is small.
    """
    size = F.greatest(F.lit(chunk), F.least(F.lit(MOST_CHUNK), F.col("sets") / 8))
    chunks = F.ceil(F.greatest(F.col("sets") / size, F.col("tokens") / CHUNK_TOKENS)).cast("int")
    cut = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("sets"), F.sum("n").alias("tokens")).select("bucket", chunks.alias("chunks"))
    return (
        members.join(cut, "bucket")
        .withColumn("chunk", F.pmod(F.xxhash64("set"), F.col("chunks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .select("bucket", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"), "chunk", "set", "n")
    )


def _sets(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                found = [shingle_set(t.as_py(), shingle) for t in batch.column(2)[at : at + 256]]
                d1, d2 = zip(*map(_digest, found))
                columns = [pa.array([len(s) for s in found], pa.int32()), pa.array(d1), pa.array(d2), pa.array([s.tobytes() for s in found], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["n", "d1", "d2", "tokens"])

    return run


def _likely(percent: int):
    """Pairs of sets of similar size and parities, as a spanning star per component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit in whole_groups(batches, 3):
            chunk, sizes, sets = (unit.column(c).to_numpy() for c in ("chunk", "n", "set"))
            across = unit.column("low")[0] != unit.column("high")[0]
            labels = alike(sizes.astype(np.int64), [np.frombuffer(b.as_py(), np.uint64) for b in unit.column("bits")], chunk if across else None, percent)
            other = np.flatnonzero(labels != np.arange(len(labels)))
            if len(other):
                yield pa.RecordBatch.from_arrays([pa.array(sets[other]), pa.array(sets[labels[other]])], names=["a", "b"])

    return run


def alike(sizes: np.ndarray, bits: list[np.ndarray], sides: np.ndarray | None, percent: int) -> np.ndarray:
    """Of each set a set of its component, by pairs (of different sides, if given) that sizes and parities do not exclude."""
    order = np.argsort(sizes, kind="stable")
    n, labels = sizes[order], np.arange(len(order))
    words = np.array([len(bits[i]) for i in order])
    side = None if sides is None else sides[order]
    most = np.searchsorted(n, 100 * n // percent, "right")
    for width in np.unique(words):
        here = np.flatnonzero(words == width)
        end = max(most[here[0] : here[-1] + 1])
        # Partners are at least as large, with as many bits or more, which are folded.
        folded = np.array([np.bitwise_xor.reduce(bits[order[i]].reshape(-1, width), axis=0) for i in range(here[0], end)])
        for x in here:
            y = np.arange(x + 1, most[x])
            y = y[labels[y] != labels[x]]
            if side is not None:
                y = y[side[y] != side[x]]
            if not len(y):
                continue
            apart = np.bitwise_count(folded[y - here[0]] ^ folded[x - here[0]]).sum(axis=1, dtype=np.int64)
            both = n[x] + n[y]
            near = y[apart <= both - 2 * -(-percent * both // (100 + percent))]
            if len(near):
                labels[np.isin(labels, labels[near])] = labels[x]
    found = np.empty(len(order), np.int64)
    found[order] = order[labels]
    return found


def _verified(classes, percent: int, orders: int):
    """Links of each pair of chunks, as a spanning star per component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit in whole_groups(batches, 3):
            chunk, node = unit.column("chunk").to_numpy(), unit.column("node").to_numpy()
            sets = [np.frombuffer(t.as_buffer(), np.uint64) for t in unit.column("tokens")]
            sides = chunk if chunk.min() < chunk.max() else None
            # Of a pair of different chunks only the pairs across are new.
            if sides is None and unit.column("low")[0] != unit.column("high")[0]:
                continue
            labels = linked(sets, sides, classes.value, percent, orders)
            other = np.flatnonzero(labels != np.arange(len(labels)))
            if len(other):
                yield pa.RecordBatch.from_arrays([pa.array(node[other]), pa.array(node[labels[other]])], names=["a", "b"])

    return run


def whole_groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """The groups of rows that agree in the first ``keys`` columns, by which the rows are sorted."""
    held: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        held = rows if held is None else pa.concat_tables([held, rows])
        columns = [held.column(i).to_numpy() for i in range(keys)]
        cuts = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
        for start, end in zip(np.append(0, cuts), cuts):
            yield held.slice(start, end - start)
        held = held.slice(cuts[-1] if len(cuts) else 0)
    if held is not None:
        yield held


def numbered(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct tokens in order, and of each token the place of its own among them."""
    order = np.argsort(tokens)
    tokens = tokens[order]
    new = np.ones(len(tokens), bool)
    new[1:] = tokens[1:] != tokens[:-1]
    ids = np.empty(len(tokens), np.int32)
    ids[order] = np.cumsum(new, dtype=np.int32) - 1
    return tokens[new], ids


def linked(sets: list[np.ndarray], sides: np.ndarray | None, classes: np.ndarray, percent: int = PERCENT, orders: int = ORDERS) -> np.ndarray:
    """Of each set a set of its component, by links between sets (of different ``sides``, if given).

    Sets are taken by size. A later one is a candidate if it is small enough and holds a token of the short prefix in its
    own prefix under every order; candidates that are in one component already need no verification.
    """
    m = len(sets)
    order = np.array(sorted(range(m), key=lambda i: len(sets[i])))
    sizes = np.array([len(sets[i]) for i in order])
    labels = np.arange(m)
    most = np.searchsorted(sizes, 100 * sizes // percent, "right")
    if (most <= np.arange(m) + 1).all():
        return labels
    # Numbers of four bytes, and few of them at a time: a unit may hold millions of tokens.
    start = np.append(0, np.cumsum(sizes))
    owner = np.repeat(np.arange(m, dtype=np.int32), sizes)
    distinct, ids = numbered(np.concatenate([sets[i] for i in order]))
    place = np.arange(len(ids), dtype=np.int32)
    place -= start.astype(np.int32)[owner]
    in_probe, in_short = (place < f(sizes, percent).astype(np.int32)[owner] for f in (probe_length, short_length))
    del place
    filters = []
    for j in range(orders):
        rank = np.empty(len(distinct), np.int32)
        rank[np.argsort(ranks(distinct, classes, j), kind="stable")] = np.arange(len(distinct), dtype=np.int32)
        by_rank = np.lexsort((rank[ids], owner))
        probe, short = by_rank[in_probe], by_rank[in_short]
        del by_rank
        by_token = probe[np.argsort(ids[probe], kind="stable")]
        ends = np.searchsorted(ids[by_token], np.arange(len(distinct) + 1))
        filters.append((ids[short], np.append(0, np.cumsum(np.bincount(owner[short], minlength=m))), owner[by_token], ends))
    held = np.zeros(len(distinct), bool)
    side = None if sides is None else sides[order]
    for x in range(m - 1):
        if most[x] <= x + 1:
            continue
        passed = np.zeros(m, np.int8)
        for j, (tokens, at, rows, ends) in enumerate(filters):
            near = np.concatenate([rows[ends[t] : ends[t + 1]] for t in tokens[at[x] : at[x + 1]]])
            passed[near[passed[near] == j]] = j + 1
        later = np.flatnonzero(passed[x + 1 : most[x]] == orders) + x + 1
        later = later[labels[later] != labels[x]]
        if side is not None:
            later = later[side[later] != side[x]]
        if not len(later):
            continue
        held[:] = False
        held[ids[start[x] : start[x + 1]]] = True
        for y in later:
            if labels[y] != labels[x]:
                both = int(np.count_nonzero(held[ids[start[y] : start[y + 1]]]))
                if 100 * both >= percent * (sizes[x] + sizes[y] - both):
                    labels[labels == labels[y]] = labels[x]
    found = np.empty(m, np.int64)
    found[order] = order[labels]
    return found
