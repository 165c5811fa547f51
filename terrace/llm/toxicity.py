"""Toxicity scores by a factorization machine over hashed terms.

Besides one weight per term, the machine learns a short vector per term; the product of two vectors
is the weight of the pair, so that two terms can count more, or less, together than apart.
"""

from __future__ import annotations

import pickle
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.llm.rows import text_of
from terrace.staging import stage

BUCKETS = 1 << 18
FACTORS = 4
#: Most labelled documents to learn from, chosen by a hash of the id.
SAMPLE = 20_000
#: Most distinct terms of all these documents together; the last one may go beyond. It bounds the memory of the task that learns.
SAMPLE_TERMS = 20_000_000
EPOCHS = 12
RATE = 0.3
DECAY = 1e-5
POSITIVE_WEIGHT = 2.0
#: Terms are used whose share of toxic documents is this many standard errors off the expected one.
SIGNIFICANT = 3.0
#: Pairs are many, so both terms of a pair are used if it is this many standard errors off what its two terms say.
SIGNIFICANT_PAIR = 6.0
HELD_OUT_OF = 5
_WORD = re.compile(r"\w+")
_KNOWN_MOST = 500_000


def terms_of(text: str, known: dict[str, tuple[int, ...]]) -> np.ndarray:
    """Buckets of the distinct words of a text, and of the first six letters of longer words."""
    found: set[int] = set()
    for word in set(_WORD.findall(text.lower())):
        buckets = known.get(word)
        if buckets is None:
            buckets = (zlib.crc32(word.encode("utf-8", "replace")) % BUCKETS,)
            if len(word) > 6:
                buckets += (zlib.crc32(b"^" + word[:6].encode("utf-8", "replace")) % BUCKETS,)
            if len(known) >= _KNOWN_MOST:
                known.clear()
            known[word] = buckets
        found.update(buckets)
    return np.fromiter(sorted(found), np.int32, len(found))


class Machine:
    """A trained machine; without any training row it scores every text by the prior."""

    def __init__(self, bias: float):
        self.bias = bias
        self.used = np.zeros(BUCKETS, bool)
        self.weight = np.zeros(BUCKETS, np.float32)
        self.vector = np.random.default_rng(7).normal(0, 0.05, (BUCKETS, FACTORS)).astype(np.float32)

    def choose(self, texts: list[np.ndarray], labels: np.ndarray) -> None:
        """Use the terms that toxic documents hold clearly more, or less, often than chance has it, and those of such pairs.

        A term can be as frequent in toxic documents as in others and still count beside another one. So all pairs
        are looked at as well, against the share that the two terms' own shares add up to.
        """
        if not len(texts):
            return
        total = np.bincount(np.concatenate(texts), minlength=BUCKETS)
        toxic = np.bincount(np.concatenate([np.zeros(0, np.int32), *(t for t, y in zip(texts, labels) if y > 0)]), minlength=BUCKETS)
        expected = total * labels.mean()
        self.used = np.abs(toxic - expected) >= SIGNIFICANT * np.sqrt(expected + 1)
        self.used[_in_pairs(texts, labels, total, toxic)] = True

    def logits(self, terms: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Of several texts whose used terms, at least one each, lie one after the other."""
        x = np.repeat(1 / np.sqrt(ends - starts), ends - starts).astype(np.float32)
        part = self.vector[terms] * x[:, None]
        both = np.add.reduceat(part, starts, axis=0) ** 2 - np.add.reduceat(part**2, starts, axis=0)
        return self.bias + np.add.reduceat(self.weight[terms] * x, starts) + both.sum(axis=1) / 2

    def gradients(self, terms: np.ndarray, starts: np.ndarray, ends: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
        """Of the mean weighted log loss of several texts: the terms they hold, then by their weights, by their vectors and by the bias."""
        sizes = ends - starts
        x = np.repeat(1 / np.sqrt(sizes), sizes).astype(np.float32)
        slope = (1 / (1 + np.exp(-self.logits(terms, starts, ends))) - y) * np.where(y > 0, POSITIVE_WEIGHT, 1) / len(sizes)
        per_term = (np.repeat(slope, sizes) * x).astype(np.float32)
        part = self.vector[terms] * x[:, None]
        rest = np.repeat(np.add.reduceat(part, starts, axis=0), sizes, axis=0) - part
        touched, place = np.unique(terms, return_inverse=True)
        by_weight = np.bincount(place, per_term).astype(np.float32)
        by_vector = np.stack([np.bincount(place, per_term * rest[:, f]) for f in range(FACTORS)], axis=1).astype(np.float32)
        return touched, by_weight, by_vector, float(slope.sum())

    def fit(self, texts: list[np.ndarray], labels: np.ndarray, batch: int = 32) -> Machine:
        """Stochastic gradients with a step per weight that shrinks as its gradients add up."""
        self.choose(texts, labels)
        texts = [t[self.used[t]] for t in texts]
        rng = np.random.default_rng(11)
        seen_w, seen_v = np.full(BUCKETS, 1e-6, np.float32), np.full((BUCKETS, FACTORS), 1e-6, np.float32)
        seen_b = 1e-6
        filled = np.array([i for i, t in enumerate(texts) if len(t)], np.int64)
        for _ in range(EPOCHS):
            order = rng.permutation(filled)
            for at in range(0, len(order), batch):
                some = order[at : at + batch]
                sizes = np.array([len(texts[i]) for i in some])
                ends = np.cumsum(sizes)
                starts = ends - sizes
                terms, y = np.concatenate([texts[i] for i in some]), labels[some]
                touched, by_weight, by_vector, step = self.gradients(terms, starts, ends, y)
                by_weight += DECAY * self.weight[touched]
                seen_w[touched] += by_weight**2
                self.weight[touched] -= RATE * by_weight / np.sqrt(seen_w[touched])
                by_vector += DECAY * self.vector[touched]
                seen_v[touched] += by_vector**2
                self.vector[touched] -= RATE / 4 * by_vector / np.sqrt(seen_v[touched])
                seen_b += step**2
                self.bias -= RATE / 4 * step / seen_b**0.5
        return self

    def scores(self, texts: list[np.ndarray]) -> np.ndarray:
        texts = [t[self.used[t]] for t in texts]
        sizes = np.array([len(t) for t in texts], np.int64)
        logits = np.full(len(texts), float(self.bias))
        filled = np.flatnonzero(sizes)
        if len(filled):
            ends = np.cumsum(sizes[filled])
            logits[filled] = self.logits(np.concatenate([texts[i] for i in filled]), ends - sizes[filled], ends)
        return 1 / (1 + np.exp(-np.clip(logits, -30, 30)))


def _in_pairs(texts: list[np.ndarray], labels: np.ndarray, total: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Terms of the pairs whose toxic documents are clearly more, or less, than the two terms' shares let expect.

    A pair can reach the bound upwards with so many toxic documents only, and
    downwards with so many documents; terms that have neither are in no such pair, and need not be counted.
    """
    most = SIGNIFICANT_PAIR * (SIGNIFICANT_PAIR + np.sqrt(SIGNIFICANT_PAIR**2 + 4)) / 2  # n with n = bound * sqrt(n + 1)
    kept = np.flatnonzero((toxic >= SIGNIFICANT_PAIR) | (total >= most))
    place = np.full(BUCKETS, -1, np.int32)
    place[kept] = np.arange(len(kept))
    # Toxic documents come first, so that the first of a term's documents are the toxic ones.
    own = [p[p >= 0] for p in (place[texts[i]] for i in np.argsort(labels <= 0, kind="stable"))]
    if not len(kept):
        return kept
    bad = int((labels > 0).sum())
    sizes = np.array([len(t) for t in own])
    ends, flat = np.cumsum(sizes), np.concatenate(own)
    order = np.argsort(flat, kind="stable")
    docs = np.repeat(np.arange(len(own)), sizes)[order]
    first = np.append(0, np.cumsum(np.bincount(flat, minlength=len(kept))))
    n = np.diff(first)
    n_bad = np.bincount(flat[: ends[bad - 1] if bad else 0], minlength=len(kept))
    odds = lambda part, whole: np.log((part + 0.5) / (whole - part + 0.5))
    base, alone = odds(bad, len(own)), odds(n_bad, n)
    found = np.zeros(len(kept), bool)
    for a in range(len(kept)):
        with_a = docs[first[a] : first[a + 1]]
        both_bad, both = (
            np.bincount(np.concatenate([flat[:0], *(own[d] for d in some)]), minlength=len(kept)) for some in (with_a[: n_bad[a]], with_a[n_bad[a] :])
        )
        both += both_bad
        b = np.flatnonzero((both_bad >= SIGNIFICANT_PAIR) | (both >= most))
        b = b[b > a]
        # Shares add up as odds do in a sum of weights.
        expected = both[b] / (1 + np.exp(-(alone[a] + alone[b] - base)))
        off = b[np.abs(both_bad[b] - expected) >= SIGNIFICANT_PAIR * np.sqrt(expected + 1)]
        if len(off):
            found[a] = found[off] = True
    return kept[found]


def trained(rows: list[tuple[int, list[int]]]) -> Machine:
    """Rows of label and terms, in any order."""
    labels = np.array([label for label, _ in rows], np.float32)
    return Machine(float(np.log((labels.sum() + 1) / (len(rows) - labels.sum() + 10)))).fit([np.asarray(t, np.int32) for _, t in rows], labels)


def held_out(id: Column) -> Column:
    return F.coalesce(F.crc32(id.cast("string")) % HELD_OUT_OF == 0, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, most: int = SAMPLE, most_terms: int = SAMPLE_TERMS) -> bytes:
    """A machine from labelled, not held-out documents, as bytes.

    At most ``most`` labels are taken, those with the smallest hashes of their ids, and of these as many as hold ``most_terms`` terms
    together, so that many long texts do not outgrow a task; of several labels of one
    id the largest counts, and ids or labels that are NULL do not. The bounded sample is sent to all
    executors, which extract terms; one task learns from the terms, and the driver gets the weights
    only.
    """
    chosen = (
        labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most)
    )

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        for batch in batches:
            terms = [terms_of(t.as_py(), known) for t in batch.column(2)]
            kinds = pa.array(terms, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), kinds], names=["doc_id", "toxic", "terms"])

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(label, id_, terms) for b in batches for label, id_, terms in zip(b.column(1).to_pylist(), b.column(0).to_pylist(), map(_terms, b.column(2)))]
        rows.sort(key=lambda r: (r[1], len(r[2]), r[2].tobytes()))
        machine = trained([(label, terms) for label, _, terms in rows])
        yield pa.RecordBatch.from_arrays([pa.array([p], pa.binary()) for p in _parts(machine)], names=["bias", "used", "weight", "vector"])

    # Ids that occur several times among the documents could exceed the bound: one text per id is taken.
    own = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text")).join(F.broadcast(chosen), "doc_id")
    terms = own.select("doc_id", "toxic", "text").mapInArrow(extract, "doc_id bigint, toxic int, terms array<int>")
    one = terms.groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("terms").alias("terms"))
    held = stage(one, "terms")
    earlier = Window.orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    sizes = held.select("doc_id", F.coalesce(F.sum(F.size("terms")).over(earlier), F.lit(0)).alias("_before"))  # at most ``most`` rows
    within = sizes.where(F.col("_before") < most_terms).select("doc_id")
    row = held.join(F.broadcast(within), "doc_id").coalesce(1).mapInArrow(fit, "bias binary, used binary, weight binary, vector binary").first()
    return pickle.dumps(_parts(trained([])) if row is None else [bytes(c) for c in row])


def _terms(value) -> np.ndarray:
    return value.values.to_numpy().astype(np.int32)


def _parts(machine: Machine) -> list[bytes]:
    return [p.tobytes() for p in (np.float64(machine.bias), machine.used, machine.weight, machine.vector)]


def _machine(stored: bytes) -> Machine:
    bias, used, weight, vector = pickle.loads(stored)
    machine = Machine(float(np.frombuffer(bias, np.float64)[0]))
    machine.used = np.frombuffer(used, bool)
    machine.weight = np.frombuffer(weight, np.float32)
    machine.vector = np.frombuffer(vector, np.float32).reshape(BUCKETS, FACTORS)
    return machine


def scored(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` (0 to 1), ``predicted``; one row per input row.

    A NULL text counts as empty, and a text without a word gets the learned bias. Equal texts get
    equal scores. Without any labelled row every score is the prior of 1 in 11. A NULL id is not
    held out. Texts are read by one pass and never shuffled; the model has a fixed size.
    """
    held = docs.sparkSession.sparkContext.broadcast(learn(docs, labels, most))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, known = _machine(held.value), {}
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                some = batch.slice(at, 128)
                scores = machine.scores([terms_of(t.as_py(), known) for t in some.column(2)])
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), pa.array(scores)], names=["doc_id", "held_out", "score"])

    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), text_of().alias("_text"))
    return source.mapInArrow(run, "doc_id bigint, held_out boolean, score double").withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
