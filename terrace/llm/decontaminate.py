"""Benchmark decontamination: training texts that hold a test item.

The questions of the test items form a BM25 inverted index with block maxima. Every training text is a
query, with all of its words. Block-max WAND walks the postings of its terms from pivot to pivot and skips what lies between; the
sum of a block's largest impacts is an upper bound for all items of the block, and only blocks whose bound reaches the threshold are
scored; there, an item is left as soon as the terms that are still open cannot lift it over the threshold. Common terms of an
item together stay below half its threshold, so bounds need its rarer ("essential") terms only.
The threshold is the least score of a text that holds enough of the question, so the index only saves
work: items above it are verified by the overlap of question and answer in five-word shingles, over the whole text.
"""

from __future__ import annotations

import pickle
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm.rows import aside, text_of
from terrace.staging import stage

SHINGLE = 5
OVERLAP = 0.8
K1, B = 1.2, 0.75
BLOCK = 16
#: Words of items whose index is sent to the executors at a time; more items take more passes over the texts.
INDEX_WORDS = 1_000_000

_WORD = re.compile(r"\w+")
FOUND = "item_id bigint, score double, question_overlap double, answer_overlap double"


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def parts_of(text: str) -> tuple[list[str], list[str]] | None:
    """Words of an item's question and answer; None without a word.

    The answer is the last line of an item of several lines, else the last quarter of its words;
    the question is what comes before.
    """
    lines = [w for w in map(words, text.split("\n")) if w]
    flat = [w for line in lines for w in line]
    if not flat:
        return None
    cut = len(flat) - (len(lines[-1]) if len(lines) > 1 else len(flat) // 4)
    return flat[:cut], flat[cut:]


def shingles_of(part: list[str]) -> list[tuple[str, ...]]:
    """A part shorter than a shingle is one shingle, and one without a word has none."""
    return [tuple(part[i : i + SHINGLE]) for i in range(max(1, len(part) - SHINGLE + 1))] if part else []


def least_score(impact: dict[str, float], question: list[str]) -> float:
    """A lower bound for the score of all texts that hold enough of the shingles of a question.

    m different shingles cover m + 4 words or more, so a text that lacks k of them lacks at most k of the words. A term is
    lacking if all its places are: the bound takes away the terms that score most per place, the last one in part.
    """
    n = max(1, len(question) - SHINGLE + 1)
    room = int(n * (1 - OVERLAP) + 1e-6)
    left = sum(impact.values())
    count = Counter(question)
    for term in sorted(impact, key=lambda t: -impact[t] / count[t]):
        if not room:
            break
        places = min(room, count[term])
        left -= impact[term] * places / count[term]
        room -= places
    return left


class Index:
    """Postings of one set of questions; every term carries its frequency over all questions."""

    def __init__(self, rows: list, n: int, mean: float):
        self.items = sorted(((r["item_id"], r["question"], r["answer"], r["frequency"]) for r in rows), key=lambda s: (s[0] is None, s[0] or 0, *s[1:3]))
        self.terms: list[list[tuple[float, str]]] = []
        self.total: list[float] = []
        self.threshold: list[float] = []
        need, postings = [], {}
        for number, (_, text, _, frequency) in enumerate(self.items):
            length, count = K1 * (1 - B + B * len(text) / mean), Counter(text)
            impact = [(float(np.log1p((n - df + 0.5) / (df + 0.5))) * (tf := count[t]) * (K1 + 1) / (tf + length), t) for t, df in frequency.items()]
            impact.sort()
            self.terms.append(impact[::-1])
            self.total.append(sum(w for w, _ in impact))
            self.threshold.append(least_score({t: w for w, t in impact}, text))
            # The bound takes the most common terms for held.
            dropped = 0.0
            for weight, term in impact:
                if dropped + weight <= self.threshold[-1] / 2:
                    dropped += weight
                else:
                    per_block = postings.setdefault(term, {})
                    per_block[number // BLOCK] = max(per_block.get(number // BLOCK, 0.0), weight)
            need.append(self.threshold[-1] - dropped)
        self.need = [min(need[i : i + BLOCK]) - 1e-9 for i in range(0, len(need), BLOCK)]
        self.least = min(self.need, default=float("inf"))
        self.term_id = {t: i for i, t in enumerate(postings)}
        # Items are numbered in turn, so the blocks of a term ascend.
        self.blocks_of = [list(p) for p in postings.values()]
        self.maxima_of = [list(p.values()) for p in postings.values()]
        self.peak = [max(p.values()) for p in postings.values()]

    def candidates(self, text: set[str]) -> Iterator[int]:
        """Blocks, in ascending order, whose bound for the text reaches the block's threshold, by block-max WAND.

        Each term of the text stands at a block of its postings. In the order of these, the terms' largest impacts of all are added up until
        they reach the least threshold: that is the pivot, and no block before it can hold an item. The terms that stand
        before it skip there, and the maxima of its block decide.
        """
        ids = {self.term_id.get(term) for term in text}
        ids.discard(None)
        # The sum over all terms bounds every block.
        if sum(map(self.peak.__getitem__, ids)) < self.least:
            return
        heap = [(self.blocks_of[t][0], t, 0) for t in ids]
        heapify(heap)
        while heap:
            passed, bound = [], 0.0
            while heap and bound < self.least:
                passed.append(heappop(heap))
                bound += self.peak[passed[-1][1]]
            if bound < self.least:
                return
            pivot, bound = passed[-1][0], 0.0
            while heap and heap[0][0] == pivot:
                passed.append(heappop(heap))
            for block, term, at in passed:
                held = self.blocks_of[term]
                if block < pivot:
                    at = bisect_left(held, pivot, at + 1)
                    if at == len(held):
                        continue
                if held[at] == pivot:
                    bound += self.maxima_of[term][at]
                    at += 1
                    if at == len(held):
                        continue
                heappush(heap, (held[at], term, at))
            if bound >= self.need[pivot]:
                yield pivot

    def search(self, texts: list[list[str]]) -> Iterator[tuple]:
        """Items that a text holds: its number, then the columns :data:`FOUND`."""
        for number, text in enumerate(texts):
            held, shingles = set(text), {}
            for block in self.candidates(held):
                for i in range(block * BLOCK, min(len(self.items), (block + 1) * BLOCK)):
                    score = self.score(i, held)
                    if score is None:
                        continue
                    item_id, question, answer, _ = self.items[i]
                    in_question = _overlap(question, text, shingles)
                    if in_question < OVERLAP:
                        continue
                    in_answer = _overlap(answer, text, shingles)
                    if in_answer is None or in_answer >= OVERLAP:
                        yield number, item_id, score, in_question, in_answer

    def score(self, i: int, held: set[str]) -> float | None:
        """BM25 of the question of item ``i`` for the text's terms, or None if below its threshold."""
        left = self.total[i]
        for weight, term in self.terms[i]:
            if term not in held:
                left -= weight
                if left < self.threshold[i] - 1e-9:
                    return None
        return left


def _overlap(part: list[str], text: list[str], known: dict[int, set]) -> float | None:
    """Share of the shingles of ``part`` that ``text`` holds; ``known`` keeps those of the text by length."""
    own = shingles_of(part)
    if not own:
        return None
    k = len(own[0])
    if k not in known:
        known[k] = set(zip(*(text[j:] for j in range(k))))
    return sum(s in known[k] for s in own) / len(own)


def leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``doc_id``, ``_hash`` (of the text), ``item_id``, ``score``, ``question_overlap``, ``answer_overlap`` of leaked items.

    A row says that the text holds at least 80 % of the five-word shingles of the item's question
    and of its answer. Rows equal in id and text give one row per item; so do items equal in id and
    text. NULL, empty and blank texts match nothing, nor do items without a word. An item without
    an answer (fewer than four words in one line) is decided by its question.

    The texts are read once per million words of items, without a shuffle; only matches are
    shuffled.
    """
    found = None
    for index in _indexes(items):
        part = _search(docs, index)
        found = part if found is None else found.union(part)
    if found is None:
        found = docs.sparkSession.createDataFrame([], f"doc_id bigint, _hash bigint, {FOUND}")
    return found.groupBy("doc_id", "_hash", "item_id").agg(*(F.max(c).alias(c) for c in ("score", "question_overlap", "answer_overlap")))


def clean_documents(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text holds a leaked item."""
    keyed = aside(docs, _id=F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0)), _hash=F.xxhash64(text_of()))
    leaked = leaks(docs, items).select(F.coalesce("doc_id", F.lit(0)).alias("_id"), "_hash").distinct()
    return keyed.join(leaked, ["_hash", "_id"], "left_anti").select("_row.*")


def _search(docs: DataFrame, index: Index) -> DataFrame:
    held = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(index))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = pickle.loads(held.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                ids, hashes = some.column(0).to_pylist(), some.column(1).to_pylist()
                rows = [(ids[number], hashes[number], *rest) for number, *rest in index.search([words(t.as_py()) for t in some.column(2)])]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)

    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text_of()).alias("_hash"), text_of().alias("_text"))
    return source.mapInArrow(run, f"doc_id bigint, _hash bigint, {FOUND}")


_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("_hash", pa.int64()), ("item_id", pa.int64())] + [(c, pa.float64()) for c in ("score", "question_overlap", "answer_overlap")]
)


def _indexes(items: DataFrame) -> Iterator[Index]:
    """Indexes of at most about :data:`INDEX_WORDS` words each; items are dealt by hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given = zip(*(c.to_pylist() for c in batch.columns))
            rows = [(hash_, id_, *parts) for id_, hash_, text in given if (parts := parts_of(text))]
            if rows:
                kinds = [pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.string())]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    names = ["_hash", "item_id", "question", "answer"]
    schema = "_hash bigint, item_id bigint, question array<string>, answer array<string>"
    source = items.select(F.col("item_id").cast("bigint").alias("item_id"), F.xxhash64(text_of()).alias("_hash"), text_of().alias("_text"))
    cut = source.distinct().mapInArrow(run, schema)
    cut = stage(cut.withColumn("_key", F.xxhash64("_hash", "item_id")).drop("_hash"), "questions")
    terms = cut.select("_key", F.explode(F.array_distinct("question")).alias("term"))
    frequency = terms.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    per_item = terms.join(frequency, "term").groupBy("_key").agg(F.map_from_entries(F.collect_list(F.struct("term", "df"))).alias("frequency"))
    indexed = stage(cut.join(per_item, "_key"), "index")
    n, asked, total = indexed.agg(F.count(F.lit(1)), F.sum(F.size("question")), F.sum(F.size("question") + F.size("answer"))).first()
    parts = -(-(total or 0) // INDEX_WORDS)
    for part in range(parts):
        yield Index(indexed.where(F.pmod(F.col("_key"), F.lit(parts)) == part).collect(), n, asked / n)
