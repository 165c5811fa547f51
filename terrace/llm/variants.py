"""Spelling variant grouping: words of a corpus one edit apart, by a walk of all words through a trie of all words.

The trie is a table of edges (parent node, label, child node). A state (word, position, node, edits) says that so
many characters of the word lead to that node. Level by level all states are joined with the edges below their
nodes. As two words one edit apart agree before and behind the edit, each is in the trie twice, from
its start and from its end, and a walk starts at the node of its first half: the edit is then in the second half of one of
the two. Up to that node, a state without an edit is the word's own prefix; behind its edit a state follows the word.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.staging import scratch_path, stage

#: Letters, from the ninth byte-wide block of the alphabet on too; only A-Z are lower-cased.
RUN = "[A-Za-zÀ-ÿ]+"
#: One of so many occurrences, chosen by a hash, loses a character.
ONE_IN = 31
LEAST_LENGTH, LEAST_COUNT, TIMES = 7, 2, 10
#: Edges to this depth have one character, deeper ones twice as many from level to level, so that words of any length end soon.
SINGLE = 36
_FLUSH = 300_000
_START, _END = ">", "<"


def word_counts(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``word``, ``n``: all runs of letters, some with a character less, and how often they occur in all documents.

    A NULL text has none, and a NULL id is spelt as no characters. Tasks send one row per word, as long as they can hold all of theirs.
    """

    def counted(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        runs = re.compile(RUN).findall
        for batch in batches:
            for id_, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                named = zlib.crc32(b"%s:" % (b"" if id_ is None else b"%d" % id_))
                # bytes.lower() lower-cases A-Z only. Equal runs of one document have equal hashes.
                for word, n in Counter(runs((text.as_py() or b"").lower().decode())).items():
                    hash_ = zlib.crc32(word.encode(), named)
                    if hash_ % ONE_IN == 0:
                        at = hash_ % len(word)
                        word = word[:at] + word[at + 1 :]
                    counts[word] += n
                if len(counts) > _FLUSH:
                    yield counted(counts)
                    counts.clear()
        yield counted(counts)

    source = docs.select(F.col(id).cast("bigint").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    return source.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def grouped(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n`` of each word of a corpus.

    Words have :data:`LEAST_LENGTH` characters and :data:`LEAST_COUNT` occurrences or more. The form of a word is the most
    frequent word near it, of equal ones the first in code-point order, if it occurs at least
    :data:`TIMES` times as often, and the root is where the forms end. Without a word the result is empty; repeated rows count
    like others, and texts of any length are read whole.
    """
    words = word_counts(docs, id, text).where((F.length("word") >= LEAST_LENGTH) & (F.col("n") >= LEAST_COUNT))
    return with_forms(stage(words, "words"))


def with_forms(words: DataFrame) -> DataFrame:
    """``words`` (a written table of ``word``, ``n``) with ``form``, ``root``, ``n_near``, ``form_n``."""
    pairs = neighbours(words)
    counts = lambda side: words.select(F.col("word").alias(side), F.col("n").alias(f"n_{side}"))
    counted = stage(pairs.join(counts("a"), "a").join(counts("b"), "b"), "near_words")
    near = counted.select(F.col("a").alias("word"), F.col("n_a").alias("n"), F.col("b").alias("near"), F.col("n_b").alias("near_n"))
    near = near.unionAll(counted.select("b", "n_b", "a", "n_a"))
    many = near.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"))
    form = near.where(F.col("near_n") >= TIMES * F.col("n")).groupBy("word").agg(F.min(F.struct((-F.col("near_n")).alias("n"), "near")).alias("form"))
    forms = stage(form.select("word", F.col("form.near").alias("form"), (-F.col("form.n")).alias("form_n")), "forms")
    found = words.join(many, "word", "left").join(forms, "word", "left").join(_roots(forms), "word", "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), "form_n")


def _roots(forms: DataFrame) -> DataFrame:
    """``word``, ``root`` of each word with a form. Each step is twice as far, and counts grow tenfold, so there are few."""
    current = forms.select("word", F.col("form").alias("root"))
    while True:
        further = current.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = stage(current.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        current = moved.select("word", "root")
        if not moved.where("moved").head(1):
            return current


def neighbours(words: DataFrame) -> DataFrame:
    """``a``, ``b``: the pairs of different words one edit apart, each once. ``words`` is written and its words are distinct.

    A word with an edit leaves the trie at the first character that no word goes on with. Edges tell which characters follow below them, how
    many are left to the ends of words, and how these end, so most states end before they are rows. Of two
    words of equal length the smaller one is changed, of others the longer one is shortened, and a repeated character is
    deleted in its last place, so a pair is found once or twice. A level's states are written, so a lost executor costs one level. Nodes are 64-bit hashes; what the
    walk finds is compared as text in the end.
    """
    half = (F.length("word") / 2).cast("int")
    there = words.select(F.concat(F.lit(_START), "word").alias("s"), F.length("word").alias("length"), half.alias("half"))
    back = words.select(F.concat(F.lit(_END), F.reverse("word")), F.length("word"), F.length("word") - half)
    # The first character is the direction, so that both tries are one table.
    strings = stage(there.unionAll(back).select("s", (F.col("length") + 1).alias("length"), (F.col("half") + 1).alias("start")), "strings")
    longest = strings.agg(F.max("length")).first()[0] or 0
    levels = _levels(longest)
    if not levels:
        return words.select(F.col("word").alias("a"), F.col("word").alias("b")).where(F.lit(False))
    edges = scratch_path(words.sparkSession, "edges")
    _edges(strings, levels).write.partitionBy("level").parquet(edges)
    edges = words.sparkSession.read.schema("parent bigint, label string, child bigint, next bigint, ends bigint, tails bigint, level int").parquet(edges)
    end = F.col("length") - 1
    found = [strings.where(end >= LEAST_LENGTH + 1).select("s", _node("s", end).alias("node"))]  # the last character deleted
    states = None
    for level, (depth, size) in enumerate(levels):
        below = edges.where(F.col("level") == level).drop("level")
        made = _edited(strings, below, depth, size)
        if states is not None:
            made = made.unionAll(_followed(states, below, depth, size))
        # A state: word, its length, how many of its characters are read, and the node that they led to.
        states = stage(made, "states")
        found.append(states.where("at = length").select("s", "node"))
        states = states.where("at < length")
    words_at = strings.select(_node("s", F.col("length")).alias("node"), F.col("s").alias("other"))
    met = reduce(DataFrame.unionAll, found).join(words_at, "node")
    plain = lambda s: F.when(F.col(s).startswith(_END), F.reverse(_from(s, 1))).otherwise(_from(s, 1))
    both = met.select(plain("s").alias("x"), plain("other").alias("y")).where(F.levenshtein("x", "y", 1) == 1)
    return both.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _levels(longest: int) -> list[tuple[int, int]]:
    """Depth and size of the edges of each level, from the first at which a word may be changed."""
    found, depth, size = [], LEAST_LENGTH // 2 + 1, 1
    while depth < longest:
        found.append((depth, size))
        depth, size = depth + size, size if depth < SINGLE else 2 * size
    return found


def _edges(strings: DataFrame, levels: list[tuple[int, int]]) -> DataFrame:
    """The edges of words behind their halves: what no walk can reach is left out."""
    first, singles = levels[0][0], sum(size == 1 for _, size in levels)
    deep = first + singles
    to = F.least(F.col("length"), F.lit(deep)) - 1
    cut = strings.where(F.col("start") < deep).select("s", "length", F.explode(F.sequence("start", to)).alias("depth"))
    cut = cut.select("s", "length", (F.col("depth") - first).alias("level"), "depth", F.lit(1).alias("size"))
    if singles < len(levels):
        named = [F.struct(F.lit(k).alias("level"), F.lit(d).alias("depth"), F.lit(n).alias("size")) for k, (d, n) in enumerate(levels) if n > 1]
        wanted = F.filter(F.array(*named), lambda c: (c["depth"] < F.col("length")) & (c["depth"] + c["size"] > F.col("start")))
        cut = cut.unionAll(strings.where(F.col("length") > deep).select("s", "length", F.explode(wanted).alias("c")).select("s", "length", "c.*"))
    until = F.least(F.col("depth") + F.col("size"), F.col("length"))
    bit = lambda i: F.call_function("shiftleft", F.lit(1).cast("bigint"), i.cast("int"))
    return cut.select(
        "level",
        _node("s", F.col("depth")).alias("parent"),
        _part("s", F.col("depth"), F.col("size")).alias("label"),
        _node("s", until).alias("child"),
        F.when(until < F.col("length"), bit(_code(_part("s", until, F.lit(1))))).otherwise(F.lit(0).cast("bigint")).alias("next"),
        bit(F.least(F.col("length") - until, F.lit(62))).alias("ends"),
        bit(_tail("s")).alias("tails"),
    ).groupBy("level", "parent", "label", "child").agg(F.bit_or("next").alias("next"), F.bit_or("ends").alias("ends"), F.bit_or("tails").alias("tails"))


def _edited(strings: DataFrame, below: DataFrame, depth: int, size: int) -> DataFrame:
    """States after an edit in this level, of words that have read their own characters so far."""
    here = strings.where((F.col("length") > depth) & (F.col("start") < depth + size)).select("s", "length", _node("s", F.lit(depth)).alias("parent"))
    own = lambda n: _part("s", F.lit(depth), n)
    long = F.length("label")
    if size == 1:
        changed = F.col("label") > own(F.lit(1))
        shortened = (F.col("label") == _part("s", F.lit(depth + 1), F.lit(1))) & (F.col("label") != own(F.lit(1)))
    else:
        changed = (F.col("label") > own(long)) & (F.length(own(long)) == long) & (F.levenshtein(F.col("label"), own(long), 1) == 1)
        shortened = (F.length(own(long + 1)) == long + 1) & (F.levenshtein(F.col("label"), own(long + 1), 1) == 1)
    as_changed, as_shortened = (F.lit(depth) + long), (F.lit(depth) + long + 1)
    one = changed & _goes_on(as_changed)
    other = shortened & _goes_on(as_shortened)
    met = here.join(below, (here.parent == below.parent) & (one | other))
    at = F.explode(F.array_compact(F.array(F.when(one, as_changed), F.when(other, as_shortened))))
    return met.select("s", "length", at.alias("at"), F.col("child").alias("node"))


def _followed(states: DataFrame, below: DataFrame, depth: int, size: int) -> DataFrame:
    """States one level on: the edge has to say what the word says. A word with a character less is one ahead of its node."""
    own = _part("s", F.col("at"), F.lit(size))
    met = states.withColumn("own", own).join(below, (F.col("node") == below.parent) & (F.col("own") == below.label) & _goes_on(F.col("at") + F.length("label")))
    return met.select("s", "length", (F.col("at") + F.length("own")).alias("at"), F.col("child").alias("node"))


def _goes_on(at: Column) -> Column:
    """Whether a word that reads the rest of the string, from ``at`` on, may be below the edge."""
    left = F.col("length") - at
    has = lambda mask, bit: F.call_function("shiftrightunsigned", F.col(mask), bit).bitwiseAND(F.lit(1).cast("bigint")) == 1
    follows = (left == 0) | has("next", _code(_part("s", at, F.lit(1))))
    return (left >= 0) & has("ends", F.greatest(F.least(left, F.lit(62)), F.lit(0))) & follows & ((left < 3) | has("tails", _tail("s")))


def _code(char: Column) -> Column:
    """A character as one of 64 bits: the letters a to z have their own."""
    point = F.ascii(char)
    return F.when(point.between(97, 122), point - 97).otherwise(F.lit(26) + point % 38)


def _tail(s: str) -> Column:
    """The last three characters as one of 64 bits."""
    return F.xxhash64(F.right(F.col(s), F.lit(3))).bitwiseAND(F.lit(63).cast("bigint")).cast("int")


def _node(s: str, depth: Column) -> Column:
    return F.xxhash64(F.substr(F.col(s), F.lit(1), depth.cast("int")))


def _part(s: str, start: Column, size: Column) -> Column:
    return F.substr(F.col(s), (start + 1).cast("int"), size.cast("int"))


def _from(s: str, start: int) -> Column:
    return F.substr(F.col(s), F.lit(start + 1))
