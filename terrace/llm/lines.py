"""Line dedup: three-line windows that occur elsewhere before are removed.

A window is three consecutive lines that hold a word; blank lines lie between windows and stay. Of
all places where a window occurs, the one in the smallest document (by ``doc_id``, NULL first, then
by a hash of the text) and there at the lowest line stays; the lines of the others go, and places
that overlap are merged. Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm.rows import BLANK, aside, fixed, text_of
from terrace.operators.keys import ROW_ID, with_row_id
from terrace.staging import stage

WINDOW = 3


def without_repeated_lines(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``_row``, the cleaned ``text``, ``n_lines`` and ``n_removed`` (lines); one row per input row.

    A NULL text counts as empty and stays NULL. Of rows equal in id and text, a NULL id included, one counts as the first, and
    the others lose all their windows. A text of fewer than three lines with words keeps them all.

    Three passes over the texts, and one over their places. Windows are combined to one row per hash on
    the map side, so a window that a third of the rows share arrives as one row per task. They are
    told apart by two 64-bit hashes. The two joins can be split at run time: one row per window on one
    side, and one row per document on the other. Only rows equal in id and text are written, to tell which is the first of them.
    """
    placed = _placed(docs, id, text)
    read = _with_windows(placed)
    # Outer: an inner explode filters the texts by the lists to come, and so computes them twice.
    first = (
        read.select("_place", F.explode_outer(F.array_distinct("_windows")).alias("_w"))
        .where("_w is not null")
        .groupBy(F.col("_w.a").alias("_a"), F.col("_w.b").alias("_b"))
        .agg(F.min("_place").alias("_first"), F.max("_place").alias("_last"))
        .where("_first < _last")
        .select("_a", "_b", "_first")
    )
    later = (
        read.select("_place", F.posexplode_outer("_windows").alias("_at", "_w"))
        .select("_place", "_at", F.col("_w.a").alias("_a"), F.col("_w.b").alias("_b"))
        .join(first, ["_a", "_b"])
        .where("_place > _first")
        .groupBy(F.col("_place").alias("_later_place"))
        .agg(F.collect_set("_at").alias("_later"))
    )
    none = F.array().cast("array<int>")
    all_ = F.when(F.size("_windows") > 0, F.sequence(F.lit(0), F.size("_windows") - 1)).otherwise(none)
    starts = F.when(F.col("_again"), all_).otherwise(F.concat(F.coalesce("_later", none), _repeats_inside()))
    # Only the rows themselves are shuffled; lines and windows are cut again behind the join.
    joined = _numbered(placed).join(later, F.col("_place") == F.col("_later_place"), "left")
    marked = _with_windows(joined, "_later", "_again").withColumn("_starts", starts)
    covered = F.flatten(F.transform("_starts", lambda i: F.sequence(i, i + (WINDOW - 1))))
    removed = F.array_distinct(F.transform(covered, lambda i: F.get("_solid", i)["at"]))
    marked = marked.withColumn("_removed", F.when(F.size("_starts") > 0, removed).otherwise(none))
    left = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), "_removed")
    cleaned = F.array_join(F.transform(left, lambda i: F.get("_lines", i)), "\n")
    found = marked.select(
        "_row",
        F.when(F.size("_removed") == 0, F.col("_given")).otherwise(cleaned).alias("text"),
        F.size("_lines").cast("bigint").alias("n_lines"),
        F.size("_removed").cast("bigint").alias("n_removed"),
    )
    return fixed(found, "_row")


def cleaned_documents(docs: DataFrame) -> DataFrame:
    """``docs`` with cleaned texts and their lengths in ``n_chars``; no row goes, even if its text becomes empty."""
    fresh = {"text": F.col("text"), "n_chars": F.coalesce(F.length("text").cast("bigint"), F.col("_row.n_chars"))}
    return without_repeated_lines(docs).select(*(fresh.get(c, F.col("_row")[c]).alias(c) for c in docs.columns))


def _placed(docs: DataFrame, id: str, text: str) -> DataFrame:
    return aside(docs, _place=_place(F.col(id), text_of(text))).withColumn("_given", F.col("_row")[text])


def _numbered(placed: DataFrame) -> DataFrame:
    """``placed`` and ``_again``: whether the row is another one of the same id and text, and not the first of them.

    Places are counted without the rows. Where ids tell texts apart, no place occurs twice, and nothing else is done.
    """
    twice = stage(placed.groupBy(F.col("_place").alias("_twice")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_twice"), "places")
    if twice.isEmpty():
        return placed.withColumn("_again", F.lit(False))
    same = F.col("_place") == F.col("_twice")
    rows = with_row_id(stage(placed.join(twice, same, "left_semi"), "repeated_rows"))
    kept = rows.groupBy(F.col("_place").alias("_twice")).agg(F.min(ROW_ID).alias("_kept"))
    again = rows.join(kept, same).select(*placed.columns, (F.col(ROW_ID) != F.col("_kept")).alias("_again"))
    return placed.join(twice, same, "left_anti").withColumn("_again", F.lit(False)).unionAll(again)


def _with_windows(placed: DataFrame, *more: str) -> DataFrame:
    lines = F.split(text_of("_given"), "\n")
    numbered = F.transform("_lines", lambda line, i: F.struct(line.alias("line"), i.alias("at")))
    solid = F.filter(numbered, lambda x: x["line"].rlike(BLANK.replace("[", "[^")))
    windows = F.transform(F.sequence(F.lit(1), F.size("_solid") - (WINDOW - 1)), _window)
    return (
        placed.select("_row", "_given", "_place", *more, lines.alias("_lines"))
        .withColumn("_solid", solid)
        .withColumn("_windows", F.when(F.size("_solid") >= WINDOW, windows).otherwise(F.array().cast("array<struct<a:bigint,b:bigint>>")))
    )


def _window(i: Column) -> Column:
    """Two hashes of the lines of a window: by chance alone, 64 bits would make some of 10^12 windows equal."""
    lines = F.slice("_solid.line", i, WINDOW)
    return F.struct(F.xxhash64(lines).alias("a"), F.xxhash64(F.lit(1), lines).alias("b"))


def _place(id: Column, text: Column) -> Column:
    """One number that orders documents by id, then by a hash of the text.

    The id fills the upper digits of a 38-digit decimal and 62 bits of hash the lower ones; unlike
    a struct, a decimal is aggregated in place by hash. A NULL id counts as the smallest number.
    """
    wide = F.coalesce(id.cast("bigint"), F.lit(-(2**63))).cast("decimal(20,0)")
    low = F.shiftrightunsigned(F.xxhash64(text), 2).cast("decimal(19,0)")
    return (wide * F.lit(2**62).cast("decimal(19,0)") + low).cast("decimal(38,0)")


def _repeats_inside() -> Column:
    """Places of windows that occurred earlier in the same text."""
    twice = F.size(F.array_distinct("_windows")) < F.size("_windows")
    numbered = F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    # Neighbours of the sorted places are paired, so the sorted list is computed once.
    pairs = F.transform(
        F.array(numbered),
        lambda s: F.filter(
            F.arrays_zip(F.slice(s, 1, F.size(s) - 1).alias("a"), F.slice(s, 2, F.size(s) - 1).alias("b")),
            lambda p: p["a"]["h"] == p["b"]["h"],
        ),
    )
    return F.when(twice, F.transform(F.flatten(pairs), lambda p: p["b"]["i"])).otherwise(F.array().cast("array<int>"))
