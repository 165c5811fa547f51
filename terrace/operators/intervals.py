"""Interval joins: rows of one key whose periods of days overlap."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.operators import keys
from terrace.staging import stage

#: Day number of an open end.
_OPEN_END = 2**21
#: Of a key, all pairs are tried if these are at most so many for each of its rows on both sides,
TRIES_PER_ROW = 1024
#: and of all keys, if the others have at most so many in all.
FEW_TRIES = 2**26
#: Rows of each side in one block of a cell where many meet; a task tries all pairs of a block.
ROWS_PER_BLOCK = 4096
_MOST_TASKS = 20_000
#: Level of the one cell of a key of which all pairs are tried.
_WHOLE = -1
_CELL = ["key", "within_left", "at", "cell"]
_BLOCK = [*_CELL, "block_a", "block_b"]


def overlapping(left: DataFrame, right: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """``left`` and ``right`` (structs of whole rows) of every pair of one key that has a day in common, each pair once.

    Both ends belong to a period, and a NULL end is open. A period without a start, or that ends before it starts,
    holds no day. Rows without a key meet nothing; repeated rows are different rows.

    Keys of up to some thousand rows are one cell each, in which all pairs are tried. For keys with more rows, days are cut into cells, on
    levels of 1, 2, 4, ... days. Of two periods that overlap, one starts within the other (if both start on one day, the right one within
    the left one), and only there the pair is found. A period is the sum of a few cells, at most two a level, and a start
    lies in one cell of each level that periods of the other side are on. So a start is in a cell of a period once if it is
    within it and never if not: rows that meet are pairs, and none are tried in vain but the second time of those that
    start on one day. What lies before the first or after the last start does not count, so a period that spans everything is one
    cell. A cell where many rows meet is cut into blocks of both sides, so that a hot key, even on one day, is shared.
    """
    kind = left.select(key).unionAll(right.select(key)).schema[0].dataType
    a = _placed(left, key, kind, start, end)
    b = a if right is left else _placed(right, key, kind, start, end)
    crowded, busy, span = _many_rows(a, b)
    rows = 2 * a.count() if right is left else a.count() + b.count()
    if span.n:
        (a, b), (busy_a, busy_b) = ([df.join(busy, "key", how) for df in (a, b)] for how in ("left_anti", "left_semi"))
        busy_a, busy_b, levels = _in_cells(busy_a, busy_b, span)
        rows += span.rows * levels
        if span.cut:
            crowded = crowded.unionAll(_crowded(*(df.join(busy.where("cut"), "key", "left_semi") for df in (busy_a, busy_b))))
        a, b = _as_whole(a).unionAll(busy_a), _as_whole(b).unionAll(busy_b)
    else:
        a, b = _as_whole(a), _as_whole(b)

    known = crowded.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("tries"), F.lit(0)).alias("tries")).first()
    cut = crowded.where("blocks_a > 1 OR blocks_b > 1").drop("tries")
    cut = F.broadcast(cut) if known.n <= keys.MOST_BROADCAST else cut
    # As many tasks as there is work: what a task reads says little about the pairs it tries, so Spark must not join tasks by it.
    work = max(-(-rows // keys.ROWS_PER_RANGE), int((known.tries + span.tries) / ROWS_PER_BLOCK**2))
    tasks = min(_MOST_TASKS, max(left.sparkSession.sparkContext.defaultParallelism, work))
    a, b = (_in_blocks(df, cut, *sides).repartition(tasks, *_BLOCK) for df, sides in ((a, "ab"), (b, "ba")))
    a, b = (df.select(*_BLOCK, *(F.col(c).alias(f"{c}_{side}") for c in ("row", "start", "end"))) for df, side in ((a, "a"), (b, "b")))
    overlap = (F.col("start_a") <= F.col("end_b")) & (F.col("start_b") <= F.col("end_a"))
    once = F.col("within_left") | (F.col("start_a") > F.col("start_b"))
    return a.hint("merge").join(b, _BLOCK).where(overlap & once).select(F.col("row_a").alias("left"), F.col("row_b").alias("right"))


def _placed(df: DataFrame, key: str, kind: T.DataType, start: str, end: str) -> DataFrame:
    """Whole rows with key, first and last day as numbers, written once, and an id that tells copies apart."""
    first, last = F.unix_date(start).cast("bigint"), F.coalesce(F.unix_date(end), F.lit(_OPEN_END)).cast("bigint")
    days = df.select(F.struct("*").alias("row"), F.col(key).cast(kind).alias("key"), first.alias("start"), last.alias("end"))
    return keys.with_row_id(stage(days.where(F.col("key").isNotNull() & (F.col("start") <= F.col("end"))), "periods"))


def _many_rows(a: DataFrame, b: DataFrame) -> tuple[DataFrame, DataFrame, Row]:
    """Keys with many pairs as whole cells; busy keys, which have too many for that, and if their cells may have to be cut; and the
    number of these, their rows, how many are to be cut, the pairs of the others, and the days that they start on."""
    of_a, of_b = (
        df.groupBy("key").agg(F.count(F.lit(1)).alias(f"n_{side}"), F.min("start").alias(f"first_{side}"), F.max("start").alias(f"last_{side}"))
        for df, side in ((a, "a"), (b, "b"))
    )
    rows, tries = F.col("n_a") + F.col("n_b"), F.col("n_a").cast("double") * F.col("n_b")
    counted = of_a.join(of_b, "key").withColumn("tries", tries).where(F.col("tries") > ROWS_PER_BLOCK)
    many = stage(counted.withColumns({"busy": F.col("tries") > TRIES_PER_ROW * rows, "cut": F.greatest("n_a", "n_b") > ROWS_PER_BLOCK}), "keys")
    total = lambda n: F.coalesce(F.sum(n), F.lit(0))
    ends = [f(f"{end}_{side}").alias(f"{end}_{side}") for end, f in (("first", F.min), ("last", F.max)) for side in "ab"]
    sums = [total(rows).alias("rows"), F.count_if("cut").alias("cut"), total(F.when(~F.col("cut"), F.col("tries"))).alias("tries"), total("tries").alias("all_tries")]
    span = many.where("busy").agg(F.count(F.lit(1)).alias("n"), *sums, *ends).first()
    if span.all_tries <= FEW_TRIES:
        many, span = many.withColumn("busy", F.lit(False)), Row(**span.asDict() | {"n": 0, "tries": 0})
    cells, busy = _cells(many.where("NOT busy"), True, _WHOLE).select(*_CELL, *_blocks(), "tries"), many.where("busy").select("key", "cut")
    return cells, F.broadcast(busy) if span.n <= keys.MOST_BROADCAST else busy, span


def _crowded(a: DataFrame, b: DataFrame) -> DataFrame:
    """Cells where many rows meet."""
    each = a.select(*_CELL, F.lit(1).alias("a"), F.lit(0).alias("b")).unionAll(b.select(*_CELL, F.lit(0), F.lit(1)))
    counted = each.groupBy(*_CELL).agg(F.sum("a").alias("n_a"), F.sum("b").alias("n_b")).withColumn("tries", F.col("n_a").cast("double") * F.col("n_b"))
    return stage(counted.where(F.col("tries") > ROWS_PER_BLOCK).select(*_CELL, *_blocks(), "tries"), "crowded")


def _blocks() -> list[Column]:
    return [F.ceil(F.col(f"n_{side}") / ROWS_PER_BLOCK).cast("int").alias(f"blocks_{side}") for side in "ab"]


def _in_blocks(df: DataFrame, cut: DataFrame, own: str, other: str) -> DataFrame:
    """Each row in one block of its own side, once for each block of the other side."""
    blocks = {side: F.coalesce(f"blocks_{side}", F.lit(1)) for side in (own, other)}
    found = df.join(cut, _CELL, "left").withColumn(f"block_{own}", F.pmod(keys.ROW_ID, blocks[own]).cast("int"))
    return found.withColumn(f"block_{other}", F.explode(F.sequence(F.lit(0), blocks[other] - 1)))


def _cells(df: DataFrame, within_left: bool, at: int) -> DataFrame:
    return df.withColumns({"within_left": F.lit(within_left), "at": F.lit(at), "cell": F.lit(0).cast("bigint")})


def _as_whole(placed: DataFrame) -> DataFrame:
    return _cells(placed, True, _WHOLE).select(*_CELL, "row", "start", "end", keys.ROW_ID)


def _in_cells(a: DataFrame, b: DataFrame, span: Row) -> tuple[DataFrame, DataFrame, int]:
    """Rows of both sides in the cells of their periods and those of their starts, and the number of levels."""
    bounds_a, bounds_b = (span.first_a, span.last_a), (span.first_b, span.last_b)
    periods_a, periods_b = _periods(a, *bounds_b, True), _periods(b, *bounds_a, False)
    levels = periods_a.select("within_left", "at").unionAll(periods_b.select("within_left", "at")).distinct().collect()
    starts_a = _starts(a, *bounds_a, [r.at for r in levels if not r.within_left], False)
    starts_b = _starts(b, *bounds_b, [r.at for r in levels if r.within_left], True)
    return periods_a.unionAll(starts_a), periods_b.unionAll(starts_b), len(levels)


def _top(first: int, last: int) -> tuple[int, int]:
    """The level of a cell for all days from first to last, and its first day; its last one is the last."""
    top = (last - first).bit_length()
    return top, last + 1 - (1 << top)


def _shifted(day: Column) -> Column:
    return F.call_function("shiftright", day, F.col("at"))


def _periods(placed: DataFrame, first: int, last: int, within_left: bool) -> DataFrame:
    """Rows in the cells that make up their period, as far as the other side has starts, from first to last."""
    top, origin = _top(first, last)
    near = placed.where((F.col("start") <= last) & (F.col("end") >= first)).withColumns({
        "low": F.when((F.col("start") > first) | (F.col("end") < last), F.greatest("start", F.lit(first)) - origin).otherwise(0),
        "past": F.least("end", F.lit(last)) + 1 - origin,
        "at": F.explode(F.lit([*range(top + 1)])),
    })
    # Of the cells from low until before past, those that are no half of a cell of the next level within the period.
    cells = near.withColumns({"low": -_shifted(-F.col("low")), "past": _shifted(F.col("past"))}).where("low < past")
    ends = F.array(F.when(F.col("low") % 2 == 1, F.col("low")), F.when(F.col("past") % 2 == 1, F.col("past") - 1))
    each = cells.withColumns({"within_left": F.lit(within_left), "cell": F.explode(ends)}).where(F.col("cell").isNotNull())
    return each.select(*_CELL, "row", "start", "end", keys.ROW_ID)


def _starts(placed: DataFrame, first: int, last: int, levels: Collection[int], within_left: bool) -> DataFrame:
    """Rows in the cells of their first day on the given levels."""
    each = placed.withColumns({"within_left": F.lit(within_left), "at": F.explode(F.array(*(F.lit(n) for n in sorted(levels))).cast("array<int>"))})
    return each.withColumn("cell", _shifted(F.col("start") - _top(first, last)[1])).select(*_CELL, "row", "start", "end", keys.ROW_ID)
