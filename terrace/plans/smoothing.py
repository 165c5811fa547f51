"""Forecasts by exponential smoothing with trend and season, fitted per series."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.staging import stage

PERIOD = 12
LEVELS, TRENDS, SEASONS = (0.1, 0.3, 0.5, 0.8), (0.0, 0.1, 0.3), (0.0, 0.1, 0.4)


def smoothed_forecast(monthly: DataFrame, keys: Sequence[str], month: str, value: str, ahead: int = 12) -> DataFrame:
    """The ``keys``, ``month``, ``forecast``, ``level_share``, ``trend_share``, ``season_share``: ``ahead`` months after the last one.

    ``monthly`` has one row per series and month; all series reach from the first month of the table to its last, and a month without
    a row counts 0. The first two years set level, trend and season. Each month after the first year is then forecast
    from those before, and its error corrects the level by ``level_share`` of it, the trend by ``trend_share`` of that, and the
    season by ``season_share`` of the error. Of a fixed grid of shares, those with the least sum of squared errors are
    used (ties: the smaller ones). With less than two years there is no row.

    Months of a series are bounded by the calendar, so one series is one row with a list of months, and a fold over it needs no
    window or loop; series are shared by all tasks.
    """
    monthly = stage(monthly, "monthly")
    since, until = (monthly.agg(bound(month)).scalar() for bound in (F.min, F.max))
    held = monthly.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct(month, F.col(value).cast("double")))).alias("_held"))
    held = held.select("*", since.alias("_since"), until.alias("_until"))
    every = F.sequence("_since", "_until", F.expr("INTERVAL 1 MONTH"))
    values = F.transform(every, lambda m: F.coalesce(F.try_element_at("_held", m), F.lit(0.0)))
    series = held.select(*keys, "_until", values.alias("_values")).where(F.size("_values") >= 2 * PERIOD)
    grid = F.array(*(_shares(*found) for found in product(LEVELS, TRENDS, SEASONS)))
    fitted = series.select("*", F.explode(grid).alias("_shares"))
    fitted = fitted.withColumn("_end", _folded(F.col("_values"), F.col("_shares")))
    best = F.min_by(F.struct("_end", "_shares", "_until"), F.struct("_end.errors", "_shares"))
    best = fitted.groupBy(*keys).agg(best.alias("_best")).select(*keys, "_best.*")
    forecasts = [
        F.struct(
            F.add_months("_until", k).alias("month"),
            (F.col("_end.level") + F.lit(float(k)) * F.col("_end.trend") + F.get("_end.season", F.lit((k - 1) % PERIOD))).alias("forecast"),
        )
        for k in range(1, ahead + 1)
    ]
    shares = [F.col(f"_shares.{name}").alias(f"{name}_share") for name in ("level", "trend", "season")]
    return best.select(*keys, F.inline(F.array(*forecasts)), *shares)


def _shares(level: float, trend: float, season: float) -> Column:
    return F.struct(F.lit(level).alias("level"), F.lit(trend).alias("trend"), F.lit(season).alias("season"))


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def _state(level: Column, trend: Column, season: Column, errors: Column) -> Column:
    return F.struct(level.alias("level"), trend.alias("trend"), season.alias("season"), errors.alias("errors"))


def _folded(values: Column, shares: Column) -> Column:
    """Level, trend, the seasons from the next month on, and the sum of squared errors, after the last month."""
    first, second = (_total(F.slice(values, 1 + PERIOD * i, PERIOD)) / F.lit(float(PERIOD)) for i in (0, 1))
    season = F.transform(F.slice(values, 1, PERIOD), lambda x: x - first)
    start = _state(first, (second - first) / F.lit(float(PERIOD)), season, F.lit(0.0))

    def step(state: Column, x: Column) -> Column:
        guess = state["level"] + state["trend"] + F.get(state["season"], F.lit(0))
        error = x - guess
        moved = shares["level"] * error
        turned = F.concat(F.slice(state["season"], 2, PERIOD - 1), F.array(F.get(state["season"], F.lit(0)) + shares["season"] * error))
        return _state(state["level"] + state["trend"] + moved, state["trend"] + shares["trend"] * moved, turned, state["errors"] + error * error)

    return F.aggregate(F.slice(values, PERIOD + 1, F.greatest(F.size(values) - PERIOD, F.lit(0))), start, step)
