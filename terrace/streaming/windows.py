"""Counts per window of event time, kept up by a stream of files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_COUNT, _TOTAL = "n_events", "total"


def count_windows(
    events: DataFrame, time: str, keys: Sequence[str], value: str, width: str, delay: str, sink: str, checkpoint: str, slide: str | None = None
) -> None:
    """Read what has come in since the last run, add it to the open windows, and write those that are closed.

    ``events`` is a stream. Windows of ``width`` (every ``slide``, else side by side) are closed once the latest event is
    ``delay`` past their end; events that come later than that for a closed window are left out of it. The file sink and the
    state store commit per batch, so a run that was stopped and started again writes no window twice and loses none.
    Partial counts are combined before the shuffle, so a hot key or window is a few rows per task.
    """
    timed = events.withColumn("_time", F.col(time).cast("timestamp")).withWatermark("_time", delay)
    window = F.window("_time", width, slide) if slide else F.window("_time", width)
    counted = timed.groupBy(window.alias("window"), *keys).agg(F.count(F.lit(1)).alias(_COUNT), _exact_sum(value).alias(_TOTAL))
    written = counted.select("window.start", *keys, _COUNT, _TOTAL).writeStream.format("parquet").outputMode("append")
    written.option("path", sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def windows(spark: SparkSession, keys: Sequence[T.StructField], sink: str, checkpoint: str) -> DataFrame:
    """``window_start``, the keys, ``n_events``, ``total``, ``closed``: the written windows, and the open ones from the state store."""
    schema = T.StructType([T.StructField("start", T.TimestampType()), *keys, T.StructField(_COUNT, T.LongType()), T.StructField(_TOTAL, T.DecimalType(28, 2))])
    closed = spark.read.schema(schema).parquet(sink).withColumn("closed", F.lit(True))
    state = spark.read.format("statestore").load(checkpoint)
    kept = state.select(
        F.col("key.window.start").alias("start"), *(F.col(f"key.{k.name}") for k in keys), F.col("value.count").alias(_COUNT), F.col("value.sum").alias(_TOTAL)
    )
    found = closed.unionByName(kept.withColumn("closed", F.lit(False)))
    return found.select(F.col("start").cast("timestamp_ntz").alias("window_start"), *(k.name for k in keys), _COUNT, _TOTAL, "closed")


def _exact_sum(value: str) -> Column:
    """A sum in hundredths, whose result does not depend on the order of rows."""
    return F.sum(F.col(value).cast("decimal(18,2)"))
