"""Repeated events of a stream of files, and those that come too late."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AUDIT_SCHEMA = "batch bigint, input_rows bigint, kept_rows bigint, late_rows bigint, repeated_rows bigint"


def keep_first(events: DataFrame, time: str, keys: Sequence[str], delay: str, sink: str, checkpoint: str, audit: str) -> None:
    """Read what has come in since the last run and write the first event of each key; count the others per batch.

    ``events`` is a stream. An event is late if it is not after the latest event of earlier batches less ``delay``; it is left
    out. Of the others one per key is kept, as long as the key was seen within ``delay`` of that bound, which is what the state
    store holds. A NULL key is a key; an event without a time is kept or repeated, never late.

    Events go to ``sink``, which is as complete after a run that was stopped and started again as without. ``audit`` gets one
    row per batch, with ``kept_rows + late_rows + repeated_rows = input_rows``; the counts of a batch are lost only if the
    run ends between its commit and the end of this function, and its number is then absent.
    """
    timed = events.withColumn("_time", F.col(time).cast("timestamp")).withWatermark("_time", delay)
    first = timed.dropDuplicatesWithinWatermark(list(keys)).drop("_time")
    written = first.writeStream.format("parquet").outputMode("append").option("path", sink).option("checkpointLocation", checkpoint)
    query = written.trigger(availableNow=True).start()
    query.awaitTermination()
    rows = [_counts(p) for p in query.recentProgress if p["stateOperators"]]
    held = [row for row in rows if row[1]]
    if held:
        events.sparkSession.createDataFrame(held, AUDIT_SCHEMA).coalesce(1).write.mode("append").parquet(audit)


def kept(spark: SparkSession, events: DataFrame, sink: str) -> DataFrame:
    """The events written by all runs; ``events`` is the stream or any frame of its columns."""
    return spark.read.schema(events.schema).parquet(sink)


def audits(spark: SparkSession, audit: str) -> DataFrame:
    """Counts per batch of all runs."""
    return spark.read.schema(AUDIT_SCHEMA).parquet(audit)


def _counts(progress) -> tuple[int, int, int, int, int]:
    state = progress["stateOperators"][0]
    late = int(state["numRowsDroppedByWatermark"])
    repeated = int(state["customMetrics"].get("numDroppedDuplicateRows", 0))
    rows = int(progress["numInputRows"])
    return int(progress["batchId"]), rows, int(state["numRowsUpdated"]), late, repeated
