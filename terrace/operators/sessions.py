"""Sessions: events of one user with no long break between them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.operators.ordered import in_ranges, with_earlier, with_running_sum
from terrace.staging import stage


def sessions(events: DataFrame, user: str, time: str, gap: str, measures: Sequence[Column] = ()) -> DataFrame:
    """``user``, ``session_start``, ``session_end``, ``n_events`` and the ``measures`` (aggregates) of each session.

    A session goes on as long as each event comes within ``gap`` (an interval such as ``30 minutes``) of the one before.
    Events without a user are one user; events without a time are left out.

    The events are ordered by user and time in ranges. A row begins a session if the row before it, also that of an earlier
    range, is of another user or too old; a running count of beginnings numbers the sessions. So a user with a third of
    all events, or a session that goes on over several ranges, is shared by tasks and met again only as partial sums.
    """
    placed = in_ranges(events.where(F.col(time).isNotNull()), [user, time])
    before = with_earlier(placed, F.struct(F.col(user).alias("user"), F.col(time).alias("time")), "_before")
    goes_on = F.col("_before.user").eqNullSafe(F.col(user)) & (F.col(time) <= F.col("_before.time") + F.expr(f"INTERVAL {gap}"))
    begins = F.when(F.col("_before").isNotNull() & goes_on, 0).otherwise(1).cast("bigint")
    numbered = with_running_sum(stage(before.withColumn("_begins", begins).drop("_before"), "beginnings"), "_begins", "_session")
    return (
        numbered.groupBy("_session", user)
        .agg(F.min(time).alias("session_start"), F.max(time).alias("session_end"), F.count(F.lit(1)).alias("n_events"), *measures)
        .drop("_session")
    )
