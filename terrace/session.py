"""Session builder for scripts, tests and the bench."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(app: str = "terrace", master: str | None = None, hive: bool = False, **conf: str) -> SparkSession:
    """Get or create a session; ``conf`` keys use ``__`` for dots.

    On a cluster leave ``master`` unset, so that ``spark-submit`` decides. ``hive`` turns on
    the Hive catalog of the site. Lookups whose right side comes to less than 64 MB per shuffle
    partition are hash joins, which spares sorting the large left side.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "64m")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    if hive:
        builder = builder.enableHiveSupport()
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()
