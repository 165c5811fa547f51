"""Written intermediate tables in the folder all executors share."""

from __future__ import annotations

import functools
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from terrace.sources import folders

_open = threading.local()


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``.

    A local session without the setting gets a temporary folder. A cluster session without it
    is an error: a machine-local folder would be out of reach of the other executors.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    return _local_dir(spark.sparkContext.applicationId)


@functools.cache
def _local_dir(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"terrace-{application}-")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below :func:`shared_dir`."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet to a new shared path and return the scan of it.

    The lineage ends at the files, so a lost executor costs a re-read and not a re-computation,
    and a later pass over a few columns reads only these.
    """
    path = scratch_path(df.sparkSession, label)
    if getattr(_open, "paths", None) is not None:
        _open.paths.append(path)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def staged_until_end(spark: SparkSession) -> Iterator[None]:
    """Delete the tables that this thread stages inside the block when the block ends.

    Frames that read them have to be written out inside the block. Without such a block staged
    tables stay, since a frame returned to the caller may still read them.
    """
    outer = getattr(_open, "paths", None)
    _open.paths = []
    try:
        yield
    finally:
        paths, _open.paths = _open.paths, outer
        for path in paths:
            folders.delete(spark, path)
