"""A type-2 history that takes in changes without being built again."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.operators.history import close_versions
from terrace.sources import files
from terrace.sources.folders import names

_BUCKET = "_bucket"


@dataclass(frozen=True)
class History:
    """Versions of keys, from ``start`` to the derived ``end``, below a folder.

    Rows lie in ``buckets`` folders by a hash of the key. A version of the small table ``folders`` says where each bucket is; writers add
    folders and then such a version, so readers find the old state or the new one, and what a merge does not touch
    stays in the same files. ``tie_break`` tells the versions of one key and start apart.
    """

    spark: SparkSession
    root: str
    schema: T.StructType
    key: str
    start: str
    end: str
    tie_break: Sequence[str]
    buckets: int = 64

    def load(self, versions: DataFrame) -> None:
        """Replace the whole history."""
        self._register(self._write(versions), keep={})

    def merge(self, delta: DataFrame) -> list[int]:
        """Take in new and corrected versions; returns the buckets that were written.

        A version with the key, start and tie-break of an existing one replaces it. Only the buckets of the delta's keys are read, and their
        versions closed again. Without rows nothing changes. Of a delta, each version has to be there once.
        """
        touched = sorted(r[0] for r in delta.select(self._bucket()).distinct().collect())  # at most so many as there are buckets
        if not touched:
            return []
        same = [self.key, self.start, *self.tie_break]
        folders = self.folders()
        held = self._read([folders[b] for b in touched if b in folders])
        known = delta.select(*(F.col(c).alias(f"_new_{c}") for c in same))
        matches = [(F.to_date(c) if c == self.start else F.col(c)).eqNullSafe(F.to_date(f"_new_{c}") if c == self.start else F.col(f"_new_{c}")) for c in same]
        joined = matches[0]
        for match in matches[1:]:
            joined = joined & match
        kept = held.join(known, joined, "left_anti")
        rows = kept.drop(self.end).unionByName(delta.select(*kept.drop(self.end).columns))
        written = self._write(rows)
        self._register(written, keep={b: f for b, f in folders.items() if b not in touched})
        return touched

    def read(self) -> DataFrame:
        return self._read(list(self.folders().values()))

    def folders(self) -> dict[int, str]:
        """Where each bucket is: one small row per bucket."""
        listed = files.current_version(self.spark, f"{self.root}/folders")
        if listed is None:
            return {}
        return {r.bucket: r.folder for r in self.spark.read.schema("bucket int, folder string").parquet(listed).collect()}

    def _read(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*folders)

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int").alias(_BUCKET)

    def _write(self, versions: DataFrame) -> dict[int, str]:
        closed = close_versions(versions, self.key, self.start, self.end, self.tie_break).select(*self.schema.names, self._bucket())
        folder = f"{self.root}/rows-{uuid.uuid4().hex}"
        closed.hint("rebalance", _BUCKET).write.partitionBy(_BUCKET).parquet(folder)
        found = [n for n in names(self.spark, folder) if n.startswith(f"{_BUCKET}=")]
        return {int(n.split("=")[1]): f"{folder}/{n}" for n in found}

    def _register(self, written: dict[int, str], keep: dict[int, str]) -> None:
        rows = sorted((keep | written).items())
        files.write_version(self.spark.createDataFrame(rows, "bucket int, folder string").coalesce(1), f"{self.root}/folders")
