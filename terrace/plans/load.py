"""Loads into layered tables, with one audit row per load."""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from terrace.sources.catalog import create_database, read_or_fallback, register_parquet
from terrace.sources.files import drop_other_versions, write_version
from terrace.staging import staged_until_end

AUDIT_SCHEMA = "layer string, table_name string, row_count bigint, seconds double, status string, message string"


class Audit(NamedTuple):
    layer: str
    table_name: str
    row_count: int | None
    seconds: float | None
    status: str
    message: str | None


class LoadFailed(RuntimeError):
    """At least one load failed or was skipped; ``audits`` holds all results."""

    def __init__(self, audits: Sequence[Audit]):
        self.audits = list(audits)
        bad = [f"{a.layer}.{a.table_name} {a.status}: {a.message}" for a in audits if a.status != "ok"]
        super().__init__("; ".join(bad))


@dataclass(frozen=True)
class Warehouse:
    """Tables of all layers below one root folder, registered as ``<prefix><layer>.<name>``."""

    spark: SparkSession
    root: str
    prefix: str = ""

    def table(self, layer: str, name: str) -> str:
        return f"`{self.prefix}{layer}`.`{name}`"

    def path(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{layer}_{name}"

    def create_database(self, layer: str) -> None:
        create_database(self.spark, f"{self.prefix}{layer}", f"{self.root}/{layer}")

    def read(self, layer: str, name: str) -> DataFrame:
        return read_or_fallback(self.spark, self.table(layer, name), self.path(layer, name))

    def save(self, layer: str, name: str, df: DataFrame, partition_by: tuple[str, ...] = ()) -> int:
        """Replace a table by ``df`` and return the number of rows, counted while writing.

        The rows go to a new version; the table is switched to it once it is complete, and only then
        the older versions go. Whatever fails in between leaves the table with its old rows, or the new ones.
        """
        counted = Observation()
        path = self.path(layer, name)
        if partition_by:
            df = df.hint("rebalance", *partition_by)  # few files per folder, large folders split
        fresh = write_version(df.observe(counted, F.count(F.lit(1)).alias("rows")), path, partition_by)
        self.create_database(layer)
        register_parquet(self.spark, self.table(layer, name), fresh, df.schema, partition_by)
        drop_other_versions(self.spark, path, fresh)
        return counted.get["rows"]


@dataclass(frozen=True)
class Load:
    """One table to load. ``needs`` names the ``layer.table`` loads it reads.

    ``sink`` takes the place of :meth:`Warehouse.save` for tables that go elsewhere.
    """

    layer: str
    name: str
    build: Callable[[Warehouse], DataFrame]
    needs: tuple[str, ...] = ()
    sink: Callable[[DataFrame], int] | None = None
    partition_by: tuple[str, ...] = field(default=())


def run_loads(warehouse: Warehouse, steps: Iterable[Sequence[Load]], parallel: int = 4) -> list[Audit]:
    """Run the steps in order, the loads of one step side by side.

    A failed load is recorded and the others go on; a load that needs a failed one is skipped,
    so that it never takes files of an earlier run for new ones.
    """
    audits: list[Audit] = []
    for step in steps:
        for layer in {load.layer for load in step if load.sink is None}:
            warehouse.create_database(layer)  # once, not by each of the threads below
        bad = {f"{a.layer}.{a.table_name}" for a in audits if a.status != "ok"}
        with ThreadPoolExecutor(max_workers=parallel) as pool:
            audits += pool.map(lambda load: _run(warehouse, load, bad), step)
    return audits


def audit_table(spark: SparkSession, audits: Sequence[Audit]) -> DataFrame:
    """The audit rows, one per load, as a table."""
    return spark.createDataFrame(list(audits), AUDIT_SCHEMA)


def _run(warehouse: Warehouse, load: Load, bad: set[str]) -> Audit:
    missed = [need for need in load.needs if need in bad]
    if missed:
        return Audit(load.layer, load.name, None, None, "skipped", "needs " + ", ".join(missed))
    started = time.monotonic()
    try:
        with staged_until_end(warehouse.spark):
            df = load.build(warehouse)
            if load.sink is None:
                rows = warehouse.save(load.layer, load.name, df, load.partition_by)
            else:
                rows = load.sink(df)
    except Exception as error:  # any failure of one table must leave the others running
        return Audit(load.layer, load.name, None, _since(started), "failed", _reason(error))
    return Audit(load.layer, load.name, rows, _since(started), "ok", None)


def _reason(error: Exception) -> str:
    """The error and what caused it, without stack traces."""
    lines = [line.strip() for line in str(error).split("\n")]
    return "; ".join(line for line in lines if line and not re.match(r"at |\.\.\. |Traceback|File |JVM stacktrace", line))[:2000]


def _since(started: float) -> float:
    return round(time.monotonic() - started, 2)
