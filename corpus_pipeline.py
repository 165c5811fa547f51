"""The training-text pipeline: each stage works on all that the one before kept.

``run`` writes the result of each stage as Parquet below ``spark.checkpoint.dir`` and reads it
again, so a lost executor repeats tasks of one stage only. What a stage wrote for itself goes when it ends, and
its result when the next one is complete.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from terrace.llm import decontaminate, lines, quality, sequences, simhash
from terrace.llm.rows import table
from terrace.sources import folders
from terrace.staging import scratch_path, staged_until_end


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule of the current policy rejects."""
    return quality.kept_documents(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that repeat three-line windows."""
    return lines.cleaned_documents(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints."""
    return simhash.one_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all pieces of the remaining documents in sequences."""
    return sequences.packed(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("simhash_dedup", simhash_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: SQL has neither the fingerprints nor the tokenizer; tests hold the rows against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of the documents that pass all stages."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, step in STAGES:
        path = scratch_path(spark, name)
        with staged_until_end(spark):
            step(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before is not None:
            folders.delete(spark, before)
        before = path
    return docs
