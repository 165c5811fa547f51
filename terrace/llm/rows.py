"""What the operators share: whole input rows kept aside, and the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROW = "_row"
#: Separators of words: space, and the control characters tab to carriage return.
BLANK = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def aside(docs: DataFrame, **columns: str | Column) -> DataFrame:
    """``docs`` as one struct column beside the named ones, so that no input name can clash with a computed one."""
    return docs.select(F.struct("*").alias(ROW), *(F.col(c).alias(n) if isinstance(c, str) else c.alias(n) for n, c in columns.items()))


def fixed(df: DataFrame, *plain: str) -> DataFrame:
    """``df`` with columns that later filters find computed, except for the ``plain`` ones.

    A filter on a column is otherwise pushed below the steps that compute it, and computes all of
    them again, lists anew for each of their elements. It is not pushed below an outer generator.
    """
    computed = [c for c in df.columns if c not in plain]
    return df.select(*plain, F.inline_outer(F.array(F.struct(*computed)))).select(*df.columns)


def text_of(column: str = "text") -> Column:
    """The text, empty if NULL."""
    return F.coalesce(F.col(column), F.lit(""))


def words_of(text: Column) -> Column:
    """Words in order: what lies between blanks."""
    return F.filter(F.split(text, f"{BLANK}+"), lambda w: w != "")
