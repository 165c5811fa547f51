"""Column selection under new names."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def renamed(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """The columns in ``names``, in its order, each under its new name."""
    return df.select(*(F.col(old).alias(new) for old, new in names.items()))
