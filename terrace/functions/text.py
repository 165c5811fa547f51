"""Text repair for names and keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def trim_text(df: DataFrame, *columns: str) -> DataFrame:
    """Remove leading and trailing blanks (blanks only, no tabs) in the named columns."""
    return df.withColumns({name: F.trim(name) for name in columns})


def category_part(key: Column) -> Column:
    """Category id held in the first five characters of a product key, ``AB-CD`` -> ``AB_CD``."""
    return F.translate(F.substring(key, 1, 5), "-", "_")


def product_part(key: Column) -> Column:
    """Product number of a product key: everything after the category and its separator."""
    return F.substring(key, F.lit(7), F.length(key))


def strip_prefix(value: Column, prefix: str) -> Column:
    """``value`` without a leading ``prefix``; other values and NULL stay as they are."""
    rest = F.substring(value, F.lit(len(prefix) + 1), F.length(value))
    return F.when(value.startswith(prefix), rest).otherwise(value)


def strip_separators(value: Column, separators: str = "-") -> Column:
    """``value`` without any of the separator characters."""
    return F.translate(value, separators, "")


def default_if_null(value: Column, default: object = 0) -> Column:
    """``value``, or ``default`` where it is NULL."""
    return F.coalesce(value, F.lit(default))
