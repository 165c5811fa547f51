"""Code lists turned into readable labels."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Marker for missing text, and the code lists of the source systems.
MISSING = "n/a"
MARITAL_STATUS = {"S": "Single", "M": "Married"}
GENDER = {"F": "Female", "M": "Male"}
GENDER_WORDS = {"M": "Male", "MALE": "Male", "F": "Female", "FEMALE": "Female"}
PRODUCT_LINE = {"R": "Road", "M": "Mountain", "T": "Touring", "S": "Other Sales"}
COUNTRY = {"DE": "Germany", "US": "United States", "USA": "United States"}


def decode(
    value: Column, labels: Mapping[str, str], default: str | Column | None = MISSING, ignore_case: bool = True
) -> Column:
    """Label of the blank-trimmed code; ``default`` for NULL and for codes not listed."""
    code = F.upper(F.trim(value)) if ignore_case else F.trim(value)
    by_label: dict[str, list[str]] = {}
    for key, label in labels.items():
        by_label.setdefault(label, []).append(key)
    (first, first_keys), *others = by_label.items()
    result = F.when(code.isin(first_keys), first)
    for label, keys in others:
        result = result.when(code.isin(keys), label)
    return result.otherwise(default)


def standardize_country(value: Column, labels: Mapping[str, str] = COUNTRY, missing: str = MISSING) -> Column:
    """Country name; unlisted names pass through trimmed, NULL and blank become ``missing``.

    Codes are matched in their exact case, unlike the other code lists.
    """
    text = F.trim(value)
    passed = F.when(text.isNull() | (text == ""), missing).otherwise(text)
    return decode(value, labels, default=passed, ignore_case=False)


def prefer(first: Column, second: Column, missing: str = MISSING) -> Column:
    """``first`` unless it is missing or NULL, then ``second``, then the marker itself."""
    return F.coalesce(F.nullif(first, F.lit(missing)), second, F.lit(missing))
