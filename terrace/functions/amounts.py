"""Repair of amount, quantity and price against each other."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def common_number(kinds: Sequence[T.DataType]) -> str:
    """The type to compute in: double if there is one, else a decimal of the largest scale, else bigint."""
    if any(isinstance(k, T.DoubleType | T.FloatType) for k in kinds):
        return "double"
    scales = [k.scale for k in kinds if isinstance(k, T.DecimalType)]
    return f"decimal(18,{min(6, max(scales))})" if scales else "bigint"


def repair_amount(amount: Column, quantity: Column, price: Column, number: str = "bigint") -> Column:
    """The amount if it is positive and not contradicted, else quantity times absolute price.

    An unknown product contradicts nothing, so a positive amount then stays. ``number`` is the
    type of the result (:func:`common_number`); ``bigint`` keeps integers from overflowing under ANSI.
    """
    held, expected = amount.cast(number), (quantity.cast(number) * F.abs(price.cast(number))).cast(number)
    agrees = F.coalesce(held == expected, F.lit(True))
    return F.when((held > 0) & agrees, held).otherwise(expected)


def repair_price(price: Column, quantity: Column, repaired_amount: Column) -> Column:
    """The price if it is positive, else the repaired amount per piece.

    Always a double, and NULL where it would have to be divided by a quantity of zero.
    """
    per_piece = repaired_amount.cast("double") / F.nullif(quantity.cast("double"), F.lit(0.0))
    return F.when(price > 0, price.cast("double")).otherwise(per_piece)
