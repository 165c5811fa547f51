"""Semi-structured columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_UNREADABLE = "_unreadable"


def parsed_json(text: Column, schema: str, required: tuple[str, ...] = ()) -> Column:
    """A struct of ``value`` (the declared fields) and ``reason`` why it cannot be used, NULL if it can.

    Reasons: ``no text``, ``not readable`` (no JSON, or a field of another type), ``lacks <field>``. Fields that are not declared are
    ignored. Only the fields that a query uses are parsed.
    """
    found = F.from_json(text, f"{schema}, {_UNREADABLE} string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _UNREADABLE})
    reason = F.when(text.isNull(), "no text").when(found[_UNREADABLE].isNotNull() | found.isNull(), "not readable")
    for field in required:
        reason = reason.when(found[field].isNull(), f"lacks {field}")
    return F.struct(found.alias("value"), reason.alias("reason"))
