"""Helpers shared by the catalogue modules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIGITS = 6


def rounded(df: DataFrame, digits: int = DIGITS, columns: Sequence[str] | None = None) -> DataFrame:
    """Double columns rounded, so that the order of a floating-point sum does not show."""
    names = columns or [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.round(F.col(f"`{c}`"), digits) for c in names})


def rnd(expression: str, digits: int = DIGITS) -> str:
    """SQL: round half away from zero on the decimal value, as Spark rounds doubles.

    Six further digits are kept before rounding; more would show the binary tail of large values.
    """
    return f"round(CAST({expression} AS DECIMAL(38, {digits + 6})), {digits})::DOUBLE"


def union_all(template: str, items: Sequence) -> str:
    """SQL: the template once per item, joined by UNION ALL; ``{c}`` and ``{0}``.. are filled in."""
    parts = []
    for item in items:
        values = item if isinstance(item, tuple) else (item,)
        parts.append(template.format(*values, c=values[0]))
    return "\nUNION ALL\n".join(parts)
