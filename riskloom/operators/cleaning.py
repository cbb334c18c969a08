"""Sentinels and infinities."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.selectors import float_columns
from ..functions.sqltext import finite, quoted

EMPLOYED_SENTINEL = 365243


def clean(df: DataFrame) -> DataFrame:
    """Unemployed sentinel and every infinity become NULL, in one projection."""
    floats = set(float_columns(df))

    def cleaned(name):
        c = quoted(name)
        if name == "DAYS_EMPLOYED":
            c = f"nullif({c}, {EMPLOYED_SENTINEL})"
        if name in floats:
            c = finite(c)
        return f"{c} AS {quoted(name)}"

    return df.selectExpr(*[cleaned(c) for c in df.columns])


def infinities_to_null(df: DataFrame) -> DataFrame:
    floats = set(float_columns(df))
    return df.selectExpr(*[f"{finite(quoted(c))} AS {quoted(c)}" if c in floats else quoted(c) for c in df.columns])
