"""Pick column names by type class or by name rule."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

LABEL = "TARGET"
ID = "SK_ID_CURR"


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def float_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, (T.DoubleType, T.FloatType))]


def string_columns(df: DataFrame, exclude=()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.StringType) and f.name not in exclude]


def boolean_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.BooleanType)]


def feature_columns(df: DataFrame, label: str = LABEL, key: str = ID) -> list[str]:
    """Everything but the label and the applicant id; either may be absent."""
    return [c for c in df.columns if c not in (label, key)]


def id_columns(columns) -> list[str]:
    return [c for c in columns if c.startswith("SK_ID")]


def named_like(columns, *parts, ignore_case: bool = True) -> list[str]:
    """Columns whose name contains any of the parts."""
    def fold(s):
        return s.lower() if ignore_case else s
    return [c for c in columns if any(fold(p) in fold(c) for p in parts)]


def day_columns(columns) -> list[str]:
    return named_like(columns, "DAYS", ignore_case=False)


def month_columns(columns) -> list[str]:
    return named_like(columns, "month")


def ratio_columns(columns) -> list[str]:
    return named_like(columns, "ratio")


def count_columns(columns) -> list[str]:
    return named_like(columns, "count", "cnt_")


def without(columns, *groups) -> list[str]:
    """Ordered difference, each name once."""
    dropped = set().union(*groups) if groups else set()
    return [c for c in dict.fromkeys(columns) if c not in dropped]
