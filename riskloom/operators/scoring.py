"""Batch scoring: padding, threshold decision and risk band."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.sqltext import quoted

THRESHOLD = 0.48
# Our choice: the original cut-offs are not published. (upper end, name), the last has none.
BANDS = ((0.25, "Low"), (0.50, "Medium"), (0.75, "High"), (None, "Very high"))


def pad_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns in its order and types; absent ones NULL, others dropped."""
    present = set(df.columns)
    return df.selectExpr(*[
        f"CAST({quoted(f.name) if f.name in present else 'NULL'} AS {f.dataType.simpleString()}) AS {quoted(f.name)}"
        for f in schema.fields])


def decide(probability: str = "probability", threshold: float = THRESHOLD) -> Column:
    """High risk from the threshold on."""
    p = F.col(probability)
    return F.when(p >= threshold, "High risk").when(p < threshold, "Low risk")


def risk_band(probability: str = "probability", bands=BANDS) -> Column:
    p = F.col(probability)
    band = F.lit(None).cast("string")
    for upper, name in reversed(bands):
        band = F.when(p.isNotNull(), name) if upper is None else F.when(p < upper, name).otherwise(band)
    return band


def decisions(scored: DataFrame, probability: str = "probability", threshold: float = THRESHOLD,
              bands=BANDS) -> DataFrame:
    return scored.select("*", decide(probability, threshold).alias("decision"),
                         risk_band(probability, bands).alias("risk_band"))
