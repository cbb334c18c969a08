"""Row-wise features of the application itself."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.scalar import divide, null_if, row_mean, row_product, row_std
from .cleaning import EMPLOYED_SENTINEL

_SCORES = ("EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3")


def application_features(applications: DataFrame, null_sentinel_first: bool = False) -> DataFrame:
    """Add seven columns; one projection, no shuffle.

    ``DAYS_EMPLOYED_PERC`` is taken before the unemployed sentinel is nulled, as in the
    original pipeline; ``null_sentinel_first`` leaves it NULL for those rows instead.
    """
    employed = null_if("DAYS_EMPLOYED", EMPLOYED_SENTINEL) if null_sentinel_first else "DAYS_EMPLOYED"
    return applications.select(
        "*",
        row_mean(*_SCORES).alias("EXT_SOURCE_MEAN"),
        row_std(*_SCORES).alias("EXT_SOURCE_STD"),
        row_product(*_SCORES).alias("EXT_SOURCE_PROD"),
        divide("AMT_CREDIT", "AMT_INCOME_TOTAL").alias("CREDIT_INCOME_RATIO"),
        divide("AMT_ANNUITY", "AMT_INCOME_TOTAL").alias("ANNUITY_INCOME_RATIO"),
        divide("AMT_ANNUITY", "AMT_CREDIT").alias("CREDIT_TERM"),
        divide(employed, "DAYS_BIRTH").alias("DAYS_EMPLOYED_PERC"),
    )
