"""Installment payment features, per applicant."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import divide, mean, total
from .checks import require_columns


def payment_measures(payments: DataFrame) -> DataFrame:
    """Add days late and the paid share of what was due (infinite where nothing was due)."""
    return payments.select(
        "*",
        (F.col("DAYS_ENTRY_PAYMENT") - F.col("DAYS_INSTALMENT")).alias("payment_delay"),
        divide("AMT_PAYMENT", "AMT_INSTALMENT").alias("payment_ratio"),
    )


def installment_features(payments: DataFrame) -> DataFrame:
    """15 aggregates; an infinite ratio stays in its mean until the cleaning step."""
    require_columns(payments, "SK_ID_CURR")
    rows = payment_measures(payments.where(F.col("SK_ID_CURR").isNotNull()))
    return rows.groupBy("SK_ID_CURR").agg(
        total("AMT_INSTALMENT").alias("inst_total_instalment"),
        mean("AMT_INSTALMENT").alias("inst_avg_instalment"),
        F.max("AMT_INSTALMENT").alias("inst_max_instalment"),
        total("AMT_PAYMENT").alias("inst_total_payment"),
        mean("AMT_PAYMENT").alias("inst_avg_payment"),
        F.max("AMT_PAYMENT").alias("inst_max_payment"),
        F.min("AMT_PAYMENT").alias("inst_min_payment"),
        F.avg("payment_delay").alias("inst_avg_delay"),
        F.max("payment_delay").alias("inst_max_delay"),
        F.count_if(F.col("payment_delay") > 0).alias("inst_late_payment_count"),
        F.avg("payment_ratio").alias("inst_avg_payment_ratio"),
        F.min("payment_ratio").alias("inst_min_payment_ratio"),
        F.count_if(F.col("payment_ratio") < 1).alias("inst_underpaid_count"),
        F.count("NUM_INSTALMENT_NUMBER").alias("inst_count"),
        F.max("NUM_INSTALMENT_NUMBER").alias("inst_max_installment_number"),
    )
