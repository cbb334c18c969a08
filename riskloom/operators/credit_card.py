"""Credit-card balance features, per applicant."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import clip, mean, null_if, total
from .checks import require_columns


def utilization() -> Column:
    """Balance over limit, clamped to 0..5; NULL for a zero limit."""
    return clip(F.try_divide(F.col("AMT_BALANCE"), null_if("AMT_CREDIT_LIMIT_ACTUAL", 0)), 0, 5)


def credit_card_features(cards: DataFrame) -> DataFrame:
    """25 aggregates. Cards are counted apart: an exact count goes through (applicant, card) pairs, with which the other
    aggregates would be moved as well."""
    require_columns(cards, "SK_ID_CURR")
    rows = cards.where(F.col("SK_ID_CURR").isNotNull()).withColumn("credit_utilization", utilization())
    counted = rows.groupBy("SK_ID_CURR").agg(F.count_distinct("SK_ID_PREV").alias("cc_card_count"))
    return counted.join(rows.groupBy("SK_ID_CURR").agg(
        total("AMT_BALANCE").alias("cc_total_balance"),
        mean("AMT_BALANCE").alias("cc_avg_balance"),
        F.max("AMT_BALANCE").alias("cc_max_balance"),
        F.avg("AMT_CREDIT_LIMIT_ACTUAL").alias("cc_avg_credit_limit"),
        F.max("AMT_CREDIT_LIMIT_ACTUAL").alias("cc_max_credit_limit"),
        F.avg("credit_utilization").alias("cc_avg_utilization"),
        F.max("credit_utilization").alias("cc_max_utilization"),
        total("AMT_DRAWINGS_ATM_CURRENT").alias("cc_total_atm_drawings"),
        mean("AMT_DRAWINGS_ATM_CURRENT").alias("cc_avg_atm_drawings"),
        total("AMT_DRAWINGS_CURRENT").alias("cc_total_drawings"),
        mean("AMT_DRAWINGS_CURRENT").alias("cc_avg_drawings"),
        total("AMT_PAYMENT_TOTAL_CURRENT").alias("cc_total_payment"),
        mean("AMT_PAYMENT_TOTAL_CURRENT").alias("cc_avg_payment"),
        F.max("AMT_PAYMENT_TOTAL_CURRENT").alias("cc_max_payment"),
        F.avg("AMT_TOTAL_RECEIVABLE").alias("cc_avg_receivable"),
        F.max("AMT_TOTAL_RECEIVABLE").alias("cc_max_receivable"),
        F.avg("CNT_INSTALMENT_MATURE_CUM").alias("cc_avg_installment"),
        F.max("CNT_INSTALMENT_MATURE_CUM").alias("cc_max_installment"),
        F.avg("SK_DPD").alias("cc_avg_dpd"),
        F.max("SK_DPD").alias("cc_max_dpd"),
        F.count_if(F.col("SK_DPD") > 0).alias("cc_late_payment_count"),
        F.count_if(F.col("SK_DPD_DEF") > 0).alias("cc_serious_dpd_count"),
        F.min("MONTHS_BALANCE").alias("cc_oldest_record"),
        F.max("MONTHS_BALANCE").alias("cc_latest_record"),
    ), "SK_ID_CURR")
