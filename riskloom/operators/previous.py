"""Features from earlier applications, per applicant."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.joins import rolled_up
from ..functions.scalar import count_equal, divide, mean, total
from .checks import require_columns

_OUTCOMES = {"approved": "Approved", "refused": "Refused", "canceled": "Canceled", "unused_offer": "Unused offer"}


def _sums(previous: DataFrame) -> DataFrame:
    return previous.groupBy("SK_ID_CURR").agg(
        F.count("SK_ID_PREV").alias("prev_application_count"),
        total("AMT_APPLICATION").alias("prev_total_application_amount"),
        mean("AMT_APPLICATION").alias("prev_avg_application_amount"),
        F.max("AMT_APPLICATION").alias("prev_max_application_amount"),
        total("AMT_CREDIT").alias("prev_total_credit"),
        mean("AMT_CREDIT").alias("prev_avg_credit"),
        F.max("AMT_CREDIT").alias("prev_max_credit"),
        *[count_equal("NAME_CONTRACT_STATUS", value).alias(f"prev_{name}_count")
          for name, value in _OUTCOMES.items()],
        F.max("DAYS_DECISION").alias("prev_last_application_days"),
        F.min("DAYS_DECISION").alias("prev_first_application_days"),
        F.avg("DAYS_DECISION").alias("prev_avg_application_days"),
        F.avg("AMT_DOWN_PAYMENT").alias("prev_avg_down_payment"),
        F.max("AMT_DOWN_PAYMENT").alias("prev_max_down_payment"),
        F.avg("AMT_ANNUITY").alias("prev_avg_annuity"),
        F.max("AMT_ANNUITY").alias("prev_max_annuity"),
        mean("AMT_GOODS_PRICE").alias("prev_avg_goods_price"),
        total("AMT_GOODS_PRICE").alias("prev_total_goods_price"),
        F.avg("SELLERPLACE_AREA").alias("prev_avg_seller_area"),
        F.avg("CNT_PAYMENT").alias("prev_avg_payment_term"),
        F.max("CNT_PAYMENT").alias("prev_max_payment_term"),
    )


def previous_features(previous: DataFrame) -> DataFrame:
    """23 aggregates and the approval and refusal rates."""
    require_columns(previous, "SK_ID_CURR")
    rolled = rolled_up(previous.where(F.col("SK_ID_CURR").isNotNull()), "SK_ID_CURR", _sums)
    return rolled.select(
        "*",
        divide("prev_approved_count", "prev_application_count").alias("prev_approval_rate"),
        divide("prev_refused_count", "prev_application_count").alias("prev_refusal_rate"),
    )
