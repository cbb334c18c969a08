"""Point-of-sale and cash loan features, per applicant."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import count_equal
from .checks import require_columns


def pos_features(pos: DataFrame) -> DataFrame:
    """17 aggregates; loans are counted apart, see ``credit_card_features``."""
    require_columns(pos, "SK_ID_CURR")
    rows = pos.where(F.col("SK_ID_CURR").isNotNull())
    counted = rows.groupBy("SK_ID_CURR").agg(F.count_distinct("SK_ID_PREV").alias("pos_loan_count"))
    return counted.join(rows.groupBy("SK_ID_CURR").agg(
        F.min("MONTHS_BALANCE").alias("pos_oldest_record"),
        F.max("MONTHS_BALANCE").alias("pos_latest_record"),
        *[how(source).alias(f"pos_{label}_{name}")
          for name, source in (("instalment", "CNT_INSTALMENT"), ("future_instalment", "CNT_INSTALMENT_FUTURE"),
                               ("dpd", "SK_DPD"), ("dpd_def", "SK_DPD_DEF"))
          for label, how in (("avg", F.avg), ("max", F.max))],
        F.count_if(F.col("SK_DPD") > 0).alias("pos_late_payment_count"),
        F.count_if(F.col("SK_DPD_DEF") > 0).alias("pos_serious_dpd_count"),
        *[count_equal("NAME_CONTRACT_STATUS", state).alias(f"pos_{state.lower()}_contracts")
          for state in ("Active", "Completed", "Signed", "Demand")],
    ), "SK_ID_CURR")
