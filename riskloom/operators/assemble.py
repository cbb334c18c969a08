"""Join the per-applicant feature tables onto the applications."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .application import application_features
from .bureau import bureau_features
from .checks import require_columns, watch
from .credit_card import credit_card_features
from .installments import installment_features
from .pos_cash import pos_features
from .previous import previous_features


def feature_tables(sources: Mapping[str, DataFrame]) -> list[tuple[str, DataFrame]]:
    """The five per-applicant tables, in join order."""
    return [
        ("bureau", bureau_features(sources["bureau"], sources["bureau_balance"])),
        ("previous_application", previous_features(sources["previous_application"])),
        ("installments_payments", installment_features(sources["installments_payments"])),
        ("credit_card_balance", credit_card_features(sources["credit_card_balance"])),
        ("POS_CASH_balance", pos_features(sources["POS_CASH_balance"])),
    ]


def assemble(applications: DataFrame, features, key: str = "SK_ID_CURR", watched: dict | None = None) -> DataFrame:
    """Left-join every feature table; applicants without history keep NULL features.

    Each feature table is already hash-partitioned by the key through its grouping, so
    the chain shuffles the applications once and nothing else again. With ``watched`` both sides of
    the joins and their result are counted while the job runs, see ``checks.watch``.
    """
    require_columns(applications, key)
    wide = watch(applications, key, "applications", watched, "dataset")
    for name, table in features:
        wide = wide.join(watch(table, key, name, watched), key, "left")
    return watch(wide, key, "assembled", watched, "dataset")


def build(sources: Mapping[str, DataFrame], null_sentinel_first: bool = False, watched: dict | None = None) -> DataFrame:
    """Feature table for ``sources['application']``, or for train and test at once.

    With ``application_train`` and ``application_test`` the features are computed and joined
    once over their union; ``dataset`` tells the rows apart and the test label is NULL.
    """
    if "application" in sources:
        applications = sources["application"]
    else:
        train = sources["application_train"].withColumn("dataset", F.lit("train"))
        test = sources["application_test"].withColumn("dataset", F.lit("test"))
        applications = train.unionByName(test, allowMissingColumns=True)
    return assemble(application_features(applications, null_sentinel_first), feature_tables(sources), watched=watched)
