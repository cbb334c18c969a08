"""Credit-bureau features: monthly balances -> loan -> applicant."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.joins import hot_keys, join_rolled, rolled_up
from ..functions.scalar import count_equal, divide, mean, total
from .checks import require_columns

LATE = ("1", "2", "3", "4", "5")


def status_number(status="STATUS") -> Column:
    """Digits 0..5 as a number, C (closed) and X (unknown) as 0, anything else NULL."""
    s = F.col(status)
    return F.when(s.isin("C", "X"), 0).when(s.isin("0", *LATE), s.try_cast("int"))


def balance_by_loan(balance: DataFrame) -> DataFrame:
    """One row per ``SK_ID_BUREAU``.

    Months and a count of each status are all that is moved; what else is told of a loan follows from them.
    """
    require_columns(balance, "SK_ID_BUREAU")
    counted = balance.where(F.col("SK_ID_BUREAU").isNotNull()).groupBy("SK_ID_BUREAU").agg(
        F.min("MONTHS_BALANCE").alias("bureau_month_min"),
        F.max("MONTHS_BALANCE").alias("bureau_month_max"),
        mean("MONTHS_BALANCE").alias("bureau_month_mean"),
        *[count_equal("STATUS", s).alias(f"status_{s}_count") for s in "012345CX"],
    )
    late = " + ".join(f"status_{s}_count" for s in LATE)
    levels = " ".join(f"WHEN status_{s}_count > 0 THEN {s}" for s in reversed(LATE))
    none_late = " + ".join(f"status_{s}_count" for s in "0CX")
    added = " + ".join(f"{s} * status_{s}_count" for s in LATE)
    return counted.selectExpr(
        "*",
        f"CASE {levels} WHEN {none_late} > 0 THEN 0 END AS bureau_max_status",
        f"try_divide({added}, {late} + {none_late}) AS bureau_avg_status",
        f"{late} AS bureau_overdue_months",
        f"CAST({late} > 0 AS INT) AS bureau_ever_overdue",
        "status_C_count AS bureau_closed_months",
    )


def _loan_facts(loans: DataFrame) -> DataFrame:
    """Aggregates that need the bureau table alone."""
    return loans.groupBy("SK_ID_CURR").agg(
        F.count("SK_ID_BUREAU").alias("bureau_loan_count"),
        *[count_equal("CREDIT_ACTIVE", state).alias(f"bureau_{name}_loans")
          for name, state in (("active", "Active"), ("closed", "Closed"), ("sold", "Sold"),
                              ("bad_debt", "Bad debt"))],
        total("AMT_CREDIT_SUM").alias("bureau_total_credit"),
        mean("AMT_CREDIT_SUM").alias("bureau_avg_credit"),
        F.max("AMT_CREDIT_SUM").alias("bureau_max_credit"),
        F.min("AMT_CREDIT_SUM").alias("bureau_min_credit"),
        F.min("DAYS_CREDIT").alias("bureau_oldest_credit"),
        F.max("DAYS_CREDIT").alias("bureau_latest_credit"),
        F.avg("DAYS_CREDIT").alias("bureau_avg_credit_age"),
        total("AMT_CREDIT_SUM_LIMIT").alias("bureau_total_credit_limit"),
        mean("AMT_CREDIT_SUM_LIMIT").alias("bureau_avg_credit_limit"),
        total("CNT_CREDIT_PROLONG").alias("bureau_credit_prolong_count"),
        F.max("DAYS_CREDIT_UPDATE").alias("bureau_last_update"),
        F.avg("DAYS_CREDIT_ENDDATE").alias("bureau_avg_end_date"),
        total("AMT_CREDIT_SUM_DEBT").alias("bureau_total_debt"),
        mean("AMT_CREDIT_SUM_DEBT").alias("bureau_avg_debt"),
        F.max("AMT_CREDIT_SUM_DEBT").alias("bureau_max_debt"),
        total("AMT_CREDIT_SUM_OVERDUE").alias("bureau_total_overdue"),
        mean("AMT_CREDIT_SUM_OVERDUE").alias("bureau_avg_overdue"),
        F.max("AMT_CREDIT_SUM_OVERDUE").alias("bureau_max_overdue"),
    )


# applicant column -> loan-level column that is summed into it
_SUMS = {
    "bureau_overdue_months": "bureau_overdue_months",
    **{f"bureau_total_status{s}": f"status_{s}_count" for s in range(6)},
    "bureau_closed_months": "bureau_closed_months",
}


def _payment_history(loans: DataFrame, balance: DataFrame) -> DataFrame:
    """Aggregates of the monthly history. Of the loans only (loan, applicant) goes through the join."""
    months = balance.select("SK_ID_BUREAU", "MONTHS_BALANCE", "STATUS")
    hot = hot_keys(loans, "SK_ID_BUREAU").unionByName(hot_keys(months, "SK_ID_BUREAU"))
    joined = join_rolled(loans.select("SK_ID_BUREAU", "SK_ID_CURR"), months, "SK_ID_BUREAU", balance_by_loan, hot)
    return joined.groupBy("SK_ID_CURR").agg(
        F.min("bureau_month_min").alias("bureau_month_min"),
        F.max("bureau_month_max").alias("bureau_month_max"),
        F.avg("bureau_month_mean").alias("bureau_month_mean"),
        F.max("bureau_ever_overdue").alias("bureau_ever_overdue"),
        F.max("bureau_max_status").alias("bureau_max_status"),
        F.avg("bureau_avg_status").alias("bureau_avg_status"),
        *[F.sum(source).alias(name) for name, source in _SUMS.items()],
    )


# Output column names in the order of the feature table.
COLUMNS = """bureau_loan_count bureau_active_loans bureau_closed_loans bureau_sold_loans bureau_bad_debt_loans
bureau_month_min bureau_month_max bureau_month_mean
bureau_total_credit bureau_avg_credit bureau_max_credit bureau_min_credit
bureau_oldest_credit bureau_latest_credit bureau_avg_credit_age
bureau_total_credit_limit bureau_avg_credit_limit bureau_credit_prolong_count
bureau_last_update bureau_avg_end_date bureau_total_debt bureau_avg_debt bureau_max_debt
bureau_total_overdue bureau_avg_overdue bureau_max_overdue bureau_overdue_months bureau_ever_overdue
bureau_total_status0 bureau_total_status1 bureau_total_status2 bureau_total_status3 bureau_total_status4
bureau_total_status5 bureau_max_status bureau_avg_status bureau_closed_months bureau_active_ratio""".split()


def bureau_features(bureau: DataFrame, balance: DataFrame) -> DataFrame:
    """One row per applicant: 37 aggregates and the share of active loans.

    A mean over loans stays unweighted by their number of months. Loans without any
    monthly row add 0 to sums and nothing to means, minima and maxima.
    """
    require_columns(bureau, "SK_ID_CURR", "SK_ID_BUREAU")
    require_columns(balance, "SK_ID_BUREAU")
    loans = bureau.where(F.col("SK_ID_CURR").isNotNull())
    joined = rolled_up(loans, "SK_ID_CURR", _loan_facts).join(_payment_history(loans, balance), "SK_ID_CURR", "left")
    computed = {name: F.coalesce(name, F.lit(0)).alias(name) for name in _SUMS}
    computed["bureau_active_ratio"] = divide("bureau_active_loans", "bureau_loan_count").alias("bureau_active_ratio")
    return joined.select("SK_ID_CURR", *[computed.get(c, F.col(c)) for c in COLUMNS])
