"""Project the star-schema test tables onto the credit tables' column names.

Every binding is a projection (installments: one join), so the operators run
unchanged on either source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ORIGIN = "2001-12-31"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def _days(c: str):
    return F.datediff(F.col(c), F.lit(ORIGIN).cast("date"))


def application(customer: DataFrame) -> DataFrame:
    return customer.selectExpr(
        "c_custkey AS SK_ID_CURR",
        "CAST(c_acctbal < 0 AS INT) AS TARGET",
        "abs(c_acctbal) + 1000 AS AMT_INCOME_TOTAL",
        "CAST(1000 * (c_custkey % 50) AS DOUBLE) AS AMT_CREDIT",
        "CAST(100 + c_custkey % 37 AS DOUBLE) AS AMT_ANNUITY",
        "CAST(-(7000 + c_custkey % 18000) AS INT) AS DAYS_BIRTH",
        "CAST(CASE WHEN c_custkey % 6 = 0 THEN 365243 ELSE -(c_custkey % 4000) END AS DOUBLE) AS DAYS_EMPLOYED",
        "CASE WHEN c_custkey % 3 <> 0 THEN (c_custkey % 97) / 100D END AS EXT_SOURCE_1",
        "CASE WHEN c_custkey % 5 <> 0 THEN (c_custkey % 89) / 100D END AS EXT_SOURCE_2",
        "CASE WHEN c_custkey % 7 <> 0 THEN (c_custkey % 83) / 100D END AS EXT_SOURCE_3",
        "c_mktsegment AS NAME_INCOME_TYPE",
        "CASE WHEN c_custkey % 11 <> 0 THEN concat('N', c_nationkey) END AS ORGANIZATION_TYPE",
    )


def bureau(orders: DataFrame) -> DataFrame:
    days = _days("o_orderdate")
    return orders.select(
        F.col("o_orderkey").alias("SK_ID_BUREAU"),
        F.col("o_custkey").alias("SK_ID_CURR"),
        F.expr("CASE o_orderstatus WHEN 'O' THEN 'Active' WHEN 'F' THEN 'Closed' "
               "ELSE CASE WHEN o_orderkey % 2 = 0 THEN 'Sold' ELSE 'Bad debt' END END").alias("CREDIT_ACTIVE"),
        days.alias("DAYS_CREDIT"),
        F.when(F.col("o_orderkey") % 4 != 0, days + 365).cast("double").alias("DAYS_CREDIT_ENDDATE"),
        F.col("o_totalprice").alias("AMT_CREDIT_SUM"),
        F.expr("CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice END").alias("AMT_CREDIT_SUM_LIMIT"),
        F.expr("CASE WHEN o_orderstatus = 'O' THEN o_totalprice / 2 END").alias("AMT_CREDIT_SUM_DEBT"),
        F.expr("CAST(o_orderkey % 10 AS DOUBLE)").alias("AMT_CREDIT_SUM_OVERDUE"),
        F.expr("CAST(o_orderkey % 3 AS INT)").alias("CNT_CREDIT_PROLONG"),
        (days + 30).alias("DAYS_CREDIT_UPDATE"),
    )


def bureau_balance(lineitem: DataFrame) -> DataFrame:
    return lineitem.selectExpr(
        "l_orderkey AS SK_ID_BUREAU",
        "(year(l_shipdate) - 2001) * 12 + month(l_shipdate) - 12 AS MONTHS_BALANCE",
        "CASE WHEN l_returnflag = 'N' AND l_linenumber = 7 THEN NULL WHEN l_returnflag = 'N' THEN 'C' "
        "WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN 'X' "
        "ELSE CAST(l_linenumber - 1 AS STRING) END AS STATUS",
    )


def previous_application(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.col("o_orderkey").alias("SK_ID_PREV"),
        F.col("o_custkey").alias("SK_ID_CURR"),
        F.expr("CASE o_orderpriority WHEN '1-URGENT' THEN 'Approved' WHEN '2-HIGH' THEN 'Refused' "
               "WHEN '3-MEDIUM' THEN 'Canceled' WHEN '4-NOT SPECIFIED' THEN 'Unused offer' "
               "ELSE 'Other' END").alias("NAME_CONTRACT_STATUS"),
        F.col("o_totalprice").alias("AMT_APPLICATION"),
        F.expr("o_totalprice * 0.9D").alias("AMT_CREDIT"),
        F.expr("CASE WHEN o_orderpriority = '3-MEDIUM' THEN o_totalprice * 0.1D END").alias("AMT_DOWN_PAYMENT"),
        F.expr("CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice / 12D END").alias("AMT_ANNUITY"),
        F.expr("CASE WHEN o_orderpriority <> '2-HIGH' THEN o_totalprice END").alias("AMT_GOODS_PRICE"),
        _days("o_orderdate").alias("DAYS_DECISION"),
        F.expr("CAST(o_orderkey % 100 AS INT)").alias("SELLERPLACE_AREA"),
        F.expr("CASE WHEN o_orderkey % 7 <> 0 THEN CAST(6 * (o_orderkey % 5) AS DOUBLE) END").alias("CNT_PAYMENT"),
    )


def installments_payments(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    order_days = orders.select("o_orderkey", "o_custkey", _days("o_orderdate").alias("order_day"))
    # what comes of a line alone is worked out before the join: fewer and narrower columns are moved
    lines = lineitem.select(
        "l_orderkey", F.col("l_linenumber").alias("NUM_INSTALMENT_NUMBER"),
        F.when(~((F.col("l_returnflag") == "N") & (F.col("l_linenumber") == 1)), _days("l_shipdate"))
        .cast("double").alias("DAYS_ENTRY_PAYMENT"),
        (F.col("l_discount") * 1000).alias("AMT_INSTALMENT"),
        (F.col("l_tax") * 1000).alias("AMT_PAYMENT"))
    due = (F.col("order_day") + 30 * F.col("NUM_INSTALMENT_NUMBER")).cast("double").alias("DAYS_INSTALMENT")
    return lines.join(order_days, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("SK_ID_CURR"), "NUM_INSTALMENT_NUMBER", due, "DAYS_ENTRY_PAYMENT", "AMT_INSTALMENT", "AMT_PAYMENT")


def _event_fields(events: DataFrame) -> DataFrame:
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    return events.select(
        F.col("user_id").alias("SK_ID_CURR"), (F.dayofmonth("ts") - 31).alias("MONTHS_BALANCE"),
        "event_type", "value", k.alias("k"))


_DPD = "CASE WHEN event_type = 'error' THEN k % 30 ELSE 0 END AS SK_DPD"
_DPD_DEF = "CASE WHEN event_type = 'error' THEN k % 2 ELSE 0 END AS SK_DPD_DEF"


def credit_card_balance(events: DataFrame) -> DataFrame:
    return _event_fields(events).selectExpr(
        "SK_ID_CURR", "CAST(k AS BIGINT) AS SK_ID_PREV", "MONTHS_BALANCE", "value AS AMT_BALANCE",
        "CAST((k % 10) * 20 AS DOUBLE) AS AMT_CREDIT_LIMIT_ACTUAL",
        "CASE WHEN event_type = 'purchase' AND k < 10 THEN value END AS AMT_DRAWINGS_ATM_CURRENT",
        "value / 2 AS AMT_DRAWINGS_CURRENT", "value / 3 AS AMT_PAYMENT_TOTAL_CURRENT",
        "value * 1.1D AS AMT_TOTAL_RECEIVABLE", "CAST(k % 12 AS DOUBLE) AS CNT_INSTALMENT_MATURE_CUM",
        _DPD, _DPD_DEF)


def pos_cash_balance(events: DataFrame) -> DataFrame:
    return _event_fields(events).selectExpr(
        "SK_ID_CURR", "CAST(k AS BIGINT) AS SK_ID_PREV", "MONTHS_BALANCE",
        "CASE WHEN k % 13 <> 0 THEN CAST(k AS DOUBLE) END AS CNT_INSTALMENT",
        "CAST(k % 24 AS DOUBLE) AS CNT_INSTALMENT_FUTURE",
        _DPD, _DPD_DEF,
        "CASE event_type WHEN 'click' THEN 'Active' WHEN 'view' THEN 'Completed' WHEN 'signup' THEN 'Signed' "
        "WHEN 'purchase' THEN 'Demand' ELSE 'Canceled' END AS NAME_CONTRACT_STATUS")


# raw source -> (projection, tables it reads); ``application`` carries the label
BINDINGS = {
    "application": (application, "customer"),
    "bureau": (bureau, "orders"),
    "bureau_balance": (bureau_balance, "lineitem"),
    "previous_application": (previous_application, "orders"),
    "installments_payments": (installments_payments, "lineitem", "orders"),
    "credit_card_balance": (credit_card_balance, "events"),
    "POS_CASH_balance": (pos_cash_balance, "events"),
}


def bound(spark: SparkSession, folder: str, name: str) -> DataFrame:
    project, *tables = BINDINGS[name]
    return project(*[table(spark, folder, t) for t in tables])


def load(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """All bound tables by the raw sources' names; each file is opened once."""
    opened = {t: table(spark, folder, t) for t in dict.fromkeys(t for _, *ts in BINDINGS.values() for t in ts)}
    return {name: project(*[opened[t] for t in tables]) for name, (project, *tables) in BINDINGS.items()}
