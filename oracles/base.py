"""Bound source tables and feature tables as DuckDB common table expressions.

A column is listed as (kind, name, expression); kind ``i`` is a whole number, ``d`` a
double, ``s`` a text. Feature tables keep full doubles; only the outermost select of a
statement rounds doubles to single precision, as the Spark side does before comparing
(sums in another order differ in the last bits).
"""

from __future__ import annotations

import re


def single(expr: str) -> str:
    return f"CAST(CAST({expr} AS FLOAT) AS DOUBLE)"


def shown(kind: str, name: str, expr: str | None = None) -> str:
    expr = f'"{name}"' if expr is None else expr
    if kind == "i":
        expr = f"CAST({expr} AS BIGINT)"
    elif kind == "d":
        expr = single(expr)
    return f'{expr} AS "{name}"'


def select_shown(columns, source: str) -> str:
    return "SELECT " + ", ".join(shown(k, n) for k, n, *_ in columns) + f" FROM {source}"


def days(c: str) -> str:
    return f"date_diff('day', DATE '2001-12-31', CAST({c} AS DATE))"


def ratio(n: str, d: str) -> str:
    return (f"CASE WHEN {d} = 0 THEN CASE WHEN {n} > 0 THEN 'inf'::DOUBLE WHEN {n} < 0 THEN '-inf'::DOUBLE END "
            f"ELSE CAST({n} AS DOUBLE) / {d} END")


K = "CAST(regexp_extract(props, '([0-9]+)', 1) AS INT)"

BOUND = {
    "application": """SELECT c_custkey AS SK_ID_CURR, CAST(c_acctbal < 0 AS INT) AS TARGET,
        abs(c_acctbal) + 1000 AS AMT_INCOME_TOTAL, CAST(1000 * (c_custkey % 50) AS DOUBLE) AS AMT_CREDIT,
        CAST(100 + c_custkey % 37 AS DOUBLE) AS AMT_ANNUITY, -(7000 + c_custkey % 18000) AS DAYS_BIRTH,
        CAST(CASE WHEN c_custkey % 6 = 0 THEN 365243 ELSE -(c_custkey % 4000) END AS DOUBLE) AS DAYS_EMPLOYED,
        CASE WHEN c_custkey % 3 <> 0 THEN (c_custkey % 97) / 100::DOUBLE END AS EXT_SOURCE_1,
        CASE WHEN c_custkey % 5 <> 0 THEN (c_custkey % 89) / 100::DOUBLE END AS EXT_SOURCE_2,
        CASE WHEN c_custkey % 7 <> 0 THEN (c_custkey % 83) / 100::DOUBLE END AS EXT_SOURCE_3,
        c_mktsegment AS NAME_INCOME_TYPE,
        CASE WHEN c_custkey % 11 <> 0 THEN 'N' || c_nationkey END AS ORGANIZATION_TYPE FROM customer""",
    "bureau": f"""SELECT o_orderkey AS SK_ID_BUREAU, o_custkey AS SK_ID_CURR,
        CASE o_orderstatus WHEN 'O' THEN 'Active' WHEN 'F' THEN 'Closed'
             ELSE CASE WHEN o_orderkey % 2 = 0 THEN 'Sold' ELSE 'Bad debt' END END AS CREDIT_ACTIVE,
        {days('o_orderdate')} AS DAYS_CREDIT,
        CASE WHEN o_orderkey % 4 <> 0 THEN {days('o_orderdate')} + 365 END AS DAYS_CREDIT_ENDDATE,
        o_totalprice AS AMT_CREDIT_SUM,
        CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice END AS AMT_CREDIT_SUM_LIMIT,
        CASE WHEN o_orderstatus = 'O' THEN o_totalprice / 2 END AS AMT_CREDIT_SUM_DEBT,
        CAST(o_orderkey % 10 AS DOUBLE) AS AMT_CREDIT_SUM_OVERDUE, o_orderkey % 3 AS CNT_CREDIT_PROLONG,
        {days('o_orderdate')} + 30 AS DAYS_CREDIT_UPDATE FROM orders""",
    "bureau_balance": """SELECT l_orderkey AS SK_ID_BUREAU,
        (year(l_shipdate) - 2001) * 12 + month(l_shipdate) - 12 AS MONTHS_BALANCE,
        CASE WHEN l_returnflag = 'N' AND l_linenumber = 7 THEN NULL WHEN l_returnflag = 'N' THEN 'C'
             WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN 'X'
             ELSE CAST(l_linenumber - 1 AS VARCHAR) END AS STATUS FROM lineitem""",
    "previous_application": f"""SELECT o_orderkey AS SK_ID_PREV, o_custkey AS SK_ID_CURR,
        CASE o_orderpriority WHEN '1-URGENT' THEN 'Approved' WHEN '2-HIGH' THEN 'Refused'
             WHEN '3-MEDIUM' THEN 'Canceled' WHEN '4-NOT SPECIFIED' THEN 'Unused offer'
             ELSE 'Other' END AS NAME_CONTRACT_STATUS,
        o_totalprice AS AMT_APPLICATION, o_totalprice * 0.9::DOUBLE AS AMT_CREDIT,
        CASE WHEN o_orderpriority = '3-MEDIUM' THEN o_totalprice * 0.1::DOUBLE END AS AMT_DOWN_PAYMENT,
        CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice / 12 END AS AMT_ANNUITY,
        CASE WHEN o_orderpriority <> '2-HIGH' THEN o_totalprice END AS AMT_GOODS_PRICE,
        {days('o_orderdate')} AS DAYS_DECISION, o_orderkey % 100 AS SELLERPLACE_AREA,
        CASE WHEN o_orderkey % 7 <> 0 THEN CAST(6 * (o_orderkey % 5) AS DOUBLE) END AS CNT_PAYMENT FROM orders""",
    "installments_payments": f"""SELECT o_custkey AS SK_ID_CURR, l_linenumber AS NUM_INSTALMENT_NUMBER,
        {days('o_orderdate')} + 30 * l_linenumber AS DAYS_INSTALMENT,
        CASE WHEN NOT (l_returnflag = 'N' AND l_linenumber = 1) THEN {days('l_shipdate')} END AS DAYS_ENTRY_PAYMENT,
        l_discount * 1000 AS AMT_INSTALMENT, l_tax * 1000 AS AMT_PAYMENT
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "credit_card_balance": f"""SELECT user_id AS SK_ID_CURR, {K} AS SK_ID_PREV, day(ts) - 31 AS MONTHS_BALANCE,
        value AS AMT_BALANCE, CAST(({K} % 10) * 20 AS DOUBLE) AS AMT_CREDIT_LIMIT_ACTUAL,
        CASE WHEN event_type = 'purchase' AND {K} < 10 THEN value END AS AMT_DRAWINGS_ATM_CURRENT,
        value / 2 AS AMT_DRAWINGS_CURRENT, value / 3 AS AMT_PAYMENT_TOTAL_CURRENT,
        value * 1.1::DOUBLE AS AMT_TOTAL_RECEIVABLE, CAST({K} % 12 AS DOUBLE) AS CNT_INSTALMENT_MATURE_CUM,
        CASE WHEN event_type = 'error' THEN {K} % 30 ELSE 0 END AS SK_DPD,
        CASE WHEN event_type = 'error' THEN {K} % 2 ELSE 0 END AS SK_DPD_DEF FROM events""",
    "pos_cash_balance": f"""SELECT user_id AS SK_ID_CURR, {K} AS SK_ID_PREV, day(ts) - 31 AS MONTHS_BALANCE,
        CASE WHEN {K} % 13 <> 0 THEN CAST({K} AS DOUBLE) END AS CNT_INSTALMENT,
        CAST({K} % 24 AS DOUBLE) AS CNT_INSTALMENT_FUTURE,
        CASE WHEN event_type = 'error' THEN {K} % 30 ELSE 0 END AS SK_DPD,
        CASE WHEN event_type = 'error' THEN {K} % 2 ELSE 0 END AS SK_DPD_DEF,
        CASE event_type WHEN 'click' THEN 'Active' WHEN 'view' THEN 'Completed' WHEN 'signup' THEN 'Signed'
             WHEN 'purchase' THEN 'Demand' ELSE 'Canceled' END AS NAME_CONTRACT_STATUS FROM events""",
}

APPLICATION = [("i", "SK_ID_CURR"), ("i", "TARGET"), ("d", "AMT_INCOME_TOTAL"), ("d", "AMT_CREDIT"),
               ("d", "AMT_ANNUITY"), ("i", "DAYS_BIRTH"), ("d", "DAYS_EMPLOYED"), ("d", "EXT_SOURCE_1"),
               ("d", "EXT_SOURCE_2"), ("d", "EXT_SOURCE_3"), ("s", "NAME_INCOME_TYPE"), ("s", "ORGANIZATION_TYPE")]

_X = ("EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3")
_N = "(" + " + ".join(f"CAST({x} IS NOT NULL AS INT)" for x in _X) + ")"
_MEAN = "((" + " + ".join(f"coalesce({x}, 0)" for x in _X) + f") / nullif({_N}, 0))"
_SQUARES = "(" + " + ".join(f"coalesce(({x} - {_MEAN}) * ({x} - {_MEAN}), 0)" for x in _X) + ")"
APPLICATION_ADDED = [
    ("d", "EXT_SOURCE_MEAN", _MEAN),
    ("d", "EXT_SOURCE_STD", f"CASE WHEN {_N} >= 2 THEN sqrt({_SQUARES} / ({_N} - 1)) END"),
    ("d", "EXT_SOURCE_PROD", " * ".join(_X)),
    ("d", "CREDIT_INCOME_RATIO", ratio("AMT_CREDIT", "AMT_INCOME_TOTAL")),
    ("d", "ANNUITY_INCOME_RATIO", ratio("AMT_ANNUITY", "AMT_INCOME_TOTAL")),
    ("d", "CREDIT_TERM", ratio("AMT_ANNUITY", "AMT_CREDIT")),
    ("d", "DAYS_EMPLOYED_PERC", ratio("DAYS_EMPLOYED", "DAYS_BIRTH")),
]


def _num(kind, name, how, source):
    return kind, name, (f"coalesce(sum({source}), 0)" if how == "sum" else f"{how}({source})")


def _eq(name, source, value):
    return "i", name, f"count(*) FILTER (WHERE {source} = '{value}')"


_LATE = "STATUS IN ('1','2','3','4','5')"
_STATUS_NUM = "CASE WHEN STATUS IN ('C','X') THEN 0 WHEN STATUS IN ('0','1','2','3','4','5') THEN CAST(STATUS AS INT) END"

BALANCE = [
    _num("i", "bureau_month_min", "min", "MONTHS_BALANCE"), _num("i", "bureau_month_max", "max", "MONTHS_BALANCE"),
    _num("d", "bureau_month_mean", "avg", "MONTHS_BALANCE"),
    *[_eq(f"status_{s}_count", "STATUS", s) for s in "012345CX"],
    _num("i", "bureau_max_status", "max", _STATUS_NUM), _num("d", "bureau_avg_status", "avg", _STATUS_NUM),
    ("i", "bureau_overdue_months", f"count(*) FILTER (WHERE {_LATE})"),
    ("i", "bureau_ever_overdue", f"CAST(count(*) FILTER (WHERE {_LATE}) > 0 AS INT)"),
    _eq("bureau_closed_months", "STATUS", "C"),
]
_n = _num
BUREAU = [
    _n("i", "bureau_loan_count", "count", "SK_ID_BUREAU"),
    _eq("bureau_active_loans", "CREDIT_ACTIVE", "Active"), _eq("bureau_closed_loans", "CREDIT_ACTIVE", "Closed"),
    _eq("bureau_sold_loans", "CREDIT_ACTIVE", "Sold"), _eq("bureau_bad_debt_loans", "CREDIT_ACTIVE", "Bad debt"),
    _n("i", "bureau_month_min", "min", "bureau_month_min"), _n("i", "bureau_month_max", "max", "bureau_month_max"),
    _n("d", "bureau_month_mean", "avg", "bureau_month_mean"),
    _n("d", "bureau_total_credit", "sum", "AMT_CREDIT_SUM"), _n("d", "bureau_avg_credit", "avg", "AMT_CREDIT_SUM"),
    _n("d", "bureau_max_credit", "max", "AMT_CREDIT_SUM"), _n("d", "bureau_min_credit", "min", "AMT_CREDIT_SUM"),
    _n("i", "bureau_oldest_credit", "min", "DAYS_CREDIT"), _n("i", "bureau_latest_credit", "max", "DAYS_CREDIT"),
    _n("d", "bureau_avg_credit_age", "avg", "DAYS_CREDIT"),
    _n("d", "bureau_total_credit_limit", "sum", "AMT_CREDIT_SUM_LIMIT"),
    _n("d", "bureau_avg_credit_limit", "avg", "AMT_CREDIT_SUM_LIMIT"),
    _n("i", "bureau_credit_prolong_count", "sum", "CNT_CREDIT_PROLONG"),
    _n("i", "bureau_last_update", "max", "DAYS_CREDIT_UPDATE"),
    _n("d", "bureau_avg_end_date", "avg", "DAYS_CREDIT_ENDDATE"),
    _n("d", "bureau_total_debt", "sum", "AMT_CREDIT_SUM_DEBT"), _n("d", "bureau_avg_debt", "avg", "AMT_CREDIT_SUM_DEBT"),
    _n("d", "bureau_max_debt", "max", "AMT_CREDIT_SUM_DEBT"),
    _n("d", "bureau_total_overdue", "sum", "AMT_CREDIT_SUM_OVERDUE"),
    _n("d", "bureau_avg_overdue", "avg", "AMT_CREDIT_SUM_OVERDUE"),
    _n("d", "bureau_max_overdue", "max", "AMT_CREDIT_SUM_OVERDUE"),
    _n("i", "bureau_overdue_months", "sum", "bureau_overdue_months"),
    _n("i", "bureau_ever_overdue", "max", "bureau_ever_overdue"),
    *[_n("i", f"bureau_total_status{s}", "sum", f"status_{s}_count") for s in range(6)],
    _n("i", "bureau_max_status", "max", "bureau_max_status"), _n("d", "bureau_avg_status", "avg", "bureau_avg_status"),
    _n("i", "bureau_closed_months", "sum", "bureau_closed_months"),
    ("d", "bureau_active_ratio", "count(*) FILTER (WHERE CREDIT_ACTIVE = 'Active') / count(SK_ID_BUREAU)::DOUBLE"),
]
PREVIOUS = [
    _n("i", "prev_application_count", "count", "SK_ID_PREV"),
    *[_n("d", f"prev_{label}_application_amount", how, "AMT_APPLICATION")
      for label, how in (("total", "sum"), ("avg", "avg"), ("max", "max"))],
    *[_n("d", f"prev_{label}_credit", how, "AMT_CREDIT")
      for label, how in (("total", "sum"), ("avg", "avg"), ("max", "max"))],
    _eq("prev_approved_count", "NAME_CONTRACT_STATUS", "Approved"),
    _eq("prev_refused_count", "NAME_CONTRACT_STATUS", "Refused"),
    _eq("prev_canceled_count", "NAME_CONTRACT_STATUS", "Canceled"),
    _eq("prev_unused_offer_count", "NAME_CONTRACT_STATUS", "Unused offer"),
    _n("i", "prev_last_application_days", "max", "DAYS_DECISION"),
    _n("i", "prev_first_application_days", "min", "DAYS_DECISION"),
    _n("d", "prev_avg_application_days", "avg", "DAYS_DECISION"),
    _n("d", "prev_avg_down_payment", "avg", "AMT_DOWN_PAYMENT"), _n("d", "prev_max_down_payment", "max", "AMT_DOWN_PAYMENT"),
    _n("d", "prev_avg_annuity", "avg", "AMT_ANNUITY"), _n("d", "prev_max_annuity", "max", "AMT_ANNUITY"),
    _n("d", "prev_avg_goods_price", "avg", "AMT_GOODS_PRICE"), _n("d", "prev_total_goods_price", "sum", "AMT_GOODS_PRICE"),
    _n("d", "prev_avg_seller_area", "avg", "SELLERPLACE_AREA"),
    _n("d", "prev_avg_payment_term", "avg", "CNT_PAYMENT"), _n("d", "prev_max_payment_term", "max", "CNT_PAYMENT"),
    ("d", "prev_approval_rate", "count(*) FILTER (WHERE NAME_CONTRACT_STATUS = 'Approved') / count(SK_ID_PREV)::DOUBLE"),
    ("d", "prev_refusal_rate", "count(*) FILTER (WHERE NAME_CONTRACT_STATUS = 'Refused') / count(SK_ID_PREV)::DOUBLE"),
]
INSTALLMENTS = [
    *[_n("d", f"inst_{label}_instalment", how, "AMT_INSTALMENT")
      for label, how in (("total", "sum"), ("avg", "avg"), ("max", "max"))],
    *[_n("d", f"inst_{label}_payment", how, "AMT_PAYMENT")
      for label, how in (("total", "sum"), ("avg", "avg"), ("max", "max"), ("min", "min"))],
    _n("d", "inst_avg_delay", "avg", "payment_delay"), _n("d", "inst_max_delay", "max", "payment_delay"),
    ("i", "inst_late_payment_count", "count(*) FILTER (WHERE payment_delay > 0)"),
    _n("d", "inst_avg_payment_ratio", "avg", "payment_ratio"), _n("d", "inst_min_payment_ratio", "min", "payment_ratio"),
    ("i", "inst_underpaid_count", "count(*) FILTER (WHERE payment_ratio < 1)"),
    _n("i", "inst_count", "count", "NUM_INSTALMENT_NUMBER"),
    _n("i", "inst_max_installment_number", "max", "NUM_INSTALMENT_NUMBER"),
]
CARDS = [
    ("i", "cc_card_count", "count(DISTINCT SK_ID_PREV)"),
    *[_n("d", f"cc_{label}_balance", how, "AMT_BALANCE")
      for label, how in (("total", "sum"), ("avg", "avg"), ("max", "max"))],
    _n("d", "cc_avg_credit_limit", "avg", "AMT_CREDIT_LIMIT_ACTUAL"),
    _n("d", "cc_max_credit_limit", "max", "AMT_CREDIT_LIMIT_ACTUAL"),
    _n("d", "cc_avg_utilization", "avg", "credit_utilization"), _n("d", "cc_max_utilization", "max", "credit_utilization"),
    _n("d", "cc_total_atm_drawings", "sum", "AMT_DRAWINGS_ATM_CURRENT"),
    _n("d", "cc_avg_atm_drawings", "avg", "AMT_DRAWINGS_ATM_CURRENT"),
    _n("d", "cc_total_drawings", "sum", "AMT_DRAWINGS_CURRENT"), _n("d", "cc_avg_drawings", "avg", "AMT_DRAWINGS_CURRENT"),
    *[_n("d", f"cc_{label}_payment", how, "AMT_PAYMENT_TOTAL_CURRENT")
      for label, how in (("total", "sum"), ("avg", "avg"), ("max", "max"))],
    _n("d", "cc_avg_receivable", "avg", "AMT_TOTAL_RECEIVABLE"), _n("d", "cc_max_receivable", "max", "AMT_TOTAL_RECEIVABLE"),
    _n("d", "cc_avg_installment", "avg", "CNT_INSTALMENT_MATURE_CUM"),
    _n("d", "cc_max_installment", "max", "CNT_INSTALMENT_MATURE_CUM"),
    _n("d", "cc_avg_dpd", "avg", "SK_DPD"), _n("i", "cc_max_dpd", "max", "SK_DPD"),
    ("i", "cc_late_payment_count", "count(*) FILTER (WHERE SK_DPD > 0)"),
    ("i", "cc_serious_dpd_count", "count(*) FILTER (WHERE SK_DPD_DEF > 0)"),
    _n("i", "cc_oldest_record", "min", "MONTHS_BALANCE"), _n("i", "cc_latest_record", "max", "MONTHS_BALANCE"),
]
POS = [
    ("i", "pos_loan_count", "count(DISTINCT SK_ID_PREV)"),
    _n("i", "pos_oldest_record", "min", "MONTHS_BALANCE"), _n("i", "pos_latest_record", "max", "MONTHS_BALANCE"),
    _n("d", "pos_avg_instalment", "avg", "CNT_INSTALMENT"), _n("d", "pos_max_instalment", "max", "CNT_INSTALMENT"),
    _n("d", "pos_avg_future_instalment", "avg", "CNT_INSTALMENT_FUTURE"),
    _n("d", "pos_max_future_instalment", "max", "CNT_INSTALMENT_FUTURE"),
    _n("d", "pos_avg_dpd", "avg", "SK_DPD"), _n("i", "pos_max_dpd", "max", "SK_DPD"),
    _n("d", "pos_avg_dpd_def", "avg", "SK_DPD_DEF"), _n("i", "pos_max_dpd_def", "max", "SK_DPD_DEF"),
    ("i", "pos_late_payment_count", "count(*) FILTER (WHERE SK_DPD > 0)"),
    ("i", "pos_serious_dpd_count", "count(*) FILTER (WHERE SK_DPD_DEF > 0)"),
    *[_eq(f"pos_{s.lower()}_contracts", "NAME_CONTRACT_STATUS", s) for s in ("Active", "Completed", "Signed", "Demand")],
]


def grouped(columns, source: str, key: str = "SK_ID_CURR") -> str:
    body = ", ".join(f'{expr} AS "{name}"' for _, name, expr in columns)
    return f"SELECT {key}, {body} FROM {source} WHERE {key} IS NOT NULL GROUP BY {key}"


_added = ", ".join(f"{e} AS {n}" for _, n, e in APPLICATION_ADDED)
FEATURES = {
    "balance_by_loan": grouped(BALANCE, "bureau_balance", "SK_ID_BUREAU"),
    "bureau_features": grouped(BUREAU, "(SELECT bureau.*, balance_by_loan.* EXCLUDE (SK_ID_BUREAU) FROM bureau "
                                       "LEFT JOIN balance_by_loan USING (SK_ID_BUREAU)) merged"),
    "previous_features": grouped(PREVIOUS, "previous_application"),
    "installment_features": grouped(
        INSTALLMENTS, "(SELECT *, DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT AS payment_delay, "
                      f"{ratio('AMT_PAYMENT', 'AMT_INSTALMENT')} AS payment_ratio FROM installments_payments) rows"),
    "credit_card_features": grouped(
        CARDS, "(SELECT *, CASE WHEN AMT_CREDIT_LIMIT_ACTUAL <> 0 THEN greatest(0, least(5, AMT_BALANCE / "
               "AMT_CREDIT_LIMIT_ACTUAL)) END AS credit_utilization FROM credit_card_balance) rows"),
    "pos_features": grouped(POS, "pos_cash_balance"),
    "application_features": f"SELECT *, {_added} FROM application",
    "assembled": "SELECT * FROM application_features LEFT JOIN bureau_features USING (SK_ID_CURR) "
                 "LEFT JOIN previous_features USING (SK_ID_CURR) LEFT JOIN installment_features USING (SK_ID_CURR) "
                 "LEFT JOIN credit_card_features USING (SK_ID_CURR) LEFT JOIN pos_features USING (SK_ID_CURR)",
}
ASSEMBLED = [*APPLICATION, *APPLICATION_ADDED, *BUREAU, *PREVIOUS, *INSTALLMENTS, *CARDS, *POS]


def _cleaned(kind, name):
    c = f'"{name}"'
    if name == "DAYS_EMPLOYED":
        c = f"nullif({c}, 365243)"
    if kind == "d":
        c = f"CASE WHEN isfinite({c}) THEN {c} END"
    return f'{c} AS "{name}"'


FEATURES["cleaned"] = "SELECT " + ", ".join(_cleaned(k, n) for k, n, *_ in ASSEMBLED) + " FROM assembled"

# what the reports and the preprocessing read: doubles kept at single precision, so that
# ties in ranks and counts do not hang on the last bit of a sum
FEATURES["stored_raw"] = select_shown(ASSEMBLED, "assembled")
FEATURES["stored"] = select_shown(ASSEMBLED, "cleaned")


def with_tables(body: str, **extra: str) -> str:
    """Prefix ``body`` with the bound and feature tables it (transitively) names."""
    tables = {**BOUND, **FEATURES, **extra}
    needed, todo = [], [body]
    while todo:
        text = todo.pop()
        for name in tables:
            if name not in needed and _names(text, name):
                needed.append(name)
                todo.append(tables[name])
    ordered = [n for n in tables if n in needed]
    ctes = ", ".join(f"{n} AS ({tables[n]})" for n in ordered)
    return f"WITH {ctes} {body}" if ordered else body


def _names(text: str, name: str) -> bool:
    return re.search(rf"(?<![\w.\"']){name}(?![\w\"'(])", text) is not None
