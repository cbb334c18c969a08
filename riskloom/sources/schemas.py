"""Explicit schemas of the raw sources and of the scoring input.

Only the columns that are read are listed; CSV files may hold more, in any order
(the readers match by header).
"""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {"long": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(), "string": T.StringType()}


def struct(**by_type: str) -> T.StructType:
    """``struct(long="A B", double="C")`` -> StructType, in the order given."""
    fields = [T.StructField(name, _TYPES[kind]) for kind, names in by_type.items() for name in names.split()]
    return T.StructType(fields)


# Column names of the application table, in file order, by type where they share one.
_HOUSING = ("APARTMENTS BASEMENTAREA YEARS_BEGINEXPLUATATION YEARS_BUILD COMMONAREA ELEVATORS ENTRANCES "
            "FLOORSMAX FLOORSMIN LANDAREA LIVINGAPARTMENTS LIVINGAREA NONLIVINGAPARTMENTS NONLIVINGAREA").split()
_APPLICATION = (
    [("SK_ID_CURR", "long")]
    + [(c, "string") for c in "NAME_CONTRACT_TYPE CODE_GENDER FLAG_OWN_CAR FLAG_OWN_REALTY".split()]
    + [("CNT_CHILDREN", "int")]
    + [(c, "double") for c in "AMT_INCOME_TOTAL AMT_CREDIT AMT_ANNUITY AMT_GOODS_PRICE".split()]
    + [(c, "string") for c in ("NAME_TYPE_SUITE NAME_INCOME_TYPE NAME_EDUCATION_TYPE NAME_FAMILY_STATUS "
                               "NAME_HOUSING_TYPE").split()]
    + [("REGION_POPULATION_RELATIVE", "double"), ("DAYS_BIRTH", "int"), ("DAYS_EMPLOYED", "double"),
       ("DAYS_REGISTRATION", "double"), ("DAYS_ID_PUBLISH", "int"), ("OWN_CAR_AGE", "double")]
    + [(c, "int") for c in ("FLAG_MOBIL FLAG_EMP_PHONE FLAG_WORK_PHONE FLAG_CONT_MOBILE FLAG_PHONE "
                            "FLAG_EMAIL").split()]
    + [("OCCUPATION_TYPE", "string"), ("CNT_FAM_MEMBERS", "double"), ("REGION_RATING_CLIENT", "int"),
       ("REGION_RATING_CLIENT_W_CITY", "int"), ("WEEKDAY_APPR_PROCESS_START", "string")]
    + [(c, "int") for c in ("HOUR_APPR_PROCESS_START REG_REGION_NOT_LIVE_REGION REG_REGION_NOT_WORK_REGION "
                            "LIVE_REGION_NOT_WORK_REGION REG_CITY_NOT_LIVE_CITY REG_CITY_NOT_WORK_CITY "
                            "LIVE_CITY_NOT_WORK_CITY").split()]
    + [("ORGANIZATION_TYPE", "string")]
    + [(f"EXT_SOURCE_{i}", "double") for i in (1, 2, 3)]
    + [(f"{c}_{kind}", "double") for kind in ("AVG", "MODE", "MEDI") for c in _HOUSING]
    + [("FONDKAPREMONT_MODE", "string"), ("HOUSETYPE_MODE", "string"), ("TOTALAREA_MODE", "double"),
       ("WALLSMATERIAL_MODE", "string"), ("EMERGENCYSTATE_MODE", "string")]
    + [(f"{kind}_{days}_CNT_SOCIAL_CIRCLE", "double") for days in (30, 60) for kind in ("OBS", "DEF")]
    + [("DAYS_LAST_PHONE_CHANGE", "double")]
    + [(f"FLAG_DOCUMENT_{i}", "int") for i in range(2, 22)]
    + [(f"AMT_REQ_CREDIT_BUREAU_{span}", "double") for span in ("HOUR", "DAY", "WEEK", "MON", "QRT", "YEAR")]
)

APPLICATION_TEST = T.StructType([T.StructField(c, _TYPES[t]) for c, t in _APPLICATION])
APPLICATION_TRAIN = T.StructType(
    [APPLICATION_TEST.fields[0], T.StructField("TARGET", T.IntegerType()), *APPLICATION_TEST.fields[1:]])

BUREAU = struct(
    long="SK_ID_CURR SK_ID_BUREAU", string="CREDIT_ACTIVE",
    int="DAYS_CREDIT CNT_CREDIT_PROLONG DAYS_CREDIT_UPDATE",
    double="DAYS_CREDIT_ENDDATE AMT_CREDIT_SUM AMT_CREDIT_SUM_LIMIT AMT_CREDIT_SUM_DEBT AMT_CREDIT_SUM_OVERDUE")
BUREAU_BALANCE = struct(long="SK_ID_BUREAU", int="MONTHS_BALANCE", string="STATUS")
PREVIOUS_APPLICATION = struct(
    long="SK_ID_PREV SK_ID_CURR",
    double="AMT_APPLICATION AMT_CREDIT AMT_DOWN_PAYMENT AMT_ANNUITY AMT_GOODS_PRICE CNT_PAYMENT",
    string="NAME_CONTRACT_STATUS", int="DAYS_DECISION SELLERPLACE_AREA")
INSTALLMENTS_PAYMENTS = struct(
    long="SK_ID_CURR", int="NUM_INSTALMENT_NUMBER",
    double="DAYS_INSTALMENT DAYS_ENTRY_PAYMENT AMT_INSTALMENT AMT_PAYMENT")
CREDIT_CARD_BALANCE = struct(
    long="SK_ID_PREV SK_ID_CURR", int="MONTHS_BALANCE SK_DPD SK_DPD_DEF",
    double="AMT_BALANCE AMT_CREDIT_LIMIT_ACTUAL AMT_DRAWINGS_ATM_CURRENT AMT_DRAWINGS_CURRENT "
           "AMT_PAYMENT_TOTAL_CURRENT AMT_TOTAL_RECEIVABLE CNT_INSTALMENT_MATURE_CUM")
POS_CASH_BALANCE = struct(
    long="SK_ID_PREV SK_ID_CURR", int="MONTHS_BALANCE SK_DPD SK_DPD_DEF",
    double="CNT_INSTALMENT CNT_INSTALMENT_FUTURE", string="NAME_CONTRACT_STATUS")

# file name (without extension) -> schema
SOURCES = {
    "application_train": APPLICATION_TRAIN,
    "application_test": APPLICATION_TEST,
    "bureau": BUREAU,
    "bureau_balance": BUREAU_BALANCE,
    "previous_application": PREVIOUS_APPLICATION,
    "installments_payments": INSTALLMENTS_PAYMENTS,
    "credit_card_balance": CREDIT_CARD_BALANCE,
    "POS_CASH_balance": POS_CASH_BALANCE,
}
