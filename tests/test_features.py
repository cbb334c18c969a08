"""Roll-ups on hand-made rows, key rules, hot keys."""

import math
import random

import pytest
from pyspark.sql import functions as F

from riskloom.functions.joins import hot_keys, join_rolled, join_rollup
from riskloom.operators import application, assemble, bureau, checks, credit_card, installments, pos_cash, previous
from riskloom.sources import bindings, schemas

INF = math.inf


def rows(spark, schema, *records):
    return spark.createDataFrame([tuple(r.get(c) for c in schema.names) for r in records], schema)


def one(df, key=1):
    return df.where(F.col("SK_ID_CURR") == key).first().asDict()


def bureau_tables(spark):
    loans = rows(spark, schemas.BUREAU,
                 dict(SK_ID_CURR=1, SK_ID_BUREAU=10, CREDIT_ACTIVE="Active", DAYS_CREDIT=-100, AMT_CREDIT_SUM=5.0),
                 dict(SK_ID_CURR=1, SK_ID_BUREAU=11, CREDIT_ACTIVE="Closed", DAYS_CREDIT=-10, AMT_CREDIT_SUM=7.0),
                 dict(SK_ID_CURR=1, SK_ID_BUREAU=12, CREDIT_ACTIVE="Other", DAYS_CREDIT=-20),
                 dict(SK_ID_CURR=2, SK_ID_BUREAU=13, CREDIT_ACTIVE="Sold"),
                 dict(SK_ID_CURR=None, SK_ID_BUREAU=14, CREDIT_ACTIVE="Active"))
    balance = rows(spark, schemas.BUREAU_BALANCE,
                   *[dict(SK_ID_BUREAU=10, MONTHS_BALANCE=-m, STATUS=s) for m, s in enumerate("C0156")],
                   dict(SK_ID_BUREAU=11, MONTHS_BALANCE=-8, STATUS="X"),
                   dict(SK_ID_BUREAU=None, MONTHS_BALANCE=-50, STATUS="5"))
    return loans, balance


def test_bureau(spark):
    out = bureau.bureau_features(*bureau_tables(spark))
    assert out.columns == ["SK_ID_CURR", *bureau.COLUMNS] and out.count() == 2
    got = one(out)
    assert got["bureau_loan_count"] == 3 and got["bureau_active_loans"] == 1
    assert got["bureau_active_ratio"] == pytest.approx(1 / 3)
    assert (got["bureau_month_min"], got["bureau_month_max"]) == (-8, 0)
    assert got["bureau_month_mean"] == pytest.approx((-2 + -8) / 2)          # unweighted by months
    assert got["bureau_avg_status"] == pytest.approx(((0 + 0 + 1 + 5) / 4 + 0) / 2)
    assert (got["bureau_overdue_months"], got["bureau_closed_months"], got["bureau_max_status"]) == (2, 1, 5)
    assert got["bureau_total_debt"] == 0 and got["bureau_avg_debt"] is None
    without_history = one(out, 2)
    assert without_history["bureau_overdue_months"] == 0 and without_history["bureau_total_status0"] == 0
    assert without_history["bureau_month_min"] is None and without_history["bureau_ever_overdue"] is None


def test_repeated_loan_counts_as_often_as_it_occurs(spark):
    loans, balance = bureau_tables(spark)
    got = one(bureau.bureau_features(loans.unionByName(loans.where("SK_ID_BUREAU = 11")), balance))
    assert got["bureau_loan_count"] == 4
    assert got["bureau_month_mean"] == pytest.approx((-2 + -8 + -8) / 3)


def test_hot_loan_is_spread_without_changing_the_result(spark):
    rng = random.Random(3)
    facts = spark.createDataFrame([(7 if i % 3 == 0 else rng.randrange(200), i) for i in range(3000)], "k long, c long")
    rollup = spark.createDataFrame([(k, k * 1.5) for k in range(150)], "k long, v double")
    plain = facts.join(rollup, "k", "inner")
    hot = spark.createDataFrame([(7,)], "hot long")
    salted = join_rollup(facts, rollup, "k", spread_by="c", salts=16, hot=hot)
    assert sorted(map(tuple, salted.collect())) == sorted(map(tuple, plain.collect()))
    left = join_rollup(facts, rollup, "k", spread_by="c", how="left", salts=16, hot=hot)
    assert left.count() == 3000
    placed = (facts.where("k = 7").selectExpr("pmod(xxhash64(c), 16) AS salt").groupBy("salt").count())
    assert placed.count() == 16 and placed.agg(F.max("count")).first()[0] < 200


def test_hot_keys_are_those_above_a_fair_share(spark):
    ids = spark.range(300_000).selectExpr("IF(id % 3 = 0, 7L, id) AS k")
    assert [r["hot"] for r in hot_keys(ids, "k").collect()] == [7]
    assert hot_keys(spark.range(300_000).withColumnRenamed("id", "k"), "k").count() == 0


def test_hot_loan_and_hot_applicant(spark):
    """A third of the balance rows on one loan, a third of the loans on one applicant, one
    loan shared by many applicants: same result as an unsalted plan."""
    rng = random.Random(9)
    loans = [(1 if i % 3 == 0 else rng.randrange(2, 60), 5 if i % 4 == 0 else i) for i in range(900)]
    balance = [(5 if i % 3 == 0 else rng.randrange(900), -rng.randrange(90), rng.choice("012345CX")) for i in range(6000)]
    loan_df = rows(spark, schemas.BUREAU, *[dict(SK_ID_CURR=c, SK_ID_BUREAU=b, CREDIT_ACTIVE="Active") for c, b in loans])
    balance_df = rows(spark, schemas.BUREAU_BALANCE,
                      *[dict(SK_ID_BUREAU=b, MONTHS_BALANCE=m, STATUS=s) for b, m, s in balance])
    by_loan = {}
    for b, m, s in balance:
        by_loan.setdefault(b, []).append((m, s))
    for hot in ([], [5]):
        with pytest.MonkeyPatch.context() as patch:
            named = spark.createDataFrame([(h,) for h in hot], "hot long")
            patch.setattr(bureau, "hot_keys", lambda df, key: named)
            got = {r["SK_ID_CURR"]: r for r in bureau.bureau_features(loan_df, balance_df).collect()}
        for applicant in {c for c, _ in loans}:
            own = [by_loan[b] for c, b in loans if c == applicant and b in by_loan]
            means = [sum(m for m, _ in months) / len(months) for months in own]
            assert got[applicant]["bureau_loan_count"] == sum(1 for c, _ in loans if c == applicant)
            assert got[applicant]["bureau_overdue_months"] == sum(s in "12345" for months in own for _, s in months)
            assert got[applicant]["bureau_month_mean"] == (pytest.approx(sum(means) / len(means)) if means else None)


def test_previous(spark):
    apps = rows(spark, schemas.PREVIOUS_APPLICATION,
                dict(SK_ID_PREV=1, SK_ID_CURR=1, NAME_CONTRACT_STATUS="Approved", AMT_CREDIT=10.0, DAYS_DECISION=-5),
                dict(SK_ID_PREV=2, SK_ID_CURR=1, NAME_CONTRACT_STATUS="Refused", DAYS_DECISION=-9),
                dict(SK_ID_PREV=3, SK_ID_CURR=1, NAME_CONTRACT_STATUS="Refused"),
                dict(SK_ID_PREV=4, SK_ID_CURR=1, NAME_CONTRACT_STATUS="Unused offer"))
    got = one(previous.previous_features(apps))
    assert (got["prev_application_count"], got["prev_approval_rate"], got["prev_refusal_rate"]) == (4, 0.25, 0.5)
    assert (got["prev_last_application_days"], got["prev_first_application_days"]) == (-5, -9)
    assert got["prev_total_application_amount"] == 0 and got["prev_avg_application_amount"] is None


def test_installments(spark):
    paid = rows(spark, schemas.INSTALLMENTS_PAYMENTS,
                dict(SK_ID_CURR=1, NUM_INSTALMENT_NUMBER=1, DAYS_INSTALMENT=-30.0, DAYS_ENTRY_PAYMENT=-28.0,
                     AMT_INSTALMENT=0.0, AMT_PAYMENT=5.0),
                dict(SK_ID_CURR=1, NUM_INSTALMENT_NUMBER=2, DAYS_INSTALMENT=-20.0, DAYS_ENTRY_PAYMENT=None,
                     AMT_INSTALMENT=0.0, AMT_PAYMENT=0.0),
                dict(SK_ID_CURR=1, NUM_INSTALMENT_NUMBER=3, DAYS_INSTALMENT=-10.0, DAYS_ENTRY_PAYMENT=-11.0,
                     AMT_INSTALMENT=10.0, AMT_PAYMENT=5.0))
    got = one(installments.installment_features(paid))
    assert got["inst_late_payment_count"] == 1 and got["inst_avg_delay"] == 0.5
    assert got["inst_avg_payment_ratio"] == INF and got["inst_min_payment_ratio"] == 0.5
    assert got["inst_underpaid_count"] == 1 and got["inst_count"] == 3


def test_cards_and_pos(spark):
    cards = rows(spark, schemas.CREDIT_CARD_BALANCE,
                 dict(SK_ID_PREV=1, SK_ID_CURR=1, MONTHS_BALANCE=-1, AMT_BALANCE=90.0, AMT_CREDIT_LIMIT_ACTUAL=10.0,
                      SK_DPD=3, SK_DPD_DEF=0),
                 dict(SK_ID_PREV=1, SK_ID_CURR=1, MONTHS_BALANCE=-2, AMT_BALANCE=5.0, AMT_CREDIT_LIMIT_ACTUAL=0.0,
                      SK_DPD=0, SK_DPD_DEF=1),
                 dict(SK_ID_PREV=2, SK_ID_CURR=1, MONTHS_BALANCE=-3, AMT_BALANCE=-5.0, AMT_CREDIT_LIMIT_ACTUAL=10.0))
    got = one(credit_card.credit_card_features(cards))
    assert (got["cc_card_count"], got["cc_max_utilization"], got["cc_avg_utilization"]) == (2, 5.0, 2.5)
    assert (got["cc_late_payment_count"], got["cc_serious_dpd_count"]) == (1, 1)
    assert got["cc_total_atm_drawings"] == 0 and got["cc_avg_atm_drawings"] is None
    assert (got["cc_oldest_record"], got["cc_latest_record"]) == (-3, -1)
    pos = rows(spark, schemas.POS_CASH_BALANCE,
               dict(SK_ID_PREV=1, SK_ID_CURR=1, MONTHS_BALANCE=-1, NAME_CONTRACT_STATUS="Active", CNT_INSTALMENT=6.0),
               dict(SK_ID_PREV=1, SK_ID_CURR=1, MONTHS_BALANCE=-2, NAME_CONTRACT_STATUS="Amortized debt"))
    got = one(pos_cash.pos_features(pos))
    assert (got["pos_loan_count"], got["pos_active_contracts"], got["pos_demand_contracts"]) == (1, 1, 0)
    assert got["pos_avg_instalment"] == 6.0 and len(got) == 18


def test_application_features(spark):
    app = spark.createDataFrame([(1, 100.0, 0.0, 50.0, -1000, 365243.0, 0.5, None, 0.1)],
                                "SK_ID_CURR long, AMT_INCOME_TOTAL double, AMT_CREDIT double, AMT_ANNUITY double, "
                                "DAYS_BIRTH int, DAYS_EMPLOYED double, EXT_SOURCE_1 double, EXT_SOURCE_2 double, "
                                "EXT_SOURCE_3 double")
    got = application.application_features(app).first()
    assert (got["CREDIT_INCOME_RATIO"], got["ANNUITY_INCOME_RATIO"], got["CREDIT_TERM"]) == (0.0, 0.5, INF)
    assert got["DAYS_EMPLOYED_PERC"] == -365.243 and got["EXT_SOURCE_PROD"] is None
    assert application.application_features(app, null_sentinel_first=True).first()["DAYS_EMPLOYED_PERC"] is None


def test_assemble_keeps_rows_and_does_not_fill(spark):
    apps = spark.createDataFrame([(1,), (2,), (99,)], "SK_ID_CURR long")
    loans, balance = bureau_tables(spark)
    wide = assemble.assemble(apps, [("bureau", bureau.bureau_features(loans, balance))])
    assert wide.count() == 3 and one(wide, 99)["bureau_overdue_months"] is None
    assert checks.repeated_keys(wide, "SK_ID_CURR").isEmpty()


def test_missing_key_column_fails_before_any_job(spark):
    with pytest.raises(ValueError, match="SK_ID_CURR"):
        previous.previous_features(spark.createDataFrame([(1,)], "x int"))


def test_rollups_do_not_depend_on_partitioning(spark):
    loans, balance = bureau_tables(spark)
    straight = sorted(map(tuple, bureau.bureau_features(loans, balance).collect()))
    mixed = bureau.bureau_features(loans.repartition(7).orderBy(F.rand(1)), balance.repartition(5))
    assert sorted(map(tuple, mixed.collect())) == straight


def test_roll_ups_move_only_what_they_need(spark, testdata):
    """(applicant, card) pairs are moved without the other aggregates, and a loan's months once with a count for each status."""
    cards = bindings.bound(spark, testdata, "credit_card_balance")
    pos = bindings.bound(spark, testdata, "POS_CASH_balance")
    for wide in (credit_card.credit_card_features(cards), pos_cash.pos_features(pos)):
        plan = wide._jdf.queryExecution().executedPlan().toString()
        paired = [line for line in plan.splitlines() if "Aggregate(keys=[SK_ID_CURR" in line and "SK_ID_PREV" in line.split("functions")[0]]
        assert paired and all("functions=[]" in line for line in paired)
    plan = bureau.balance_by_loan(bindings.bound(spark, testdata, "bureau_balance"))._jdf.queryExecution().executedPlan().toString()
    partial = next(line for line in plan.splitlines() if "functions=[partial_" in line)
    assert partial.split("output")[0].count("partial_") == 12


def test_rolled_rows_are_joined_whichever_keys_are_hot(spark):
    """Hot, absent, repeated and missing keys on both sides: the same rows as a plain join to the roll-up."""
    rng = random.Random(5)
    facts = spark.createDataFrame([(rng.choice([None, 7, 8, rng.randrange(200)]), i % 40) for i in range(2000)], "k long, c long")
    months = spark.createDataFrame([(rng.choice([None, 8, 9, rng.randrange(150)]), i) for i in range(3000)], "k long, v long")

    def roll(rows):
        return rows.where("k IS NOT NULL").groupBy("k").agg(F.sum("v").alias("v"), F.count("*").alias("n"))

    plain = sorted(map(tuple, facts.join(roll(months), "k").collect()))
    for hot in ([], [7, 8, 8, 9, 500]):
        named = spark.createDataFrame([(h,) for h in hot], "hot long")
        assert sorted(map(tuple, join_rolled(facts, months, "k", roll, named).collect())) == plain


def test_loans_and_their_months_are_moved_once(spark, testdata):
    """One shuffle by loan for either side of the join, of rows as they are; sums are moved only for loans with many rows."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        wide = bureau.bureau_features(bindings.bound(spark, testdata, "bureau"), bindings.bound(spark, testdata, "bureau_balance"))
        lines = wide._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    by_loan = [i for i, line in enumerate(lines) if "Exchange hashpartitioning(SK_ID_BUREAU" in line]
    summed = [i for i in by_loan if "partial_" in lines[i + 1]]
    assert len(by_loan) == 3 and len(summed) == 1 and any("LeftSemi" in line for line in lines[summed[0]:summed[0] + 5])


def test_roll_up_moves_rows_not_sums(spark, testdata):
    """Loans and earlier applications go to their applicant as they are, hot applicants' summed, and join there without another shuffle."""
    customers = bindings.bound(spark, testdata, "application").select("SK_ID_CURR")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        wide = assemble.assemble(customers, [("previous", previous.previous_features(bindings.bound(spark, testdata, "previous_application")))])
        lines = wide._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    by_applicant = [i for i, line in enumerate(lines) if "Exchange hashpartitioning(SK_ID_CURR" in line]
    summed = [i for i in by_applicant if "partial_" in lines[i + 1]]
    assert len(by_applicant) == 3 and len(summed) == 1 and any("LeftSemi" in line for line in lines[summed[0]:summed[0] + 5])


def test_hot_applicant_gets_one_row(spark):
    """A third of the rows on one applicant: found by the sketch, summed apart, same sums as a plain grouping."""
    apps = spark.range(6000).selectExpr("id AS SK_ID_PREV", "IF(id % 3 = 0, 7L, id % 500) AS SK_ID_CURR",
                                        "IF(id % 2 = 0, 'Approved', 'Refused') AS NAME_CONTRACT_STATUS", "CAST(id % 11 AS DOUBLE) AS AMT_CREDIT")
    apps = apps.selectExpr("*", *[f"CAST(NULL AS DOUBLE) AS {c}" for c in (
        "AMT_APPLICATION", "AMT_DOWN_PAYMENT", "AMT_ANNUITY", "AMT_GOODS_PRICE", "DAYS_DECISION", "SELLERPLACE_AREA", "CNT_PAYMENT")])
    assert [r["hot"] for r in hot_keys(apps, "SK_ID_CURR").collect()] == [7]
    columns = ("SK_ID_CURR", "prev_application_count", "prev_total_credit", "prev_approved_count", "prev_avg_application_amount")
    got = sorted(map(tuple, previous.previous_features(apps).select(*columns).collect()))
    plain = apps.groupBy("SK_ID_CURR").agg(F.count("*"), F.sum("AMT_CREDIT"), F.count_if(F.col("NAME_CONTRACT_STATUS") == "Approved"), F.max("AMT_APPLICATION"))
    assert got == sorted(map(tuple, plain.collect()))
