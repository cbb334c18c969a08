"""Registered queries against their DuckDB statements; RISKLOOM_QUICK=1 compares some of them."""

import os

import pytest

import __spark_entry__ as contract
import catalog
import check
from oracles.statements import STATEMENTS

QUICK = ["status_map", "bureau_features", "previous_features", "installment_features", "credit_card_features",
         "pos_features", "application_features", "scan_normalize_missing", "csv_round_trip", "feature_summary",
         "duplicate_report", "check_keys_unique", "stratified_split", "one_hot_drop_first", "frozen_vocab",
         "target_encode", "model_comparison", "pad_missing_columns", "threshold_decision", "search_summary"]
NAMES = QUICK if os.environ.get("RISKLOOM_QUICK") else sorted(STATEMENTS)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_statement(spark, testdata, name):
    ok, note = check.compare(spark, check.duck(testdata), name, testdata)
    assert ok, note


def test_every_statement_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(catalog.QUERIES) == set(STATEMENTS)
