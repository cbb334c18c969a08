"""One small table per missing-value and infinity rule, expected values written out."""

import math

import pytest
from pyspark.sql import functions as F

from riskloom.functions import scalar
from riskloom.functions.sqltext import number
from riskloom.operators.bureau import status_number
from riskloom.operators.cleaning import clean
from riskloom.sources.readers import normalize_missing

INF = math.inf


def column(df, expr):
    return [r[0] for r in df.select(expr).collect()]


def test_all_null_group_sums_to_zero(spark):
    row = spark.createDataFrame([(None,)], "x double").agg(
        scalar.total("x"), F.count("x"), F.avg("x"), F.min("x")).first()
    assert tuple(row) == (0.0, 0, None, None)


def test_division_by_zero(spark):
    df = spark.createDataFrame([(1, 1.0, 0.0), (2, 0.0, 0.0), (3, -1.0, 0.0), (4, 1.0, 2.0), (5, None, 0.0)],
                               "i int, n double, d double").orderBy("i")
    assert column(df, scalar.divide("n", "d")) == [INF, None, -INF, 0.5, None]
    assert df.where("i IN (1, 4)").select(F.avg(scalar.divide("n", "d"))).first()[0] == INF


def test_infinite_mean_is_nulled_by_cleaning(spark):
    df = spark.createDataFrame([(INF, 365243.0, 1), (-INF, -5.0, 2), (float("nan"), None, 3)],
                               "ratio double, DAYS_EMPLOYED double, k int")
    assert [tuple(r) for r in clean(df).orderBy("k").collect()] == [(None, None, 1), (None, -5.0, 2), (None, None, 3)]


def test_nan_is_not_counted(spark):
    df = normalize_missing(spark.createDataFrame([(float("nan"),), (2.0,), (0.5,)], "x double"))
    assert tuple(df.agg(F.count_if(F.col("x") > 0), F.count_if(F.col("x") < 1)).first()) == (2, 1)


def test_missing_tokens(spark):
    df = spark.createDataFrame([("NA",), ("XNA",), ("",), ("None",), ("a",), (None,)], "s string")
    assert column(normalize_missing(df), "s") == [None, "XNA", None, None, "a", None]


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(None,), (-1.0,), (7.0,), (2.0,)], "x double")
    assert column(df, scalar.clip("x", 0, 5)) == [None, 0.0, 5.0, 2.0]


def test_status_number(spark):
    df = spark.createDataFrame([("6",), (None,), ("C",), ("X",), ("5",), ("0",)], "STATUS string")
    assert column(df, status_number()) == [None, None, 0, 0, 5, 0]


def test_row_statistics(spark):
    df = spark.createDataFrame([(0.2, None, 0.4), (0.2, None, None), (None, None, None), (0.5, 0.5, 0.2)],
                               "a double, b double, c double")
    names = ("a", "b", "c")
    assert column(df, scalar.row_mean(*names)) == pytest.approx([0.3, 0.2, None, 0.4], nan_ok=True)
    assert column(df, scalar.row_std(*names))[0] == pytest.approx(math.sqrt(0.02))
    assert column(df, scalar.row_std(*names))[1:3] == [None, None]
    assert column(df, scalar.row_product(*names)) == pytest.approx([None, None, None, 0.05])


@pytest.mark.parametrize("values, expected", [
    ([1, 2, 3, 10], 1.763632614803888), ([1, 1, 1], 0.0), ([1, 2], None), ([1, 2, None, 3, 10], 1.763632614803888)])
def test_sample_skewness(spark, values, expected):
    df = spark.createDataFrame([(float(v) if v is not None else None,) for v in values], "x double")
    assert df.agg(scalar.sample_skewness("x")).first()[0] == pytest.approx(expected)


@pytest.mark.parametrize("value", [0.1, 1e-12, -2.5e300, INF, -INF, None, 365243.0])
def test_number_literals_keep_every_bit(spark, value):
    assert spark.range(1).selectExpr(f"{number(value)} AS x").first()["x"] == value


def test_hundredths_go_as_the_statements_round(spark):
    """Halves go away from zero (not to the even digit), judged on the double: 1.005 is less than a half."""
    import duckdb
    values = [0.125, 0.375, -0.125, 2.675, 1.005, 0.285, 80.625, 1e-9, -3.0, None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    shown = [r["r"] for r in df.select("i", scalar.hundredths("v").alias("r")).orderBy("i").collect()]
    assert shown == [duckdb.sql(f"SELECT round({'NULL' if v is None else repr(v)}::DOUBLE, 2)").fetchall()[0][0] for v in values]
    assert shown[0] == 0.13
