"""Quantiles, ranks, correlation and ROC-AUC against brute force, with the scale paths forced."""

import math
import random

import pandas as pd
import pytest

from pyspark.sql import functions as F

from riskloom.functions import ranks
from riskloom.functions.quantiles import quantiles
from riskloom.functions.sketches import column_sketches, quantile_array
from riskloom.operators import correlation, metrics, profiling


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(5)
    records = []
    for i in range(2400):
        hot = rng.random() < 0.34       # one value holds a third of the rows
        a = 0.0 if hot else round(rng.gauss(0, 100), 3)
        b = None if i % 7 == 0 else float(rng.randrange(30))
        c = None if i % 7 == 0 else a * 2 + rng.random()
        d = None if rng.random() < 0.5 else rng.expovariate(1)
        records.append((i, int(rng.random() < 0.2 + 0.3 * (a > 0)), a, b, c, d, 4.0, None))
    schema = "SK_ID_CURR long, TARGET int, a double, b double, c double, d double, flat double, empty double"
    df = spark.createDataFrame(records, schema).repartition(6)
    pdf = pd.DataFrame(records, columns=df.columns).astype({"empty": float})
    return df, pdf


PROBS = (0.0, 0.0025, 0.25, 0.5, 0.75, 0.99, 1.0)


@pytest.mark.parametrize("accuracy, exact_rows", [(4000, 1_000_000), (100, 500), (20, 100), (20, 15), (100, 5)])
def test_quantiles_are_exact(table, accuracy, exact_rows):
    df, pdf = table
    got = quantiles(df, ["a", "b", "c", "d", "flat", "empty"], PROBS, accuracy=accuracy, exact_rows=exact_rows)
    for c in ("a", "b", "c", "d", "flat"):
        assert got[None, c] == pytest.approx(list(pdf[c].quantile(PROBS)))
    assert got[None, "empty"] == [None] * len(PROBS)


def test_quantiles_by_label(table):
    df, pdf = table
    got = quantiles(df, ["a", "d"], (0.25, 0.5), by="TARGET", accuracy=50, exact_rows=60)
    for label in (0, 1):
        for c in ("a", "d"):   # accuracy 50 on 100 rows: sketched twice
            assert got[label, c] == pytest.approx(list(pdf[pdf.TARGET == label][c].quantile((0.25, 0.5))))


def test_small_quantiles(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "x double")
    assert quantiles(df, ["x"], (0.25, 0.5, 0.75))[None, "x"] == [1.75, 2.5, 4.75]


def spearman(x, y):
    both = x.notna() & y.notna()
    rx, ry = x[both].rank(), y[both].rank()
    return rx.corr(ry) if rx.nunique() > 1 and ry.nunique() > 1 else None


@pytest.mark.parametrize("rows_per_range", [1_000_000, 150])
def test_spearman_with_label(table, rows_per_range):
    df, pdf = table
    columns = ["a", "b", "c", "d", "flat"]
    got = {r["feature"]: r["rho"] for r in correlation.spearman_with_label(df, columns, rows_per_range=rows_per_range).collect()}
    for c in columns[:-1]:
        assert got[c] == pytest.approx(spearman(pdf[c], pdf["TARGET"]))
    assert got["flat"] is None


@pytest.mark.parametrize("rows_per_range, frequent, pairs", [(1_000_000, 2000, 512), (150, 2, 4)])
def test_spearman_matrix_ranks_within_each_pair(table, monkeypatch, rows_per_range, frequent, pairs):
    monkeypatch.setattr(correlation, "FREQUENT", frequent)   # 2: only the hot values are broadcast
    monkeypatch.setattr(correlation, "PAIRS", pairs)
    df, pdf = table
    columns = ["a", "b", "c", "d", "flat", "TARGET"]
    out = correlation.spearman_matrix(df, columns, rows_per_range=rows_per_range).collect()
    assert len(out) == 15
    for r in out:
        assert columns.index(r["feature_x"]) > columns.index(r["feature_y"])
        expected = spearman(pdf[r["feature_x"]], pdf[r["feature_y"]])
        assert r["rho"] == (pytest.approx(expected) if expected is not None else None)


@pytest.mark.parametrize("rows_per_range", [1_000_000, 100])
def test_roc_auc(table, rows_per_range):
    df, pdf = table
    score, label = pdf["a"], pdf["TARGET"]
    pos, neg = score[label == 1].to_numpy()[:, None], score[label == 0].to_numpy()[None, :]
    expected = ((pos > neg) + 0.5 * (pos == neg)).mean()
    assert metrics.roc_auc(df, "a", rows_per_range=rows_per_range).first()["roc_auc"] == pytest.approx(expected)


def test_roc_auc_of_models_with_narrow_scores(spark):
    """One model's scores lie within a hundredth of the others' range; it is cut as finely as they are."""
    rng = random.Random(9)
    records = [(m, int(rng.random() < 0.3), round(rng.random() * wide + low, 6))
               for m, wide, low in (("wide", 1.0, 0.0), ("narrow", 0.01, 0.5), (None, 0.5, 0.2)) for _ in range(900)]
    df = spark.createDataFrame(records, "model string, TARGET int, p double")
    cells, cuts = ranks.grouped_cells(df, "p", ["model"], ["TARGET"], 100)
    assert len(cuts) == 3 and all(len(at) >= 7 for at in cuts.values())
    sizes = {(r["model"], r["range"]): r["n"] for r in cells.groupBy("model", "range").agg(F.count("*").alias("n")).collect()}
    assert max(sizes.values()) < 200 and len(sizes) >= 24
    got = {r["model"]: r["roc_auc"] for r in metrics.roc_auc(df, "p", by=["model"], rows_per_range=100).collect()}
    for model in ("wide", "narrow", None):
        pos, neg = ([p for m, y, p in records if m == model and y == v] for v in (1, 0))
        assert got[model] == pytest.approx(sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / len(pos) / len(neg))


def test_roc_auc_small(spark):
    df = spark.createDataFrame([(0.1, 0), (0.4, 0), (0.4, 1), (0.8, 1)], "p double, TARGET int")
    assert metrics.roc_auc(df, "p").first()["roc_auc"] == 0.875
    assert metrics.roc_auc(df.where("TARGET = 1"), "p").first()["roc_auc"] is None


def test_no_positive_guess_has_zero_precision(spark):
    df = spark.createDataFrame([(0.1, 0), (0.4, 1), (0.5, 1)], "p double, TARGET int")
    got = metrics.confusion_metrics(df, "p").first()
    assert (got["tp"], got["fp"], got["fn"], got["tn"]) == (0, 0, 2, 1)
    assert (got["precision"], got["recall"], got["f1"]) == (0.0, 0.0, 0.0) and got["accuracy"] == pytest.approx(1 / 3)


def test_model_ranking_breaks_ties_by_name(spark):
    df = spark.createDataFrame([(m, y, p) for m, ps in (("b", (0.1, 0.9)), ("a", (0.2, 0.8)), ("c", (0.9, 0.1)))
                                for y, p in zip((0, 1), ps)], "model string, TARGET int, probability double")
    table = metrics.compare_models(df)
    assert [(r["model"], r["rank"]) for r in table.orderBy("rank").collect()] == [("a", 1), ("b", 2), ("c", 3)]
    assert [r["model"] for r in metrics.top_models(table, 2).collect()] == ["a", "b"]


def test_describe_with_infinity(spark):
    df = spark.createDataFrame([(1.0, 1), (2.0, 2), (math.inf, 3), (None, 4)], "x double, k int")
    got = {r["feature"]: r for r in profiling.describe(df).collect()}
    assert got["x"]["n"] == 3 and got["x"]["mean"] == math.inf and got["x"]["std"] is None
    assert (got["x"]["q25"], got["x"]["max"]) == (1.5, math.inf) and got["k"]["q75"] == 3.25


def test_box_stats(table):
    df, pdf = table
    got = {(r["TARGET"], r["feature"]): r for r in profiling.box_stats(df, ["a", "d"]).collect()}
    for label in (0, 1):
        x = pdf[pdf.TARGET == label]["d"].dropna()
        q1, q3 = x.quantile(0.25), x.quantile(0.75)
        low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        row = got[label, "d"]
        assert row["high_whisker"] == pytest.approx(x[x <= high].max())
        assert row["low_whisker"] == pytest.approx(x[x >= low].min())
        assert row["outliers"] == ((x < low) | (x > high)).sum()


def test_near_constant(spark):
    df = spark.range(1000).selectExpr(
        "id", "IF(id < 996, 'x', 'y') AS text", "IF(id < 4, 1.5D, NULL) AS gaps", "IF(id < 994, 0, 1) AS close",
        "CAST(0 AS BIGINT) AS flat", "id % 2 = 0 AS flag")
    assert profiling.near_constant_columns(df) == ["text", "gaps", "flat"]
    assert {r["feature"]: r["top_share"] for r in profiling.near_constant(df).collect()}["gaps"] == 0.996


def test_near_constant_of_dates_and_any_share(spark):
    df = spark.range(10).selectExpr("DATE'2020-01-02' AS day", "IF(id < 3, TIMESTAMP'2020-01-02 03:04:05', timestamp_seconds(id)) AS at",
                                    "IF(id < 5, -0.0D, 0.0D) AS zero", "array(1, 2) AS list")
    assert {r["feature"]: r["top_share"] for r in profiling.near_constant(df, 0.3).collect()} == {
        "day": 1.0, "at": 0.3, "zero": 1.0, "list": 1.0}
    assert profiling.binary_columns(df.select("day", "at", "zero")) == ["day", "zero"]


def test_decisions(spark):
    names = ["TARGET", "SK_ID_X", "flag", "DAYS_EMPLOYED", "calm", "wild"]
    records = [(i % 2, i, i % 2, -float(i), float(i), 1e6 if i % 5 == 0 else float(i % 3)) for i in range(100)]
    report = {r["feature"]: r for r in profiling.column_report(spark.createDataFrame(records, names)).collect()}
    assert [report[n]["decision"] for n in names] == [
        "Target", "Ignore (ID)", "Binary", "Replace sentinel", "Keep", "Investigate"]
    assert report["wild"]["outlier_pct"] == 20.0 and report["calm"]["distinct_values"] == 100


def test_clipping_uses_train_bounds(spark):
    train = spark.createDataFrame([(float(i), i % 2, -i, i, None) for i in range(9)], "x double, flag int, DAYS_A int, month_b int, t string")
    chosen = profiling.columns_to_clip(train)
    assert chosen == ["x"]
    test = spark.createDataFrame([(100.0,), (None,), (-100.0,)], "x double")
    bounds = profiling.fit_iqr_bounds(train, chosen)
    assert [r["x"] for r in profiling.clip_to_bounds(test, bounds, chosen).collect()] == [12.0, None, -4.0]


def test_duplicates(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "a"), (1, None)], "k int, s string")
    assert tuple(profiling.duplicate_report(df).first()) == (4, 2)
    assert profiling.drop_duplicates(df).count() == 2


def test_sketches_of_columns_side_by_side(spark, table):
    """No row for each cell; counts and quantiles as the sketch of such rows gives them."""
    df = table[0] if isinstance(table, tuple) else table
    wide = column_sketches(df, ["a", "empty"], [], 200)
    assert "explode" not in wide._jdf.queryExecution().executedPlan().toString()
    shown = {r["feature"]: (r["n"], r["at"]) for r in wide.select("feature", "n", quantile_array("sketch", [0.0, 1.0]).alias("at")).collect()}
    ends = df.selectExpr("count(a) AS n", "array(double(min(a)), double(max(a))) AS at").first()
    assert shown == {"a": (ends["n"], ends["at"]), "empty": (0, None)}
