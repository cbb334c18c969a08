"""The number of trees to keep against plain recomputation, prefix by prefix."""

import random

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from riskloom.operators import models, stopping


def area(scores, labels):
    pos, neg = scores[labels == 1][:, None], scores[labels == 0][None, :]
    return float(((pos > neg) + 0.5 * (pos == neg)).mean())


def kept_by_hand(areas, patience):
    best, last = -1.0, 0
    for n, a in enumerate(areas, 1):
        if a > best:
            best, last = a, n
        elif n - last >= patience:
            return last, True
    return last, False


def test_decisions_from_brackets():
    """Whatever the brackets leave open is measured, and the outcome is that of the areas themselves."""
    rng = random.Random(4)
    for _ in range(400):
        size, patience, wide = rng.randrange(1, 60), rng.randrange(1, 12), rng.choice([0.0, 0.01, 0.05, 0.3])
        areas = [round(0.5 + 0.3 * (1 - 0.9 ** n) + rng.gauss(0, 0.03), rng.choice([2, 6])) for n in range(size)]
        bounds = [(a - rng.random() * wide, a + rng.random() * wide) for a in areas]
        for _ in range(size + 2):
            found = stopping.decide(bounds, patience)
            if not isinstance(found, set):
                break
            assert found and all(bounds[n - 1][0] < bounds[n - 1][1] for n in found)
            for n in found:
                bounds[n - 1] = (areas[n - 1], areas[n - 1])
        assert found == kept_by_hand(areas, patience)


@pytest.fixture(scope="module")
def boosted(spark):
    rng = random.Random(12)
    rows = []
    for i in range(700):
        x = [rng.gauss(0, 1) for _ in range(4)]
        rows.append((i, *x, float(rng.randrange(3)), float(rng.random() < 1 / (1 + np.exp(-x[0] - x[1] * x[2])))))
    df = spark.createDataFrame(rows, "i int, a double, b double, c double, d double, e double, label double")
    df = VectorAssembler(inputCols=list("abcde"), outputCol="features").transform(df)
    train, val = df.where("i % 3 > 0"), df.where("i % 3 = 0").repartition(3)
    model = GBTClassifier(maxIter=24, maxDepth=4, stepSize=0.4, subsamplingRate=0.7, seed=3).fit(train)
    labels = np.asarray([r["label"] for r in val.orderBy("i").select("label").collect()])
    margins, total = [], np.zeros(len(labels))
    for tree, weight in zip(model.trees, model.treeWeights):
        total = total + weight * np.asarray([r["p"] for r in tree.transform(val).orderBy("i").select(F.col("prediction").alias("p")).collect()])
        margins.append(total)
    return model, train, val, [area(m, labels) for m in margins]


@pytest.mark.parametrize("ranges, patience", [(2048, 5), (4, 3), (1, 24)])
def test_kept_trees(boosted, ranges, patience):
    model, _, val, areas = boosted
    kept, stopped, found = stopping.kept_trees(model, val, patience, ranges)
    assert (kept, stopped) == kept_by_hand(areas, patience) and found == pytest.approx(areas[kept - 1])


def test_every_prefix(spark, boosted, monkeypatch):
    model, train, val, areas = boosted
    monkeypatch.setattr(stopping, "MEASURED", 10)
    outputs = stopping.Outputs.of(spark, model)
    found = stopping.areas_after(model, val, outputs, range(1, 25))
    assert [found[n] for n in range(1, 25)] == pytest.approx(areas)
    for (low, high), a in zip(stopping.brackets(model, val, outputs, 64), areas):
        assert low <= a <= high and high - low < 0.2
    shorter = GBTClassifier(maxIter=7, maxDepth=4, stepSize=0.4, subsamplingRate=0.7, seed=3).fit(train)
    assert [t.toDebugString for t in shorter.trees] == [t.toDebugString for t in model.trees[:7]] or (
        stopping.Outputs.of(spark, shorter).values[:, :4] == outputs.values[:7, :4]).all()


def test_one_class(boosted):
    model, _, val, _ = boosted
    assert stopping.kept_trees(model, val.where("label = 1"), 2) == (24, False, None)


def test_first_trees_are_the_shorter_fit(spark, boosted, tmp_path):
    """A model cut to its first trees scores, saves and loads as the fit of that many trees."""
    model, train, val, _ = boosted
    shorter = GBTClassifier(maxIter=7, maxDepth=4, stepSize=0.4, subsamplingRate=0.7, seed=3).fit(train)
    cut = models.first_trees(model, 7)
    cut.write().save(str(tmp_path / "cut"))
    shown = [[r["probability"][1] for r in m.transform(val).orderBy("i").select("probability").collect()]
             for m in (shorter, cut, GBTClassificationModel.load(str(tmp_path / "cut")))]
    assert cut.getNumTrees == 7 and cut.treeWeights == shorter.treeWeights
    assert shown[1] == pytest.approx(shown[0]) and shown[2] == pytest.approx(shown[0])


def test_a_small_budget_is_fitted_once(boosted, monkeypatch):
    """Neither growing lengths nor the kept one are fits of their own, and a search does not repeat a fit."""
    _, train, val, areas = boosted
    fits, real = [], models.estimator

    def counted(key, params, rounds, *rest):
        fits.append(rounds)
        return real(key, params, rounds, *rest)
    monkeypatch.setattr(models, "estimator", counted)
    rows = train.selectExpr("features", "label", "1D AS weight")
    prepared = models.Prepared("xgb", None, PipelineModel([]), rows, val.select("features", "label"), 64, None)
    bundle = models.fit_prepared(prepared, {"max_depth": 4}, rounds=24, patience=8)
    kept, _, area = stopping.kept_trees(bundle.pipeline.stages[-1], prepared.val, 24)
    assert models.evaluate_params(prepared, {"max_depth": 4}, 24, 8) == pytest.approx(area) and kept == models.fitted_rounds(bundle)
    assert fits == [24]
