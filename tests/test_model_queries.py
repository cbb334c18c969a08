"""The registered model queries fit with the families' whole budget."""

import pytest

import catalog
from riskloom.operators import models
from riskloom.operators.stopping import PATIENCE


@pytest.fixture
def asked(spark, monkeypatch):
    """(family, rounds, patience) that fits were asked for; two trees are made, so that a test is short."""
    rows = spark.createDataFrame(
        [(i, int(i % 7 < 3), float(i % 7 + i % 2), "ab"[i % 2], "train" if i % 5 < 3 else "val" if i % 5 == 3 else "eval") for i in range(350)],
        "SK_ID_CURR long, TARGET int, AMT double, KIND string, split string")
    monkeypatch.setattr(catalog, "_split", lambda *_: rows)
    found, boosted, estimator = [], models._boosted, models.estimator

    def short(prepared, params, rounds, patience):
        found.append((prepared.key, rounds, patience))
        return boosted(prepared, params, 2, 1)

    def linear(key, params, rounds, *rest):
        found.extend([(key, rounds, None)] if key == "sgd" else [])
        return estimator(key, params, rounds, *rest)
    monkeypatch.setattr(models, "_boosted", short)
    monkeypatch.setattr(models, "estimator", linear)
    return found


def test_final_model_has_the_whole_budget(spark, asked):
    row = catalog.final_model(spark, None).first()
    assert asked == [("catbc", 1000, PATIENCE)] and PATIENCE == 250 and row["trained_rows"] == 350


def test_train_baselines_has_the_whole_budget(spark, asked):
    found = catalog.train_baselines(spark, None).collect()
    assert sorted(asked) == [("catbc", 1000, PATIENCE), ("lgbm", 1000, PATIENCE), ("sgd", 200, None), ("xgb", 1000, PATIENCE)]
    assert sorted(r["model"] for r in found) == sorted(models.KEY_OF) and all(
        r["scored_rows"] == 70 and r["metrics_valid"] and r["metrics_hold"] and r["ranked"] for r in found)


def test_fits_take_few_partitions_and_every_row(spark):
    """A small table is not cut into a partition for each file; no row is lost by that."""
    rows = spark.createDataFrame([(i, i % 2, float(i % 9)) for i in range(400)], "SK_ID_CURR long, TARGET int, AMT double").repartition(5, "AMT")
    prepared = models.prepare("xgb", rows)
    assert prepared.train.rdd.getNumPartitions() == 1 and prepared.train.count() == 400
