"""Random parameter search for the best families, resumable through a trials table."""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Mapping, Sequence

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.writers import exists
from .models import FAMILIES, SEED

TRIALS = "family string, trial int, params string, val_roc_auc double"
N_TRIALS = 100

# Fixed values: (low, high, kind) per parameter that has a counterpart in Spark ML.
SPACES = {
    "sgd": {"l1_ratio": (0.0, 1.0, "float"), "alpha": (1e-6, 1e-1, "log")},
    "xgb": {"max_depth": (3, 10, "int"), "learning_rate": (0.01, 0.3, "log"), "subsample": (0.6, 1.0, "float"),
            "colsample_bytree": (0.6, 1.0, "float"), "min_child_weight": (1, 10, "int")},
    "lgbm": {"num_leaves": (15, 255, "int"), "max_depth": (-1, 12, "int"), "learning_rate": (0.01, 0.3, "log"),
             "subsample": (0.6, 1.0, "float"), "colsample_bytree": (0.6, 1.0, "float"),
             "min_child_samples": (5, 100, "int")},
    "catbc": {"depth": (4, 10, "int"), "learning_rate": (0.01, 0.3, "log")},
}


def sample_params(key: str, trial: int, seed: int = SEED) -> dict[str, float]:
    """Trial 0 is the baseline's own parameters; later ones depend on the trial number alone."""
    if trial == 0:
        return dict(FAMILIES[key].params)
    rng = np.random.default_rng([seed, list(SPACES).index(key), trial])
    drawn = {}
    for name, (low, high, kind) in SPACES[key].items():
        if kind == "int":
            drawn[name] = int(rng.integers(low, high + 1))
        elif kind == "log":
            drawn[name] = float(math.exp(rng.uniform(math.log(low), math.log(high))))
        else:
            drawn[name] = float(rng.uniform(low, high))
    return drawn


def read_trials(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TRIALS).parquet(path) if exists(spark, path) else spark.createDataFrame([], TRIALS)


def search(spark: SparkSession, families: Sequence[str], objective: Callable[[str, Mapping[str, float]], float],
           path: str, n_trials: int = N_TRIALS, seed: int = SEED) -> DataFrame:
    """Run the trials that ``path`` does not hold yet, one appended row each; return them all."""
    done = {(r["family"], r["trial"]) for r in read_trials(spark, path).select("family", "trial").collect()}
    for key in families:
        for trial in range(n_trials):
            if (key, trial) in done:
                continue
            params = sample_params(key, trial, seed)
            value = objective(key, params)
            row = (key, trial, json.dumps(params, sort_keys=True), None if value is None else float(value))
            spark.createDataFrame([row], TRIALS).coalesce(1).write.mode("append").parquet(path)
    return read_trials(spark, path)


def search_summary(trials: DataFrame) -> DataFrame:
    """Best trial per family (ties: the earliest) and whether it wins overall."""
    order = F.struct(F.col("val_roc_auc"), -F.col("trial"))
    best = trials.groupBy("family").agg(
        F.max("val_roc_auc").alias("val_roc_auc"), F.max_by("trial", order).alias("trial"),
        F.max_by("params", order).alias("params"), F.count("*").alias("trials"))
    # a handful of rows from here on
    leader = best.agg(F.max_by("family", F.struct("val_roc_auc", "family")).alias("family")).withColumn("winner", F.lit(True))
    return best.join(F.broadcast(leader), "family", "left").select(
        "family", "val_roc_auc", "trial", "params", "trials", F.coalesce("winner", F.lit(False)).alias("winner"))


def best_params(trials: DataFrame) -> dict[str, dict]:
    """{family: {params, val_roc_auc}}; empty without trials."""
    return {r["family"]: {"params": json.loads(r["params"]), "val_roc_auc": r["val_roc_auc"]}
            for r in search_summary(trials).collect()}
