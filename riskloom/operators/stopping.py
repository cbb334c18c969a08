"""How many trees of a boosted model to keep, by ROC-AUC on validation rows with patience.

One pass sums the trees' outputs along each row and counts the rows by number of trees and probability range. That brackets the
area after every tree; only where brackets leave the stop or the best length open are areas measured exactly.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import stage, staged_path, unstage
from .metrics import roc_aucs

#: rounds without gain after which boosting ends
PATIENCE = 250
#: probability ranges by which rows are counted
RANGES = 2048
#: brackets are widened by this, beyond the rounding of their sums
SLACK = 1e-12
#: lengths whose areas are measured in one pass
MEASURED = 64


@dataclass
class Outputs:
    """(tree, leaf) -> what the leaf adds to the margin."""

    values: np.ndarray

    @staticmethod
    def of(spark: SparkSession, model) -> "Outputs":
        """From the saved form of a model, whose nodes are as many as the model has (not the data)."""
        path = staged_path(spark, "trees")
        model.write().save(path)
        nodes = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.id", "nodeData.prediction", "nodeData.leftChild",
                                                         "nodeData.rightChild").collect()
        unstage(spark, path)
        trees: dict[int, dict[int, tuple]] = {}
        for tree, node, prediction, left, right in nodes:
            trees.setdefault(tree, {})[node] = (prediction, left, right)
        leaves = [_leaves(trees[t]) for t in sorted(trees)]
        values = np.zeros((len(leaves), max(map(len, leaves))))
        for t, (of_tree, weight) in enumerate(zip(leaves, model.treeWeights)):
            values[t, :len(of_tree)] = weight * np.asarray(of_tree)
        return Outputs(values)

    def margins(self, leaves: np.ndarray) -> np.ndarray:
        """(rows, trees): the sum of each row's outputs up to every tree."""
        return np.cumsum(self.values[np.arange(len(self.values)), leaves], axis=1)


def _leaves(nodes: dict[int, tuple]) -> list[float]:
    """Predictions of a tree's leaves, left to right, as the trees number them."""
    found, todo = [], [0]
    while todo:
        prediction, left, right = nodes[todo.pop()]
        if left < 0:
            found.append(prediction)
        else:
            todo += [right, left]
    return found


def _leaf_rows(model, rows: DataFrame) -> DataFrame:
    """(label, leaves): the number of the leaf that each tree puts a row in."""
    marked = model.copy()
    marked.setLeafCol("leaves")
    return marked.transform(rows).select("label", vector_to_array("leaves").alias("leaves"))


def _batches(outputs: Outputs, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    trees = len(outputs.values)
    for batch in batches:
        leaves = np.asarray(batch.column("leaves").flatten()).astype(np.int64).reshape(-1, trees)
        yield np.asarray(batch.column("label")) == 1, outputs.margins(leaves)


def brackets(model, rows: DataFrame, outputs: Outputs, ranges: int = RANGES) -> list[tuple[float, float]]:
    """[(least, greatest area) after tree 1, 2, ...] over the rows; a task sends one count for each tree and range at most."""
    trees = len(outputs.values)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, trees * ranges), np.int64)
        first = np.arange(trees) * ranges
        for positive, margins in _batches(outputs, batches):
            place = np.minimum((ranges / (1 + np.exp(-2 * margins))).astype(np.int64), ranges - 1) + first
            for truth in (0, 1):
                counts[truth] += np.bincount(place[positive == truth].ravel(), minlength=trees * ranges)
        held = np.flatnonzero(counts.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(held // ranges), pa.array(held % ranges), pa.array(counts[0, held]),
                                          pa.array(counts[1, held])], ["tree", "range", "neg", "pos"])

    cells = _leaf_rows(model, rows).mapInArrow(count, "tree long, range long, neg long, pos long")
    cells = cells.groupBy("tree", "range").agg(F.sum("neg").alias("neg"), F.sum("pos").alias("pos"))
    before = Window.partitionBy("tree").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)   # over RANGES rows
    ranked = cells.withColumn("below", F.coalesce(F.sum("neg").over(before), F.lit(0)))
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    found = ranked.groupBy("tree").agg(
        F.try_divide(F.sum(F.col("pos").cast("double") * F.col("below")), pairs).alias("least"),
        F.try_divide(F.sum(F.col("pos").cast("double") * (F.col("below") + F.col("neg"))), pairs).alias("greatest")).orderBy("tree").collect()
    if any(r["least"] is None for r in found):
        return []
    return [(r["least"] - SLACK, r["greatest"] + SLACK) for r in found]


def areas_after(model, rows: DataFrame, outputs: Outputs, lengths: Sequence[int]) -> dict[int, float]:
    """{number of trees: exact area}, MEASURED lengths to a pass."""
    found: dict[int, float] = {}
    for low in range(0, len(lengths), MEASURED):
        some = sorted(lengths)[low:low + MEASURED]
        names = [f"after_{n}" for n in some]
        at = np.asarray(some) - 1

        def margins(batches: Iterator[pa.RecordBatch], at=at, names=names) -> Iterator[pa.RecordBatch]:
            for positive, sums in _batches(outputs, batches):
                yield pa.RecordBatch.from_arrays([pa.array(positive.astype(np.int32)), *[pa.array(sums[:, i]) for i in at]],
                                                 ["label", *names])

        scored = _leaf_rows(model, rows).mapInArrow(margins, "label int, " + ", ".join(f"{n} double" for n in names))
        areas = roc_aucs(stage(scored, "margins"), names, "label").collect()
        found.update({int(r["feature"].split("_")[1]): r["roc_auc"] for r in areas})
    return found


def decide(bounds: Sequence[tuple[float, float]], patience: int) -> tuple[int, bool] | set[int]:
    """(trees to keep, whether patience ended it) if brackets of the areas tell, or the lengths to measure.

    Boosting ends after ``patience`` trees in a row without an area above all earlier ones; the first length with the greatest
    area up to there is kept.
    """
    least = greatest = -1.0
    sure, maybe = 0, []         # last length that surely was a new best, and later ones that may have been
    end, stopped = len(bounds), False
    for n, (low, high) in enumerate(bounds, 1):
        if low > greatest:
            sure, maybe = n, []
        elif high > least:
            maybe.append(n)
        least, greatest = max(least, low), max(greatest, high)
        if n - sure >= patience:
            if maybe:
                return {m for m, (lo, hi) in enumerate(bounds[:n], 1) if lo < hi and hi >= bounds[sure - 1][0]}
            end, stopped = n, True
            break
    top = max(low for low, _ in bounds[:end])
    finalists = [n for n, (_, high) in enumerate(bounds[:end], 1) if high >= top]
    if len(finalists) > 1 and (unsure := {n for n in finalists if bounds[n - 1][0] < bounds[n - 1][1]}):
        return unsure
    return finalists[0], stopped


def kept_trees(model, rows: DataFrame, patience: int = PATIENCE, ranges: int = RANGES) -> tuple[int, bool, float | None]:
    """(trees to keep, whether patience ended it, their area) of a model on validation rows (features, label).

    With one class among the rows there is no area, and all trees stay.
    """
    outputs = Outputs.of(rows.sparkSession, model)
    bounds = brackets(model, rows, outputs, ranges)
    if not bounds:
        return len(outputs.values), False, None
    while isinstance(found := decide(bounds, patience), set):
        for n, area in areas_after(model, rows, outputs, sorted(found)).items():
            bounds[n - 1] = (area, area)
    kept, stopped = found
    low, high = bounds[kept - 1]
    area = low if low == high else areas_after(model, rows, outputs, [kept])[kept]
    return kept, stopped, area
