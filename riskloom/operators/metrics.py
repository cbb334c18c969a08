"""Classification metrics and the model comparison table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ranks import ROWS_PER_RANGE, cut_points, grouped_cells, range_cells, running_counts
from ..functions.selectors import LABEL
from ..functions.sqltext import quoted


def confusion_metrics(df: DataFrame, score: str, label: str = LABEL, by: Sequence[str] = (),
                      threshold: float = 0.5) -> DataFrame:
    """Counts, accuracy, precision, recall and F1 for "score above threshold"; 0 where undefined."""
    guess, truth = F.col(score) > threshold, F.col(label) == 1
    counts = df.groupBy(*by).agg(
        F.count_if(guess & truth).alias("tp"), F.count_if(guess & ~truth).alias("fp"),
        F.count_if(~guess & truth).alias("fn"), F.count_if(~guess & ~truth).alias("tn"))

    def share(part, whole):
        return F.coalesce(F.try_divide(F.expr(part).cast("double"), F.expr(whole).cast("double")), F.lit(0.0))
    return counts.select("*", share("tp + tn", "tp + fp + fn + tn").alias("accuracy"),
                         share("tp", "tp + fp").alias("precision"), share("tp", "tp + fn").alias("recall"),
                         share("2 * tp", "2 * tp + fp + fn").alias("f1"))


def roc_auc(df: DataFrame, score: str, label: str = LABEL, by: Sequence[str] = (),
            rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Exact area under the ROC curve, ties counted half; NULL when a class is absent.

    Scores are counted first, so tied scores are one row, then ranked over value ranges of each group's own.
    """
    rows = df.where(F.col(label).isNotNull())
    cells, cuts = grouped_cells(rows, score, by, [label], rows_per_range)
    return areas(running_counts(cells, list(by), {"neg": f"count_if({quoted(label)} <> 1)"},
                                {"pos": f"count_if({quoted(label)} = 1)"}, cuts), by)


def roc_aucs(df: DataFrame, scores: Sequence[str], label: str = LABEL, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """(feature, roc_auc) of several score columns of the same rows."""
    rows = df.where(F.col(label).isNotNull())
    cuts = cut_points(rows, scores, rows_per_range)
    return areas(running_counts(range_cells(rows, scores, [label], cuts), ["feature"], {"neg": f"count_if({quoted(label)} <> 1)"},
                                {"pos": f"count_if({quoted(label)} = 1)"}, cuts), ["feature"])


def areas(ranked: DataFrame, by: Sequence[str]) -> DataFrame:
    wins = F.sum(F.col("pos") * (F.col("neg_before") + F.col("neg") / 2))
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    return ranked.groupBy(*by).agg(F.try_divide(wins, pairs).alias("roc_auc"))


def compare_models(scored: DataFrame, score: str = "probability", label: str = LABEL, model: str = "model",
                   threshold: float = 0.5) -> DataFrame:
    """One row per model: five metrics and the rank by ROC-AUC."""
    confusion = confusion_metrics(scored, score, label, [model], threshold)
    table = confusion.join(roc_auc(scored, score, label, [model]), model)
    return rank_models(table.select(model, "accuracy", "precision", "recall", "f1", "roc_auc"), model)


def rank_models(table: DataFrame, model: str = "model") -> DataFrame:
    """Rank by ROC-AUC, ties by name. One row per model, so the single window partition is tiny."""
    best_first = Window.orderBy(F.col("roc_auc").desc_nulls_last(), model)
    return table.withColumn("rank", F.row_number().over(best_first))


def top_models(table: DataFrame, k: int = 2, model: str = "model") -> DataFrame:
    return table.orderBy(F.col("roc_auc").desc_nulls_last(), model).limit(k)
