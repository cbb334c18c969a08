"""Imputing, scaling and encoding: fitted on train, applied to any rows.

Fitted numbers (a few per column) become literals; the texts of a column stay in a table, see ``dictionary``.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.quantiles import quantiles
from ..functions.selectors import ID, LABEL, numeric_columns, string_columns
from ..functions.sqltext import number, quoted, text
from ..session import stage
from .dictionary import Dictionary, encode, fit_dictionary, text_cells
from .split import split_hash

SCALE_RANGE = (0.0025, 0.0075)   # as the original scales: 0.25 to 0.75 percent; quartiles are (0.25, 0.75)


# --- fitting --------------------------------------------------------------------------------

def fit_medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    return {c: v[0] for (_, c), v in quantiles(df, columns, (0.5,)).items()}


def fit_modes(df: DataFrame, columns: Sequence[str]) -> dict[str, str | None]:
    """Most frequent text per column, the smallest of tied ones."""
    if not columns:
        return {}
    counts = text_cells(df, columns).groupBy("feature", "value").agg(F.count("*").alias("n"))
    best = counts.groupBy("feature").agg(F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("mode"))
    found = {r["feature"]: r["mode"] for r in best.collect()}
    return {c: found.get(c) for c in columns}


def fit_scales(df: DataFrame, columns: Sequence[str], span=SCALE_RANGE) -> dict[str, tuple[float, float]]:
    """{column: (median, gap between the two quantiles)}; a gap of nothing scales by 1."""
    points = quantiles(df, columns, (0.5, *span))
    scales = {}
    for (_, c), (middle, low, high) in points.items():
        if middle is not None:
            gap = high - low
            scales[c] = (middle, 1.0 if abs(gap) < 10 * sys.float_info.epsilon else gap)
    return scales


def fit_vocabularies(df: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """Sorted distinct texts per column, on the driver: for encoders that make one column of each text."""
    return fit_dictionary(df, columns).values(df.sparkSession, columns)


# --- applying -------------------------------------------------------------------------------

def replace_columns(df: DataFrame, new: dict[str, str], drop: Sequence[str] = ()) -> DataFrame:
    """One projection with some columns given by SQL text, instead of a chain of withColumn."""
    dropped = set(drop)
    return df.selectExpr(*[f"{new[c]} AS {quoted(c)}" if c in new else quoted(c)
                           for c in df.columns if c not in dropped])


def impute_median(df: DataFrame, medians: dict[str, float | None]) -> DataFrame:
    """Fill numeric gaps; columns without any train value are dropped."""
    fills = {c: f"coalesce(CAST({quoted(c)} AS DOUBLE), {number(m)})" for c, m in medians.items() if m is not None}
    return replace_columns(df, fills, [c for c, m in medians.items() if m is None])


def impute_mode(df: DataFrame, modes: dict[str, str | None]) -> DataFrame:
    fills = {c: f"coalesce({quoted(c)}, {text(m)})" for c, m in modes.items() if m is not None}
    return replace_columns(df, fills, [c for c, m in modes.items() if m is None])


def robust_scale(df: DataFrame, scales: dict[str, tuple[float, float]]) -> DataFrame:
    return replace_columns(df, {c: f"({quoted(c)} - {number(m)}) / {number(g)}" for c, (m, g) in scales.items()})


def one_hot(df: DataFrame, vocabularies: dict[str, list[str]], drop_first: bool = False) -> DataFrame:
    """Replace each text column by one 0/1 column per category; an unknown text gives all 0."""
    kept = [quoted(c) for c in df.columns if c not in vocabularies]
    flags = [f"coalesce(CAST({quoted(c)} = {text(v)} AS INT), 0) AS {quoted(f'{c}_{v}')}"
             for c, values in vocabularies.items() for v in values[1 if drop_first else 0:]]
    return df.selectExpr(*kept, *flags)


def category_codes(df: DataFrame, dictionary: Dictionary, columns: Sequence[str], key: str = ID) -> DataFrame:
    """Replace texts by their place among the train texts; an unseen text becomes NULL."""
    return encode(df, dictionary, columns, key)


def indicator_codes(df: DataFrame, dictionary: Dictionary, columns: Sequence[str], drop_first: bool, key: str = ID) -> DataFrame:
    """``category_codes`` as doubles without gaps: what has no indicator of its own (NULL, an unseen text and, with
    ``drop_first``, the first text) has the code behind all others."""
    coded, skip = category_codes(df, dictionary, columns, key), int(drop_first)

    def shown(c):
        n = dictionary.sizes[c] - skip
        return f"CAST(CASE WHEN {quoted(c)} >= {skip} THEN {quoted(c)} - {skip} ELSE {n} END AS DOUBLE)"
    return replace_columns(coded, {c: shown(c) for c in columns})


def fold_of(key: str, folds: int, seed: int = 42) -> Column:
    return (F.conv(F.substring(split_hash(key, seed), 1, 7), 16, 10).cast("long") % folds).cast("int")


def fit_target_means(train: DataFrame, columns: Sequence[str], key: str = ID, label: str = LABEL,
                     folds: int = 5) -> DataFrame:
    """(feature, value, fold, total, n): label sums per category and fold, of the train rows."""
    rows = train.where(F.col(label).isNotNull()).withColumn("fold", fold_of(key, folds))
    cells = text_cells(rows, columns, [label, "fold"])
    return cells.groupBy("feature", "value", "fold").agg(F.sum(label).alias("total"), F.count("*").alias("n"))


def target_encode(df: DataFrame, means: DataFrame, columns: Sequence[str], prior: float, is_train: Column | None = None,
                  key: str = ID, folds: int = 5, smoothing: float = 0.0) -> DataFrame:
    """Replace texts by the smoothed label mean of their category.

    Rows that were fitted on (``is_train``) take the mean of the other folds, so a row's own
    label never enters its encoding. No evidence gives the prior.
    """
    encoded = df.withColumn("_fold", F.when(is_train, fold_of(key, folds)) if is_train is not None
                            else F.lit(None).cast("int"))
    # written first: Spark then knows its size, and adaptive execution can split a hot category of a big one
    means = stage(means, "target-means")
    for c in columns:
        by_fold = F.map_from_entries(F.collect_list(F.struct("fold", F.struct("total", "n"))))   # <= folds entries
        stats = means.where(F.col("feature") == c).groupBy(F.col("value").alias(c)).agg(
            F.sum("total").alias("_total"), F.sum("n").alias("_n"), by_fold.alias("_folds"))
        own = "try_element_at(_folds, _fold)"
        mean = (f"try_divide(_total - coalesce({own}.total, 0) + {number(smoothing * prior)}, "
                f"_n - coalesce({own}.n, 0) + {number(smoothing)})")
        joined = encoded.join(stats, c, "left")
        encoded = replace_columns(joined, {c: f"coalesce({mean}, {number(prior)})"}, ["_total", "_n", "_folds"])
    return encoded.drop("_fold")


def class_counts(df: DataFrame, label: str = LABEL) -> dict:
    rows = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n")).collect()
    return {r[label]: r["n"] for r in rows}


def class_weights(df: DataFrame, label: str = LABEL) -> DataFrame:
    """(label, n, weight): balanced weights, rows / (classes * rows of the class)."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n"))
    everything = Window.partitionBy(F.lit(0))   # over one row per class
    return counts.select(label, "n", (
        F.sum("n").over(everything) / (F.count("*").over(everything) * F.col("n"))).alias("weight"))


# --- recipes --------------------------------------------------------------------------------

RECIPES = ("scaled", "onehot", "indexed", "encoded")


@dataclass
class Recipe:
    """Fitted preprocessing of one kind.

    scaled: median, robust scale, mode, one-hot without the first category
    onehot: median, mode, one-hot
    indexed: median, mode, texts replaced by their place in a frozen train dictionary
    encoded: median, mode, texts replaced by target means
    """

    kind: str
    medians: dict[str, float | None]
    modes: dict[str, str | None]
    scales: dict[str, tuple[float, float]] = field(default_factory=dict)
    dictionary: Dictionary | None = None
    prior: float = 0.0
    means_path: str | None = None

    def numeric(self) -> list[str]:
        return [c for c, m in self.medians.items() if m is not None]

    def texts(self) -> list[str]:
        return [c for c, m in self.modes.items() if m is not None]

    def drop_first(self) -> bool:
        return self.kind == "scaled"

    def categories(self) -> dict[str, int]:
        """How many codes each text column has, without the one for all other texts."""
        if self.dictionary is None:
            return {}
        return {c: self.dictionary.sizes[c] - int(self.drop_first()) for c in self.texts()}

    def features(self, spark: SparkSession) -> list[str]:
        """Columns that ``transform`` gives; text columns, or the columns made of them, last."""
        if self.kind in ("scaled", "onehot"):
            values = self.dictionary.values(spark, self.texts())
            return self.numeric() + [f"{c}_{v}" for c in self.texts() for v in values[c][int(self.drop_first()):]]
        return self.inputs()

    def inputs(self) -> list[str]:
        """Columns that ``transform`` leaves when texts are not spread over columns."""
        return self.numeric() + self.texts()

    def transform(self, df: DataFrame, is_train: Column | None = None, spread: bool = True, key: str = ID) -> DataFrame:
        """Apply the recipe; with ``spread`` false the one-hot kinds give ``indicator_codes``, for sparse vectors."""
        spark = df.sparkSession
        df = impute_mode(impute_median(df, self.medians), self.modes)
        if self.kind == "scaled":
            df = robust_scale(df, self.scales)
        if not self.texts():
            return df
        if self.kind == "encoded":
            return target_encode(df, spark.read.parquet(self.means_path), self.texts(), self.prior, is_train)
        if not spread:
            return indicator_codes(df, self.dictionary, self.texts(), self.drop_first(), key)
        if self.kind == "indexed":
            return category_codes(df, self.dictionary, self.texts(), key)
        return one_hot(df, self.dictionary.values(spark, self.texts()), self.drop_first())

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> "Recipe":
        raw = json.loads(text)
        raw["scales"] = {c: tuple(v) for c, v in raw["scales"].items()}
        raw["dictionary"] = raw["dictionary"] and Dictionary(**raw["dictionary"])
        return Recipe(**raw)


def fit_fills(train: DataFrame, label: str = LABEL, key: str = ID) -> tuple[dict, dict]:
    """Medians of the numeric and modes of the text features."""
    outside = (label, key, "split", "dataset")
    return (fit_medians(train, numeric_columns(train, outside)), fit_modes(train, string_columns(train, outside)))


def fit_recipe(train: DataFrame, kind: str, means_path: str | None = None, label: str = LABEL, key: str = ID,
               span=SCALE_RANGE, fills: tuple[dict, dict] | None = None) -> Recipe:
    """Fit one of the four recipes on the train rows; ``means_path`` is where target means go."""
    if kind not in RECIPES:
        raise ValueError(f"unknown recipe {kind}")
    recipe = Recipe(kind, *(fills or fit_fills(train, label, key)))
    if kind == "scaled":
        recipe.scales = fit_scales(impute_median(train, recipe.medians), recipe.numeric(), span)
    if kind in ("scaled", "onehot", "indexed"):
        recipe.dictionary = fit_dictionary(impute_mode(train, recipe.modes), recipe.texts())
    if kind == "encoded" and recipe.texts():
        if not means_path:
            raise ValueError("target means need a path to be kept at")
        filled = impute_mode(train, recipe.modes)
        fit_target_means(filled, recipe.texts(), key, label).write.mode("overwrite").parquet(means_path)
        recipe.prior = float(train.agg(F.avg(label)).first()[0])
        recipe.means_path = means_path
    return recipe


def save_recipe(spark: SparkSession, recipe: Recipe, path: str) -> None:
    spark.createDataFrame([(recipe.kind, recipe.to_json())], "kind string, fitted string").write.mode(
        "overwrite").parquet(path)


def load_recipe(spark: SparkSession, path: str) -> Recipe:
    return Recipe.from_json(spark.read.parquet(path).first()["fitted"])
