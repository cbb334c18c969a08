"""The four model families as Spark ML estimators: fit, tune length, save, load, score.

The boosting libraries of the original are single-machine engines; their families map to
gradient-boosted trees with the same role, depth, rate and sampling. Parameters without a
counterpart (leaf penalties, bagging temperature, random strength) are accepted and unused.
"""

from __future__ import annotations

import json
import math
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.selectors import ID, LABEL
from ..functions.sqltext import number, quoted
from ..session import shared_dir, stage, staged_path, unstage
from .metrics import roc_auc
from .preprocess import Recipe, class_counts, fit_fills, fit_recipe, load_recipe, save_recipe
from .scoring import BANDS, THRESHOLD, decisions, pad_columns
from .stopping import PATIENCE, kept_trees

SEED = 42
#: text columns with fewer texts are categories to the trees
NOMINAL = 10_000
#: budgets up to this many times the first fit are fitted in one go
AT_ONCE = 3
#: rows that a partition of a fit holds at least: the sums of a level (nodes x features x bins) that each partition sends
#: are about as many as the cells of these rows
FIT_ROWS = 8192


@dataclass(frozen=True)
class Family:
    key: str
    name: str
    recipe: str
    balanced: bool          # weights n / (2 n_c); otherwise 1 and negatives / positives
    params: Mapping[str, float]
    rounds: int = 1000      # trees at most; steps of the linear family


# Display names, short keys and baseline parameters.
FAMILIES = {f.key: f for f in (
    Family("sgd", "Elastic Net log reg", "scaled", True, {"l1_ratio": 0.5, "alpha": 1e-4}, 200),
    Family("xgb", "XG Boost Classifier", "onehot", False,
           {"max_depth": 6, "learning_rate": 0.3, "subsample": 1.0, "colsample_bytree": 1.0, "min_child_weight": 1}),
    Family("lgbm", "LightGBM Classifier", "indexed", False,
           {"num_leaves": 31, "max_depth": -1, "learning_rate": 0.05, "subsample": 0.8, "colsample_bytree": 0.8,
            "min_child_samples": 20}),
    Family("catbc", "CatBoost Classifier", "encoded", True, {"depth": 6, "learning_rate": 0.05}),
)}
KEY_OF = {f.name: f.key for f in FAMILIES.values()}


def tree_depth(params: Mapping[str, float]) -> int:
    """Depth limit; a leaf limit counts as the depth of a full tree with that many leaves."""
    limits = [int(params[p]) for p in ("max_depth", "depth") if params.get(p, -1) > 0]
    if params.get("num_leaves"):
        limits.append(math.ceil(math.log2(params["num_leaves"])))
    return max(1, min(limits, default=5))


def estimator(key: str, params: Mapping[str, float], rounds: int, max_bins: int = 64, seed: int = SEED):
    columns = dict(featuresCol="features", labelCol="label", weightCol="weight")
    if key == "sgd":
        return LogisticRegression(elasticNetParam=params["l1_ratio"], regParam=params["alpha"], maxIter=rounds,
                                  standardization=False, **columns)
    share = params.get("colsample_bytree", 1.0)
    at_least = params.get("min_child_samples", params.get("min_child_weight", 1))
    return GBTClassifier(
        maxIter=rounds, maxDepth=tree_depth(params), stepSize=params["learning_rate"],
        subsamplingRate=params.get("subsample", 1.0), featureSubsetStrategy="all" if share >= 1 else str(share),
        minInstancesPerNode=max(1, int(at_least)), maxBins=max_bins, seed=seed, **columns)


@dataclass
class Bundle:
    """A fitted recipe and model with what is needed to score a raw batch."""

    key: str
    recipe: Recipe
    pipeline: PipelineModel
    params: dict
    input_schema: T.StructType
    metadata: dict = field(default_factory=dict)

    def probabilities(self, df: DataFrame, keep=(ID,), is_train=None) -> DataFrame:
        """(keep..., probability); blank columns are added where the batch lacks them."""
        kept = [c for c in keep if c in df.columns]
        fields = [f for f in self.input_schema.fields if f.name not in kept]
        padded = pad_columns(df, T.StructType([df.schema[c] for c in kept] + fields))
        spread_by = kept[0] if kept else self.input_schema.names[0]
        ready = model_input(self.recipe, self.recipe.transform(padded, is_train, spread=False, key=spread_by), kept)
        scored = self.pipeline.transform(ready)
        return scored.select(*kept, vector_to_array("probability")[1].alias("probability"))

    def score(self, batch: DataFrame, threshold: float | None = None, bands=BANDS, keep=(ID,)) -> DataFrame:
        limit = self.metadata.get("threshold", THRESHOLD) if threshold is None else threshold
        return decisions(self.probabilities(batch, keep), "probability", limit, bands)

    def score_one(self, applicants: DataFrame, applicant, key: str = ID) -> DataFrame:
        return self.score(applicants.where(F.col(key) == applicant), keep=(key,))


def model_input(recipe: Recipe, df: DataFrame, keep=()) -> DataFrame:
    """Features under plain names f0, f1, ... (category values may hold any character).

    Codes of a dictionary are marked as categories, their number known beforehand, for the encoder and the trees;
    with more than ``NOMINAL`` texts a column's codes enter the trees as numbers in text order.
    """
    ready = df.selectExpr(*map(quoted, keep), *[f"{quoted(c)} AS f{i}" for i, c in enumerate(recipe.inputs())])
    for c, n in recipe.categories().items():
        if recipe.kind != "indexed" or n < NOMINAL:
            name = f"f{recipe.inputs().index(c)}"
            ready = ready.withMetadata(name, {"ml_attr": {"type": "nominal", "name": name, "num_vals": n + 1}})
    return ready


def _assembly(recipe: Recipe, ready: DataFrame) -> PipelineModel:
    """Vector assembly; of the codes of one-hot recipes sparse vectors are made, which leave the last code out."""
    names, stages = [f"f{i}" for i in range(len(recipe.inputs()))], []
    if recipe.kind in ("scaled", "onehot") and recipe.texts():
        numeric = len(recipe.numeric())
        coded = [f"f{numeric + i}" for i, c in enumerate(recipe.texts()) if recipe.categories()[c]]
        names = names[:numeric]
        if coded:
            spread = [f"h{f}" for f in coded]
            stages.append(OneHotEncoder(inputCols=coded, outputCols=spread, dropLast=True))
            names += spread
    stages.append(VectorAssembler(inputCols=names, outputCol="features"))
    return Pipeline(stages=stages).fit(ready)


@dataclass
class Prepared:
    """One family's training input: fitted recipe and assembly, and the vectors as written tables.

    Every trial of a search fits on the same tables, so preprocessing runs once per family.
    """

    key: str
    recipe: Recipe
    assembly: PipelineModel
    train: DataFrame          # features, label, weight
    val: DataFrame | None
    max_bins: int
    input_schema: T.StructType
    areas: dict[str, float | None] = field(default_factory=dict)    # validation ROC-AUC of the parameter sets fitted so far


def prepare(key: str, train: DataFrame, val: DataFrame | None = None, label: str = LABEL, id_column: str = ID,
            means_path: str | None = None, fills: tuple[dict, dict] | None = None) -> Prepared:
    """Fit the family's recipe on ``train`` and write the feature vectors of both tables.

    ``fills`` are medians and modes fitted before (they are the same for every family).
    """
    family, spark = FAMILIES[key], train.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:   # else the lineage of a boosted fit is as long as its trees are many
        spark.sparkContext.setCheckpointDir(f"{shared_dir(spark)}/lineage")
    recipe = fit_recipe(train, family.recipe, means_path or staged_path(spark, f"{key}-means"), label, id_column, fills=fills)
    counts = class_counts(train, label)
    negatives, positives = counts.get(0, 0), counts.get(1, 0)
    if not negatives or not positives:
        raise ValueError("training rows hold a single class")
    rows = negatives + positives
    weights = (rows / (2 * negatives), rows / (2 * positives)) if family.balanced else (1.0, negatives / positives)
    weight = f"CASE WHEN {quoted(label)} = 1 THEN {number(weights[1])} ELSE {number(weights[0])} END AS weight"

    def ready(df, is_train=None):
        return model_input(recipe, recipe.transform(df, is_train, spread=False, key=id_column), (id_column, label))
    ready_train = ready(train, F.lit(True))
    assembly = _assembly(recipe, ready_train)

    def vectors(df):
        ml = assembly.transform(df).selectExpr("features", f"CAST({quoted(label)} AS DOUBLE) AS label", weight)
        return stage(ml.where("label IS NOT NULL"), f"{key}-vectors")
    outside = {label, id_column, "split", "dataset"}
    return Prepared(
        key, recipe, assembly, vectors(ready_train).coalesce(math.ceil(rows / FIT_ROWS)), None if val is None else vectors(ready(val)),
        max([64, *[n + 1 for n in recipe.categories().values() if n < NOMINAL]]) if recipe.kind == "indexed" else 64,
        T.StructType([f for f in train.schema.fields if f.name not in outside]))


def _boosted(prepared: Prepared, params: Mapping[str, float], rounds: int, patience: int):
    """(model, trees to keep, validation ROC-AUC with these): boosting that ends after ``patience`` trees without gain.

    Trees depend on those before them only, so a longer fit begins with a shorter one's trees: a fit in which
    patience has not run out is made again with twice the trees. A budget of up to AT_ONCE times the first fit is
    fitted at once, which is less than the fits that lead up to it.
    """
    trees = patience + max(1, patience // 4)
    trees = rounds if rounds <= AT_ONCE * trees else trees
    while True:
        model = estimator(prepared.key, params, trees, prepared.max_bins).fit(prepared.train)
        kept, stopped, area = kept_trees(model, prepared.val, patience)
        if stopped or trees == rounds:
            prepared.areas[_fit_name(params, rounds, patience)] = area
            return model, kept, area
        trees = min(rounds, 2 * trees)


def _fit_name(params: Mapping[str, float], rounds: int, patience: int) -> str:
    return json.dumps([dict(params), rounds, patience], sort_keys=True)


def first_trees(model: GBTClassificationModel, n: int) -> GBTClassificationModel:
    """The model that a fit of ``n`` trees gives, without fitting it: trees depend on those before them only."""
    fitted, of = model._java_obj, SparkSession.active()._jvm.org.apache.spark.ml.classification.GBTClassificationModel
    return model._copyValues(GBTClassificationModel(of(model.uid, fitted.trees()[:n], fitted.treeWeights()[:n])))


def _without_summary(spark: SparkSession, model: LogisticRegressionModel) -> LogisticRegressionModel:
    """The model as it is after saving: its training summary holds the session, which tasks can't take along once
    the session has observed a table."""
    path = staged_path(spark, "linear")
    model.write().save(path)
    bare = LogisticRegressionModel.load(path)
    unstage(spark, path)
    return bare


def fit_prepared(prepared: Prepared, params: Mapping[str, float] | None = None, rounds: int | None = None,
                 patience: int = PATIENCE) -> Bundle:
    """Fit one parameter set. With validation vectors a boosted family keeps the trees with the best ROC-AUC there."""
    key = prepared.key
    params, rounds = {**FAMILIES[key].params, **(params or {})}, rounds or FAMILIES[key].rounds
    if prepared.val is not None and key != "sgd":
        model, kept, _ = _boosted(prepared, params, rounds, patience)
        model = first_trees(model, kept) if kept < model.getNumTrees else model
    else:
        model = estimator(key, params, rounds, prepared.max_bins).fit(prepared.train)
        model = _without_summary(prepared.train.sparkSession, model) if key == "sgd" else model
    return Bundle(key, prepared.recipe, PipelineModel(prepared.assembly.stages + [model]), params, prepared.input_schema)


def fitted_rounds(bundle: Bundle) -> int | None:
    """Trees that a boosted model kept."""
    return getattr(bundle.pipeline.stages[-1], "getNumTrees", None)


def fit_family(key: str, train: DataFrame, val: DataFrame | None = None, params: Mapping[str, float] | None = None,
               rounds: int | None = None, label: str = LABEL, id_column: str = ID, patience: int = PATIENCE) -> Bundle:
    return fit_prepared(prepare(key, train, val, label, id_column), params, rounds, patience)


def evaluate_params(prepared: Prepared, params: Mapping[str, float], rounds: int | None = None,
                    patience: int = PATIENCE) -> float | None:
    """Validation ROC-AUC of one parameter set; the evaluation rows are never touched. None where one class is missing."""
    if prepared.key != "sgd":
        params, rounds = {**FAMILIES[prepared.key].params, **params}, rounds or FAMILIES[prepared.key].rounds
        name = _fit_name(params, rounds, patience)
        return prepared.areas[name] if name in prepared.areas else _boosted(prepared, params, rounds, patience)[2]
    model = fit_prepared(prepared, params, rounds).pipeline.stages[-1]
    scored = model.transform(prepared.val).select("label", vector_to_array("probability")[1].alias("probability"))
    spark, path = scored.sparkSession, staged_path(scored.sparkSession, f"{prepared.key}-scored")
    scored.write.parquet(path)
    area = roc_auc(spark.read.parquet(path), "probability", "label").first()["roc_auc"]
    unstage(spark, path)
    return area


def validation_objective(train: DataFrame, val: DataFrame, rounds: int | None = None, label: str = LABEL,
                         patience: int = PATIENCE, prepared: dict[str, Prepared] | None = None):
    """(family key, params) -> validation ROC-AUC; each family is prepared at its first trial.

    ``prepared`` holds families that were prepared on the same rows before; what they have fitted is not fitted again.
    """
    prepared = {} if prepared is None else prepared

    def objective(key: str, params: Mapping[str, float]) -> float | None:
        if key not in prepared:
            prepared[key] = prepare(key, train, val, label)
        return evaluate_params(prepared[key], params, rounds, patience)
    return objective


# --- bundles --------------------------------------------------------------------------------

_METADATA = ("model_name string, model_key string, model_family string, feature_names string, "
             "categorical_features string, trained_rows long, source_data string, threshold double, params string, "
             "baseline_model string, baseline_roc_auc double, input_schema string")


def bundle_metadata(bundle: Bundle, trained_rows: int, source_data: str = "", baseline=(None, None),
                    threshold: float = THRESHOLD) -> dict:
    schema = bundle.input_schema
    return {
        "model_name": FAMILIES[bundle.key].name, "model_key": f"{bundle.key}_full", "model_family": bundle.key,
        "feature_names": json.dumps(schema.names),
        "categorical_features": json.dumps([f.name for f in schema.fields if isinstance(f.dataType, T.StringType)]),
        "trained_rows": trained_rows, "source_data": source_data, "threshold": threshold,
        "params": json.dumps(bundle.params, sort_keys=True), "baseline_model": baseline[0],
        "baseline_roc_auc": baseline[1], "input_schema": schema.json(),
    }


def save_bundle(spark: SparkSession, bundle: Bundle, path: str) -> None:
    """Model, recipe (with its target means or dictionary) and a one-row metadata table under ``path``."""
    recipe = bundle.recipe
    if recipe.means_path and recipe.means_path != f"{path}/target_means":
        spark.read.parquet(recipe.means_path).write.mode("overwrite").parquet(f"{path}/target_means")
        recipe.means_path = f"{path}/target_means"
    if recipe.dictionary and recipe.dictionary.sizes and recipe.dictionary.path != f"{path}/dictionary":
        recipe.dictionary = recipe.dictionary.copied(spark, f"{path}/dictionary")
    save_recipe(spark, recipe, f"{path}/recipe")
    bundle.pipeline.write().overwrite().save(f"{path}/model")
    metadata = bundle.metadata or bundle_metadata(bundle, 0)
    names = [f.name for f in T._parse_datatype_string(_METADATA).fields]
    spark.createDataFrame([tuple(metadata[n] for n in names)], _METADATA).write.mode("overwrite").parquet(f"{path}/metadata")


def load_bundle(spark: SparkSession, path: str) -> Bundle:
    metadata = spark.read.parquet(f"{path}/metadata").first().asDict()
    return Bundle(metadata["model_family"], load_recipe(spark, f"{path}/recipe"), PipelineModel.load(f"{path}/model"),
                  json.loads(metadata["params"]), T.StructType.fromJson(json.loads(metadata["input_schema"])), metadata)


def train_final(df: DataFrame, path: str, params: Mapping[str, float] | None = None, key: str = "catbc",
                rounds: int | None = None, baseline=(None, None), source_data: str = "", label: str = LABEL) -> Bundle:
    """Refit one family on all rows and save it with its metadata."""
    rows = df.where(F.col(label).isNotNull())
    bundle = fit_family(key, rows, None, params, rounds, label=label)
    bundle.metadata = bundle_metadata(bundle, rows.count(), source_data, baseline)
    save_bundle(df.sparkSession, bundle, path)
    return bundle


def train_baselines(split_rows: DataFrame, rounds: int | None = None, label: str = LABEL,
                    folder: str | None = None, patience: int = PATIENCE,
                    prepared: dict[str, Prepared] | None = None) -> tuple[DataFrame, dict[str, Bundle]]:
    """Fit the four families on train (length chosen on val) and score the evaluation split.

    Returns (applicant, label, model, probability) rows and the bundles; with ``folder`` the
    bundles are saved there by key. ``prepared`` gets the families' training input, for a search on the same rows.
    """
    prepared = {} if prepared is None else prepared
    spark = split_rows.sparkSession
    train, val, held = (split_rows.where(F.col("split") == s).drop("split") for s in ("train", "val", "eval"))
    trained, fills = train.count(), fit_fills(train, label)

    def fitted(key):
        prepared[key] = prepare(key, train, val, label, fills=fills)
        bundle = fit_prepared(prepared[key], None, rounds, patience)
        bundle.metadata = bundle_metadata(bundle, trained)
        if folder:
            save_bundle(spark, bundle, f"{folder}/{key}")
        return bundle, stage(bundle.probabilities(held, keep=(ID, label)), f"{key}-scored").withColumn("model", F.lit(FAMILIES[key].name))

    # a fit is many short jobs one after the other: those of one family run in the gaps of another's
    with ThreadPoolExecutor(len(FAMILIES)) as pool:
        done = dict(zip(FAMILIES, pool.map(inheritable_thread_target(spark)(fitted), FAMILIES)))
    scored = reduce(DataFrame.unionByName, [one for _, one in done.values()])
    return scored, {key: bundle for key, (bundle, _) in done.items()}
