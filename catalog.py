"""The registered queries: each takes (spark, folder of test tables) and gives a DataFrame."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions import selectors
from riskloom.functions.selectors import LABEL, numeric_columns, string_columns
from riskloom.functions.sqltext import quoted
from riskloom.operators import (
    application, bureau, checks, cleaning, correlation, credit_card, dictionary, installments, metrics, models, pos_cash,
    preprocess, previous, profiling, scoring, search)
from riskloom.operators import assemble as asm
from riskloom.operators import split as splitting
from riskloom.plans import build_dataset, clean_dataset
from riskloom.plans.score_batch import read_batch
from riskloom.session import stage, staged_path
from riskloom.sources import bindings, readers, schemas, writers
from riskloom.streaming import arrivals

QUERIES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def comparable(df: DataFrame) -> DataFrame:
    """Whole numbers as bigint; doubles at single precision, so that sums taken in
    another order compare equal. Only for comparing; the operators keep full doubles."""
    def shown(f):
        c = quoted(f.name)
        if isinstance(f.dataType, T.IntegralType):
            return f"CAST({c} AS BIGINT) AS {c}"
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            return f"CAST(CAST({c} AS FLOAT) AS DOUBLE) AS {c}"
        return c
    return df.selectExpr(*[shown(f) for f in df.schema.fields])


# --- feature roll-ups ---------------------------------------------------------------------

@query
def status_map(spark: SparkSession, folder: str) -> DataFrame:
    balance = bindings.bound(spark, folder, "bureau_balance")
    return comparable(balance.select("SK_ID_BUREAU", "STATUS", bureau.status_number().alias("STATUS_NUM")))


@query
def bureau_balance_rollup(spark, folder):
    return comparable(bureau.balance_by_loan(bindings.bound(spark, folder, "bureau_balance")))


@query
def bureau_features(spark, folder):
    return comparable(bureau.bureau_features(
        bindings.bound(spark, folder, "bureau"), bindings.bound(spark, folder, "bureau_balance")))


@query
def previous_features(spark, folder):
    return comparable(previous.previous_features(bindings.bound(spark, folder, "previous_application")))


@query
def installment_features(spark, folder):
    return comparable(installments.installment_features(bindings.bound(spark, folder, "installments_payments")))


@query
def credit_card_features(spark, folder):
    return comparable(credit_card.credit_card_features(bindings.bound(spark, folder, "credit_card_balance")))


@query
def pos_features(spark, folder):
    return comparable(pos_cash.pos_features(bindings.bound(spark, folder, "POS_CASH_balance")))


@query
def application_features(spark, folder):
    return comparable(application.application_features(bindings.bound(spark, folder, "application")))


@query
def assembled_dataset(spark, folder):
    return comparable(asm.build(bindings.load(spark, folder)))


@query
def cleaned_dataset(spark, folder):
    return comparable(cleaning.clean(asm.build(bindings.load(spark, folder))))


@query
def train_test_dataset(spark, folder):
    """Train and test applicants (customers, suppliers) joined to the same features at once."""
    return comparable(asm.build(_train_test_sources(spark, folder)))


def _train_test_sources(spark, folder):
    sources = bindings.load(spark, folder)
    sources["application_train"] = sources.pop("application")
    suppliers = bindings.table(spark, folder, "supplier").selectExpr(
        "s_suppkey AS c_custkey", "s_acctbal AS c_acctbal", "CAST(NULL AS STRING) AS c_mktsegment",
        "s_nationkey AS c_nationkey")
    sources["application_test"] = bindings.application(suppliers).drop(LABEL)
    return sources


def built(spark, folder, clean=False):
    """Feature table for a report of one pass. Doubles are kept at single precision: ranks
    and distinct values then do not hang on the last bit of a sum."""
    df = asm.build(bindings.load(spark, folder))
    return comparable(cleaning.clean(df) if clean else df)


def assembled(spark, folder):
    """The same, written once for a report of several passes."""
    return stage(built(spark, folder), "assembled")


def cleaned(spark, folder):
    return stage(built(spark, folder, clean=True), "cleaned")


# --- scans and sinks ----------------------------------------------------------------------

@query
def scan_normalize_missing(spark, folder):
    k = "CAST(regexp_extract(props, '([0-9]+)', 1) AS INT)"
    raw = bindings.table(spark, folder, "events").selectExpr(
        "event_id", f"CASE {k} % 6 WHEN 0 THEN 'NA' WHEN 1 THEN 'null' WHEN 2 THEN 'XNA' WHEN 3 THEN '' "
                    f"WHEN 4 THEN 'n/a' ELSE event_type END AS kind",
        f"CASE WHEN {k} % 7 = 0 THEN DOUBLE('NaN') ELSE value END AS value")
    return comparable(readers.normalize_missing(raw))


@query
def csv_round_trip(spark, folder):
    """Features with infinities and gaps survive a CSV file."""
    features = installments.installment_features(bindings.bound(spark, folder, "installments_payments"))
    path = staged_path(spark, "features") + ".csv"
    writers.write_dataset(features, path, "csv")
    return comparable(readers.read_table(spark, path, features.schema))


@query
def csv_sources_dataset(spark, folder):
    """The eight raw tables as CSV, read with their schemas and built."""
    sources = _train_test_sources(spark, folder)
    base = staged_path(spark, "raw")
    for name, df in sources.items():
        writers.write_dataset(df, f"{base}/{name}.csv", "csv")
    return comparable(asm.build(readers.load_sources(spark, base)))


def _built_by_job(spark, folder):
    """The eight raw tables as CSV, built by the job; the folder it wrote."""
    raw, out = staged_path(spark, "job-raw"), staged_path(spark, "job-built")
    for name, df in _train_test_sources(spark, folder).items():
        writers.write_dataset(df, f"{raw}/{name}.csv", "csv")
    build_dataset.run(spark, raw, out)
    return out


@query
def cleaned_by_jobs(spark, folder):
    """Train rows that the build job wrote, cleaned and written by the next job."""
    out = staged_path(spark, "job-cleaned")
    clean_dataset.run(spark, _built_by_job(spark, folder), out)
    return comparable(spark.read.parquet(f"{out}/final_train_cleaned"))


@query
def job_feature_names(spark, folder):
    """The lists of column names that the build job wrote beside its two datasets."""
    out = _built_by_job(spark, folder)
    names = [spark.read.schema(writers.NAMES_SCHEMA).option("header", True).csv(f"{out}/final_{d}_feature_names").withColumn(
        "dataset", F.lit(d)) for d in ("train", "test")]
    return comparable(names[0].unionByName(names[1]))


@query
def first_rows(spark, folder):
    return comparable(profiling.head(bindings.bound(spark, folder, "application"), "SK_ID_CURR"))


# --- reports --------------------------------------------------------------------------------

@query
def table_info(spark, folder):
    return comparable(profiling.table_info(built(spark, folder)))


@query
def column_info(spark, folder):
    return comparable(profiling.column_info(built(spark, folder)))


@query
def name_rules(spark, folder):
    """Which of the name rules hold for each column of the feature table, beside what its type says."""
    names = built(spark, folder).columns
    rules = {"is_id": selectors.id_columns, "is_days": selectors.day_columns, "is_month": selectors.month_columns,
             "is_ratio": selectors.ratio_columns, "is_count": selectors.count_columns}
    held = {rule: set(of(names)) for rule, of in rules.items()}
    return spark.createDataFrame([(c, *[c in held[r] for r in rules]) for c in names],
                                 "feature string, " + ", ".join(f"{r} boolean" for r in rules))


@query
def missing_report(spark, folder):
    return comparable(profiling.missing_report(built(spark, folder)))


@query
def describe_numeric(spark, folder):
    return comparable(profiling.describe(assembled(spark, folder)))


@query
def infinity_report(spark, folder):
    return comparable(profiling.infinity_report(built(spark, folder)))


@query
def feature_summary(spark, folder):
    typed = bindings.bound(spark, folder, "application").selectExpr(
        "*", "CASE WHEN SK_ID_CURR % 4 > 0 THEN IF(SK_ID_CURR % 4 = 1, 'True', 'False') END AS WRITTEN_FLAG",
        "SK_ID_CURR % 2 = 0 AS REAL_FLAG")
    return comparable(profiling.feature_summary(typed))


@query
def label_distribution(spark, folder):
    return comparable(profiling.label_distribution(bindings.bound(spark, folder, "application")))


@query
def class_weights(spark, folder):
    return comparable(preprocess.class_weights(bindings.bound(spark, folder, "application")))


@query
def duplicate_report(spark, folder):
    return comparable(profiling.duplicate_report(bindings.bound(spark, folder, "bureau_balance")))


@query
def drop_duplicates(spark, folder):
    return comparable(profiling.drop_duplicates(bindings.bound(spark, folder, "bureau_balance")))


@query
def near_constant(spark, folder):
    return comparable(profiling.near_constant(assembled(spark, folder)))


@query
def near_constant_80(spark, folder):
    return comparable(profiling.near_constant(assembled(spark, folder), share=0.80))


@query
def drop_near_constant(spark, folder):
    """Found on train, dropped from train and test alike."""
    built = stage(comparable(asm.build(_train_test_sources(spark, folder))), "built")
    train = built.where("dataset = 'train'").drop("dataset")
    kept = built.drop(*profiling.near_constant_columns(train, 0.85))
    return comparable(profiling.column_info(kept).select("feature", "non_null"))


@query
def skew_topk(spark, folder):
    return comparable(profiling.skew_report(built(spark, folder, clean=True), 20))


@query
def column_report(spark, folder):
    return comparable(profiling.column_report(cleaned(spark, folder)))


@query
def iqr_bounds(spark, folder):
    return comparable(profiling.iqr_report(cleaned(spark, folder)))


@query
def columns_to_clip(spark, folder):
    chosen = profiling.columns_to_clip(cleaned(spark, folder))
    return spark.createDataFrame([(c,) for c in chosen], "feature string")


@query
def clip_to_iqr(spark, folder):
    """Bounds of the train rows applied to train and test."""
    built = stage(comparable(cleaning.clean(asm.build(_train_test_sources(spark, folder)))), "built")
    train = built.where("dataset = 'train'").drop("dataset")
    chosen = profiling.columns_to_clip(train)
    clipped = profiling.clip_to_bounds(built, profiling.fit_iqr_bounds(train, chosen), chosen)
    doubles = {c: f"CAST({c} AS DOUBLE)" for c in numeric_columns(clipped, exclude=(LABEL, "SK_ID_CURR"))}
    return comparable(preprocess.replace_columns(clipped, doubles))


@query
def spearman_target(spark, folder):
    return comparable(correlation.spearman_with_label(cleaned(spark, folder)))


def _heatmap_columns(df):
    top = correlation.top_correlated(correlation.spearman_with_label(df), 30)
    return [r["feature"] for r in top.collect()]


@query
def top_correlated(spark, folder):
    return comparable(correlation.top_correlated(correlation.spearman_with_label(cleaned(spark, folder)), 30))


@query
def spearman_matrix(spark, folder):
    df = cleaned(spark, folder)
    return comparable(correlation.spearman_matrix(df, [*_heatmap_columns(df), LABEL]))


@query
def box_stats(spark, folder):
    df = cleaned(spark, folder)
    return comparable(profiling.box_stats(df, _heatmap_columns(df)[:20]))


# --- checks -----------------------------------------------------------------------------------

@query
def check_keys_unique(spark, folder):
    t = bindings.load(spark, folder)
    tables = {"application": t["application"], **dict(asm.feature_tables(t)), "raw_balance":
              t["bureau_balance"].withColumnRenamed("SK_ID_BUREAU", "SK_ID_CURR")}
    return comparable(checks.key_report(tables, "SK_ID_CURR"))


@query
def check_row_counts(spark, folder):
    t = bindings.load(spark, folder)
    return comparable(checks.row_counts({"application": t["application"], "assembled": asm.build(t)}))


@query
def observed_assembly(spark, folder):
    """Rows and keys of both sides of every join and of the result, counted by the job that writes the table."""
    watched = {}
    asm.build(bindings.load(spark, folder), watched=watched).write.parquet(staged_path(spark, "observed"))
    return checks.watched_report(spark, watched).select("place", "row_count", "key_rows", F.col("key_sum").cast("long").alias("key_sum"))


@query
def bucketed_assembly(spark, folder):
    """Applications and feature tables kept in buckets of applicants; joined from there without a shuffle."""
    t = bindings.load(spark, folder)
    buckets, base = int(spark.conf.get("spark.sql.shuffle.partitions")), staged_path(spark, "bucketed")
    tables = {"application": application.application_features(t["application"]), **dict(asm.feature_tables(t))}
    for name, df in tables.items():
        writers.write_bucketed(df, f"{base}/{name}", "SK_ID_CURR", buckets)
    first, *others = (writers.read_bucketed(spark, f"{base}/{name}") for name in tables)
    return comparable(asm.assemble(first, [(n, df.hint("merge")) for n, df in zip(list(tables)[1:], others)]))


# --- split and preprocessing --------------------------------------------------------------------

def split_rows(spark, folder):
    return splitting.stratified_split(cleaned(spark, folder))


@query
def stratified_split(spark, folder):
    rows = splitting.stratified_split(bindings.bound(spark, folder, "application"))
    return comparable(rows.select("SK_ID_CURR", LABEL, "split"))


@query
def stratified_split_sizes(spark, folder):
    rows = splitting.stratified_split(bindings.bound(spark, folder, "application"))
    return comparable(rows.groupBy(LABEL, "split").agg(F.count("*").alias("n")))


@query
def split_round_trip(spark, folder):
    path = staged_path(spark, "split")
    rows = splitting.stratified_split(bindings.bound(spark, folder, "application"))
    writers.write_split(rows, path)
    return comparable(writers.read_split(spark, path, "val", schema=rows.schema).drop("split"))


@query
def split_repeated_ids(spark, folder):
    """Loans split so that all loans of an applicant are on one side; some applicants have loans of both labels."""
    label = "CAST(SK_ID_CURR % 9 = 0 OR SK_ID_BUREAU % 501 = 0 AS INT) AS TARGET"
    loans = bindings.bound(spark, folder, "bureau").selectExpr("SK_ID_BUREAU", "SK_ID_CURR", label)
    return comparable(splitting.stratified_split_by_id(loans))


def _fit_rows(spark, folder):
    rows = split_rows(spark, folder)
    return rows, rows.where("split = 'train'")


@query
def impute_median(spark, folder):
    rows, train = _fit_rows(spark, folder)
    columns = numeric_columns(rows, exclude=(LABEL, "SK_ID_CURR"))
    return comparable(preprocess.impute_median(rows, preprocess.fit_medians(train, columns)))


@query
def impute_mode(spark, folder):
    rows, train = _fit_rows(spark, folder)
    texts = string_columns(rows, exclude=("split",))
    return comparable(preprocess.impute_mode(rows.select("SK_ID_CURR", *texts), preprocess.fit_modes(train, texts)))


@query
def robust_scale(spark, folder):
    rows, train = _fit_rows(spark, folder)
    columns = numeric_columns(rows, exclude=(LABEL, "SK_ID_CURR"))
    medians = preprocess.fit_medians(train, columns)
    filled = preprocess.impute_median(rows, medians)
    scales = preprocess.fit_scales(preprocess.impute_median(train, medians), [c for c in columns if medians[c] is not None])
    return comparable(preprocess.robust_scale(filled, scales).drop(*string_columns(filled)))


def _filled_texts(spark, folder):
    rows = splitting.stratified_split(bindings.bound(spark, folder, "application"))
    train = rows.where("split = 'train'")
    texts = string_columns(rows, exclude=("split",))
    filled = preprocess.impute_mode(rows, preprocess.fit_modes(train, texts))
    return filled.select("SK_ID_CURR", LABEL, "split", *texts), texts


@query
def one_hot_drop_first(spark, folder):
    filled, texts = _filled_texts(spark, folder)
    vocabularies = preprocess.fit_vocabularies(filled.where("split = 'train'"), texts)
    return comparable(preprocess.one_hot(filled, vocabularies, drop_first=True).drop("split", LABEL))


@query
def one_hot_full(spark, folder):
    filled, texts = _filled_texts(spark, folder)
    vocabularies = preprocess.fit_vocabularies(filled.where("split = 'train'"), texts)
    return comparable(preprocess.one_hot(filled, vocabularies).drop("split", LABEL))


@query
def frozen_vocab(spark, folder):
    """Dictionary of the train split; a text seen only elsewhere becomes NULL."""
    filled, texts = _filled_texts(spark, folder)
    fitted = dictionary.fit_dictionary(filled.where("split = 'train'"), texts)
    return comparable(preprocess.category_codes(filled, fitted, texts).drop("split", LABEL))


@query
def target_encode(spark, folder):
    filled, texts = _filled_texts(spark, folder)
    train = filled.where("split = 'train'")
    means = preprocess.fit_target_means(train, texts)
    prior = train.agg(F.avg(LABEL)).first()[0]
    encoded = preprocess.target_encode(filled, means, texts, prior, is_train=F.col("split") == "train")
    return comparable(encoded.drop("split", LABEL))


# --- metrics and scoring --------------------------------------------------------------------------

#: trials per family of the registered search; a real search makes search.N_TRIALS
SEARCH_TRIALS = 3

MODEL_SCORES = {
    "Elastic Net log reg": "o_totalprice / 500000D",
    "XG Boost Classifier": "CAST(o_orderkey % 101 AS DOUBLE) / 100",
    "LightGBM Classifier": "greatest(0D, least(1D, (datediff(o_orderdate, DATE'1995-01-01')) / 2400D))",
    "CatBoost Classifier": "CASE WHEN o_orderkey % 5 = 0 THEN o_totalprice / 500000D "
                           "ELSE (datediff(DATE'2001-12-31', o_orderdate)) / 2600D END",
}


def _scored(spark, folder, models=MODEL_SCORES):
    """Orders as scored applicants: label = finished order, one probability per model."""
    orders = bindings.table(spark, folder, "orders")
    by_model = F.array(*[F.struct(F.lit(m).alias("model"), F.expr(e).alias("probability"))
                         for m, e in MODEL_SCORES.items() if m in models])
    return (orders.select(F.col("o_orderkey").alias("SK_ID_CURR"), (F.col("o_orderstatus") == "F").cast("int").alias(LABEL),
                          F.explode(by_model).alias("s")).select("SK_ID_CURR", LABEL, "s.*"))


@query
def confusion_metrics(spark, folder):
    return comparable(metrics.confusion_metrics(_scored(spark, folder), "probability", by=["model"]))


@query
def roc_auc(spark, folder):
    return comparable(metrics.roc_auc(_scored(spark, folder, ["XG Boost Classifier"]), "probability"))


@query
def model_comparison(spark, folder):
    return comparable(metrics.compare_models(_scored(spark, folder)))


@query
def top2_models(spark, folder):
    return comparable(metrics.top_models(metrics.compare_models(_scored(spark, folder)), 2).select("model", "roc_auc"))


@query
def pad_missing_columns(spark, folder):
    batch = bindings.bound(spark, folder, "application").drop(LABEL, "AMT_CREDIT")
    return comparable(scoring.pad_columns(batch, schemas.APPLICATION_TEST))


@query
def threshold_decision(spark, folder):
    return comparable(scoring.decisions(_scored(spark, folder)))


@query
def search_summary(spark, folder):
    """Orders read as trials: priority = family, order = trial, price share = validation AUC."""
    trials = bindings.table(spark, folder, "orders").selectExpr(
        "o_orderpriority AS family", "CAST(o_orderkey AS INT) AS trial",
        "concat('{\"status\": \"', o_orderstatus, '\"}') AS params", "round(o_totalprice / 500000D, 2) AS val_roc_auc")
    return comparable(search.search_summary(trials))


@query
def scored_arrivals(spark, folder):
    """Scored orders that come as two files; each run takes the file that is new."""
    base = staged_path(spark, "arrivals")
    rows = _scored(spark, folder, ["CatBoost Classifier"]).drop("model")
    for half in (0, 1):
        writers.write_dataset(rows.where(f"SK_ID_CURR % 2 = {half}"), f"{base}/in", mode="append")
        arrivals.score_arrivals(spark, scoring.decisions, f"{base}/in", rows.schema, f"{base}/out", f"{base}/state", "parquet")
    return comparable(spark.read.parquet(f"{base}/out"))


# --- models: fitted on the whole tables; the columns are those that every fit must meet. The label follows from the
# --- income here, so a real fit ranks far better than FLOOR.

FLOOR = 0.85
#: trees at most and rounds without gain in ``random_search``; all other fits take the families' 1000 and 250
SEARCH_BUDGET = {"rounds": 24, "patience": 8}


def _split(spark, folder):
    return stage(split_rows(spark, folder), "split")


def _comparison(rows, prepared):
    return stage(metrics.compare_models(models.train_baselines(rows, prepared=prepared, **SEARCH_BUDGET)[0]), "comparison")


def _bundle(spark, folder):
    """A final model: as many trees as did best on the validation split, fitted on all rows."""
    path, rows = staged_path(spark, "bundle"), _split(spark, folder)
    part = {s: rows.where(F.col("split") == s).drop("split") for s in ("train", "val")}
    trees = models.fitted_rounds(models.fit_family("catbc", part["train"], part["val"]))
    models.train_final(rows.drop("split"), path, rounds=trees, source_data="customer")
    return path


def _recounted(scored):
    """The metrics of ``compare_models`` from stored probabilities, by plain sums; the rows and positives they rest on."""
    guess, truth = "probability > 0.5", f"{LABEL} = 1"
    hits = f"count_if({guess} AND {truth})"
    sums = scored.groupBy("model").agg(
        F.count("*").alias("scored_rows"), F.expr(f"count_if({truth})").alias("positives"),
        F.expr(f"avg(CAST(({guess}) = ({truth}) AS DOUBLE))").alias("accuracy_again"),
        F.expr(f"coalesce(try_divide({hits}, count_if({guess})), 0)").alias("precision_again"),
        F.expr(f"coalesce(try_divide({hits}, count_if({truth})), 0)").alias("recall_again"))
    return sums.join(metrics.roc_auc(scored, "probability", by=["model"]).withColumnRenamed("roc_auc", "roc_auc_again"), "model").withColumn(
        "f1_again", F.expr("coalesce(try_divide(2 * precision_again * recall_again, precision_again + recall_again), 0)"))


@query
def train_baselines(spark, folder):
    """Four families on the train split, saved. The stored comparison must be what the saved models, loaded again, give on
    the evaluation split."""
    rows, saved = _split(spark, folder), staged_path(spark, "baselines")
    kept = ("accuracy", "precision", "recall", "f1", "roc_auc")
    valid = " AND ".join(f"coalesce({m}, 0) BETWEEN 0 AND 1" for m in kept)
    holds = " AND ".join(f"abs({m} - {m}_again) < 1e-9" for m in kept)
    ranked = "rank = row_number() OVER (ORDER BY roc_auc_again DESC, model)"      # four rows
    table = stage(metrics.compare_models(models.train_baselines(rows, folder=saved)[0]), "comparison")
    held, scored = rows.where("split = 'eval'").drop("split"), None
    for key, family in models.FAMILIES.items():
        one = models.load_bundle(spark, f"{saved}/{key}").probabilities(held, keep=("SK_ID_CURR", LABEL)).withColumn("model", F.lit(family.name))
        scored = one if scored is None else scored.unionByName(one)
    return table.join(_recounted(stage(scored, "scored-again")), "model").selectExpr(
        "model", "scored_rows", "positives", f"{valid} AS metrics_valid", f"{holds} AS metrics_hold",
        f"coalesce(roc_auc, 0) >= {FLOOR} AS learnt", f"{ranked} AS ranked")


@query
def random_search(spark, folder):
    """The two best baselines; the first trial has the baseline's parameters, the others drawn ones. The stored summary must
    name the best of the stored trials."""
    rows, prepared = _split(spark, folder), {}
    best = [models.KEY_OF[r["model"]] for r in metrics.top_models(_comparison(rows, prepared), 2).collect()]
    train, val = (rows.where(F.col("split") == s).drop("split") for s in ("train", "val"))
    objective = models.validation_objective(train, val, prepared=prepared, **SEARCH_BUDGET)
    trials = search.search(spark, best, objective, staged_path(spark, "trials"), n_trials=SEARCH_TRIALS)
    summary = stage(search.search_summary(trials), "best-params")
    expected = spark.createDataFrame([(k, t, json.dumps(search.sample_params(k, t), sort_keys=True))
                                      for k in best for t in range(SEARCH_TRIALS)], "family string, trial int, drawn string")
    named = summary.select("family", F.col("trial").alias("best_trial"), F.col("params").alias("best_drawn"),
                           F.col("val_roc_auc").alias("best_area"), "trials")
    checked = trials.join(expected, ["family", "trial"]).join(named, "family").selectExpr(
        "trial", f"params = drawn AND val_roc_auc BETWEEN {FLOOR} AND 1 AS valid",
        f"trials = {SEARCH_TRIALS} AND IF(trial = best_trial, params = best_drawn AND val_roc_auc = best_area, "
        "val_roc_auc < best_area OR (val_roc_auc = best_area AND trial > best_trial)) AS summed_up")
    return checked.groupBy("trial").agg(F.count_if("valid").cast("int").alias("valid_families"),
                                        F.count_if("summed_up").cast("int").alias("summed_up_families"))


@query
def final_model(spark, folder):
    """Refit on all rows; the saved metadata row."""
    return spark.read.parquet(f"{_bundle(spark, folder)}/metadata").select(
        "model_name", "model_key", "model_family", "trained_rows", "source_data", F.col("threshold").cast("string").alias("threshold"))


@query
def score_batch(spark, folder):
    """A saved model scores every applicant of a CSV file that lacks a feature column; one of them is scored alone as well."""
    rows, batch = cleaned(spark, folder), staged_path(spark, "batch") + ".csv"
    bundle = models.load_bundle(spark, _bundle(spark, folder))
    writers.write_dataset(rows.drop(LABEL, "inst_avg_delay"), batch, "csv")
    uploaded = read_batch(spark, bundle, batch)
    scored = stage(bundle.score(uploaded), "scored")
    labelled = scored.join(rows.select("SK_ID_CURR", LABEL), "SK_ID_CURR")
    area = metrics.roc_auc(labelled, "probability").selectExpr(f"roc_auc >= {FLOOR} AS learnt")
    chosen = rows.agg(F.max("SK_ID_CURR")).first()[0]
    alone = bundle.score_one(uploaded, chosen).agg(F.count("*").alias("found"), F.max("probability").alias("alone"))
    return scored.join(F.broadcast(area)).join(F.broadcast(alone)).selectExpr(
        "SK_ID_CURR", "probability BETWEEN 0 AND 1 AS probability_valid", "learnt",
        f"found = 1 AND (SK_ID_CURR <> {chosen} OR abs(probability - alone) < 1e-9) AS alone_same",
        "decision = IF(probability < 0.48, 'Low risk', 'High risk') AS decision_valid",
        "risk_band = CASE WHEN probability < 0.25 THEN 'Low' WHEN probability < 0.5 THEN 'Medium' "
        "WHEN probability < 0.75 THEN 'High' ELSE 'Very high' END AS band_valid")
