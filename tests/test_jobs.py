"""The whole chain as a user runs it: raw CSV -> features -> reports -> models -> scores."""

import pytest
from pyspark.sql import functions as F

import catalog
from riskloom.operators.models import load_bundle
from riskloom.plans import (
    build_dataset, clean_dataset, final_model, profile_dataset, score_arrivals, score_batch, train_models, tune_models)
from riskloom.sources.writers import write_dataset


@pytest.fixture(scope="module")
def chain(spark, testdata, tmp_path_factory):
    base = tmp_path_factory.mktemp("chain")
    paths = {n: str(base / n) for n in ("raw", "built", "clean", "reports", "artifacts")}
    for name, df in catalog._train_test_sources(spark, testdata).items():
        if name == "application_test":
            df = df.withColumn("SK_ID_CURR", F.col("SK_ID_CURR") + 1_000_000)
        write_dataset(df, f"{paths['raw']}/{name}.csv", "csv")
    build_dataset.run(spark, paths["raw"], paths["built"])
    clean_dataset.run(spark, paths["built"], paths["clean"])
    return paths


def test_build_and_clean(spark, chain):
    train = spark.read.parquet(f"{chain['clean']}/final_train_cleaned")
    test = spark.read.parquet(f"{chain['clean']}/final_test_cleaned")
    assert train.count() == 1500 and test.count() == 100
    assert set(train.columns) - set(test.columns) == {"TARGET"}
    assert train.where("DAYS_EMPLOYED = 365243").count() == 0
    names = spark.read.option("header", True).csv(f"{chain['built']}/final_test_feature_names")
    assert "TARGET" not in [r["feature"] for r in names.collect()] and names.count() == len(test.columns)
    report = spark.read.parquet(f"{chain['clean']}/column_report")
    assert report.where("feature = 'TARGET' AND decision = 'Target'").count() == 1


def test_profile(spark, chain):
    profile_dataset.run(spark, chain["built"], chain["reports"])
    assert spark.read.parquet(f"{chain['reports']}/spearman_matrix").count() == 31 * 30 // 2
    assert spark.read.parquet(f"{chain['reports']}/box_stats").count() == 40
    assert spark.read.parquet(f"{chain['reports']}/infinities").count() == 2


def test_train_tune_refit_score(spark, chain, tmp_path):
    artifacts = chain["artifacts"]
    train_models.run(spark, chain["clean"], artifacts, rounds=2)
    results = spark.read.parquet(f"{artifacts}/baseline_results")
    assert results.count() == 4 and results.where("roc_auc BETWEEN 0 AND 1").count() == 4

    batch = str(tmp_path / "batch.csv")
    test = spark.read.parquet(f"{chain['clean']}/final_test_cleaned")
    write_dataset(test.drop("inst_avg_delay", "EXT_SOURCE_MEAN").select(*reversed(test.columns[:5]), *[
        c for c in test.columns[5:] if c not in ("inst_avg_delay", "EXT_SOURCE_MEAN")]), batch, "csv")
    score_batch.run(spark, artifacts, batch, f"{tmp_path}/first")       # best baseline
    assert spark.read.parquet(f"{tmp_path}/first").count() == 100

    tune_models.run(spark, artifacts, trials=1, rounds=2)
    assert spark.read.parquet(f"{artifacts}/best_params").where("winner").count() == 1
    final_model.run(spark, chain["clean"], artifacts, rounds=2)
    metadata = spark.read.parquet(f"{artifacts}/final/metadata").first()
    assert metadata["trained_rows"] == 1500 and metadata["threshold"] == 0.48 and metadata["baseline_roc_auc"] > 0

    score_batch.run(spark, artifacts, batch, f"{tmp_path}/all")
    scores = spark.read.parquet(f"{tmp_path}/all")
    assert scores.columns == ["SK_ID_CURR", "probability", "decision", "risk_band"] and scores.count() == 100
    assert scores.where("(probability >= 0.48) <> (decision = 'High risk')").count() == 0
    score_batch.run(spark, artifacts, batch, f"{tmp_path}/one", threshold=0.0, applicant=1_000_007)
    only = spark.read.parquet(f"{tmp_path}/one").collect()
    same = scores.where("SK_ID_CURR = 1000007").first()
    assert len(only) == 1 and only[0]["probability"] == same["probability"] and only[0]["decision"] == "High risk"

    schema = load_bundle(spark, f"{artifacts}/final").input_schema
    arrivals, columns = str(tmp_path / "arrivals"), ["SK_ID_CURR", *schema.names]
    for half in (0, 1):
        write_dataset(test.where(f"SK_ID_CURR % 2 = {half}").select(columns).coalesce(1), arrivals, "csv", "append")
        assert score_arrivals.run(spark, artifacts, arrivals, f"{tmp_path}/arrived", f"{tmp_path}/state") == 50
    arrived = spark.read.parquet(f"{tmp_path}/arrived")
    full = spark.read.parquet(f"{artifacts}/final/metadata")
    assert arrived.columns == scores.columns and arrived.count() == 100 and full.count() == 1
    batch_all = str(tmp_path / "full.csv")
    write_dataset(test, batch_all, "csv")
    score_batch.run(spark, artifacts, batch_all, f"{tmp_path}/full_scores")
    assert arrived.exceptAll(spark.read.parquet(f"{tmp_path}/full_scores")).isEmpty()
