import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom import session
from riskloom.functions import selectors
from riskloom.operators import models, scoring, search
from riskloom.sources import readers, schemas, writers


def test_schema_widths():
    assert len(schemas.APPLICATION_TEST) == 121 and len(schemas.APPLICATION_TRAIN) == 122
    kinds = [f.dataType.simpleString() for f in schemas.APPLICATION_TEST]
    assert {k: kinds.count(k) for k in set(kinds)} == {"bigint": 1, "int": 38, "string": 16, "double": 66}


def test_csv_by_header_with_gaps_and_infinities(spark, tmp_path):
    path = tmp_path / "batch.csv"
    path.write_text('"extra","AMT","SK_ID_CURR","CNT","STATUS","NAME"\n"x","inf","1","8.0","0","NA"\n'
                    '"x","-inf","2","","C","XNA"\n"x","","3","NaN","5",""\n"x","2.5","4","7","X","a ""b"", c"\n')
    schema = T._parse_datatype_string("SK_ID_CURR long, NAME string, AMT double, CNT long, STATUS string, ABSENT double")
    df = readers.read_csv(spark, str(path), schema).orderBy("SK_ID_CURR")
    assert df.columns == ["SK_ID_CURR", "NAME", "AMT", "CNT", "STATUS"]
    assert [tuple(r) for r in df.collect()] == [
        (1, None, math.inf, 8, "0"), (2, "XNA", -math.inf, None, "C"), (3, None, None, None, "5"),
        (4, 'a "b", c', 2.5, 7, "X")]


def test_text_in_a_number_column_fails(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text("SK_ID_CURR,AMT\n1,abc\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        readers.read_csv(spark, str(path), T._parse_datatype_string("SK_ID_CURR long, AMT double")).collect()


def test_split_folders_are_pruned(spark, tmp_path):
    df = spark.range(30).select("id", F.element_at(F.array(*map(F.lit, ("train", "val", "eval"))), (F.col("id") % 3 + 1).cast("int")).alias("split"))
    writers.write_split(df, str(tmp_path / "split"))
    val = writers.read_split(spark, str(tmp_path / "split"), "val")
    assert sorted(r["id"] for r in val.collect()) == list(range(1, 30, 3))
    assert "PartitionFilters: [isnotnull(split" in val._jdf.queryExecution().executedPlan().toString()


def test_feature_names_are_the_tables_own(spark):
    assert [tuple(r) for r in writers.feature_names(spark.range(1).selectExpr("id", "1 AS b")).collect()] == [(0, "id"), (1, "b")]


def test_staged_tables_go_to_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    staged = session.stage(spark.range(3), "x")
    assert all(shared in f for f in staged.inputFiles()) and staged.count() == 3


def test_name_rules():
    names = ["SK_ID_CURR", "DAYS_A", "bureau_month_min", "MONTHS_B", "pay_Ratio", "CNT_X", "prev_count"]
    assert selectors.id_columns(names) == ["SK_ID_CURR"]
    assert selectors.day_columns(names + ["days"]) == ["DAYS_A"]
    assert selectors.month_columns(names) == ["bureau_month_min", "MONTHS_B"]
    assert selectors.ratio_columns(names) == ["pay_Ratio"] and selectors.count_columns(names) == ["CNT_X", "prev_count"]
    assert selectors.without(names + ["DAYS_A"], ["SK_ID_CURR"], ["CNT_X"]) == [
        "DAYS_A", "bureau_month_min", "MONTHS_B", "pay_Ratio", "prev_count"]


def test_padding_orders_and_types(spark):
    batch = spark.createDataFrame([(1, 2, "x")], "b int, a int, other string")
    out = scoring.pad_columns(batch, T._parse_datatype_string("a double, gone string, b long"))
    assert out.dtypes == [("a", "double"), ("gone", "string"), ("b", "bigint")]
    assert tuple(out.first()) == (2.0, None, 1)


def test_decision_and_band(spark):
    df = spark.createDataFrame([(0.1,), (0.48,), (0.5,), (0.99,), (None,)], "probability double")
    got = [tuple(r)[1:] for r in scoring.decisions(df).collect()]
    assert got == [("Low risk", "Low"), ("High risk", "Medium"), ("High risk", "High"), ("High risk", "Very high"), (None, None)]
    custom = scoring.decisions(df, threshold=0.6, bands=((0.5, "ok"), (None, "bad"))).collect()
    assert [r["decision"] for r in custom[:4]] == ["Low risk"] * 3 + ["High risk"] and custom[2]["risk_band"] == "bad"


def test_tree_depth():
    assert models.tree_depth({"num_leaves": 31, "max_depth": -1}) == 5
    assert models.tree_depth({"num_leaves": 255, "max_depth": 4}) == 4
    assert models.tree_depth({"depth": 6}) == 6


def test_sampled_parameters_stay_in_their_space():
    for key, space in search.SPACES.items():
        assert search.sample_params(key, 0) == dict(models.FAMILIES[key].params)
        assert search.sample_params(key, 3) == search.sample_params(key, 3) != search.sample_params(key, 4)
        for trial in range(1, 50):
            drawn = search.sample_params(key, trial)
            assert all(low <= drawn[name] <= high for name, (low, high, _) in space.items())


def test_search_resumes(spark, tmp_path):
    calls = []

    def objective(key, params):
        calls.append(key)
        return len(calls) / 10
    path = str(tmp_path / "trials")
    search.search(spark, ["sgd"], objective, path, n_trials=2)
    trials = search.search(spark, ["sgd", "xgb"], objective, path, n_trials=3)
    assert calls == ["sgd"] * 3 + ["xgb"] * 3 and trials.count() == 6
    summary = {r["family"]: r for r in search.search_summary(trials).collect()}
    assert summary["sgd"]["trial"] == 2 and summary["xgb"]["winner"] and not summary["sgd"]["winner"]
    assert search.best_params(trials)["xgb"]["val_roc_auc"] == pytest.approx(0.6)
    assert search.best_params(search.read_trials(spark, str(tmp_path / "none"))) == {}


def test_csv_ids_stay_exact(spark, tmp_path):
    (tmp_path / "ids.csv").write_text('id,n\n9007199254740993,8.0\n9007199254740995,\n"-9223372036854775808",7\n')
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("n", T.IntegerType())])
    got = readers.read_csv(spark, str(tmp_path / "ids.csv"), schema).collect()
    assert sorted(map(tuple, got)) == [(-(2**63), 7), (9007199254740993, 8), (9007199254740995, None)]
    for wrong in ("8.7", "eight"):
        (tmp_path / "bad.csv").write_text(f"id,n\n1,{wrong}\n")
        with pytest.raises(Exception, match="whole number"):
            readers.read_csv(spark, str(tmp_path / "bad.csv"), schema).collect()
