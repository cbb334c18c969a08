import hashlib
import math

import pytest
from pyspark.sql import functions as F

from riskloom.operators import dictionary, preprocess, split


def brute_split(rows, seed=42):
    sizes = split.split_sizes({y: sum(1 for _, t in rows if t == y) for y in {t for _, t in rows}})
    out = {}
    for label, (train, val, _) in sizes.items():
        ordered = sorted((hashlib.md5(f"{i}-{seed}".encode()).hexdigest(), i) for i, t in rows if t == label)
        for place, (_, i) in enumerate(ordered):
            out[i] = "train" if place < train else "val" if place < train + val else "eval"
    return out


@pytest.mark.parametrize("step", [3, 1])
def test_split_is_exact_and_independent_of_layout(spark, monkeypatch, step):
    monkeypatch.setattr(split, "_STEP", step)
    rows = [(i, int(i % 11 == 0)) for i in range(1999)]
    df = spark.createDataFrame(rows, "SK_ID_CURR long, TARGET int")
    got = {r["SK_ID_CURR"]: r["split"] for r in split.stratified_split(df.repartition(5)).collect()}
    assert got == brute_split(rows)
    assert got == {r["SK_ID_CURR"]: r["split"] for r in split.stratified_split(df.orderBy(F.rand(2))).collect()}


def test_split_sizes():
    sizes = split.split_sizes({0: 919, 1: 81})
    assert [sum(s[i] for s in sizes.values()) for i in range(3)] == [700, 150, 150]
    for label, n in ((0, 919), (1, 81)):
        assert abs(sizes[label][0] - 0.7 * n) < 1 and abs(sizes[label][1] - 0.15 * n) <= 1
    assert split.split_sizes({0: 3, 1: 1}) and sum(sum(s) for s in split.split_sizes({0: 3, 1: 1}).values()) == 4


def test_split_of_many_labels(spark):
    rows = [(i, i % 150) for i in range(3000)]
    df = spark.createDataFrame(rows, "SK_ID_CURR long, TARGET int")
    assert {r["SK_ID_CURR"]: r["split"] for r in split.stratified_split(df).collect()} == brute_split(rows)


def test_repeated_id_is_refused(spark):
    df = spark.createDataFrame([(7, 0)] * 50, "SK_ID_CURR long, TARGET int")
    with pytest.raises(ValueError, match="unique"):
        split.stratified_split(df)


def test_imputing(spark):
    df = spark.createDataFrame([(1, 1.0, "b", None), (2, None, "a", None), (3, 3.0, "a", None), (4, 10.0, "b", None),
                                (5, 2.0, None, None)], "SK_ID_CURR long, x double, s string, empty double")
    medians = preprocess.fit_medians(df, ["x", "empty"])
    assert medians == {"x": 2.5, "empty": None}
    modes = preprocess.fit_modes(df, ["s"])
    assert modes == {"s": "a"}                     # tie: the smaller text
    filled = preprocess.impute_mode(preprocess.impute_median(df, medians), modes)
    assert filled.columns == ["SK_ID_CURR", "x", "s"]
    assert [tuple(r)[1:] for r in filled.orderBy("SK_ID_CURR").collect()] == [
        (1.0, "b"), (2.5, "a"), (3.0, "a"), (10.0, "b"), (2.0, "a")]


def test_zero_gap_scales_by_one(spark):
    df = spark.createDataFrame([(v,) for v in (5.0, 5.0, 5.0, 5.0, 5.0, 9.0)], "x double")
    scales = preprocess.fit_scales(df, ["x"])
    assert scales == {"x": (5.0, 1.0)}
    assert [r["x"] for r in preprocess.robust_scale(df, scales).collect()] == [0.0] * 5 + [4.0]
    quartiles = preprocess.fit_scales(spark.createDataFrame([(float(v),) for v in range(5)], "x double"), ["x"], (0.25, 0.75))
    assert quartiles == {"x": (2.0, 2.0)}


def test_encodings(spark):
    train = spark.createDataFrame([("b",), ("a",), ("it's",)], "s string")
    words = preprocess.fit_vocabularies(train, ["s"])
    assert words == {"s": ["a", "b", "it's"]}
    rows = spark.createDataFrame([(1, "a"), (2, "it's"), (3, "new")], "k int, s string").orderBy("k")
    hot = preprocess.one_hot(rows, words)
    assert hot.columns == ["k", "s_a", "s_b", "s_it's"]
    assert [tuple(r) for r in hot.collect()] == [(1, 1, 0, 0), (2, 0, 0, 1), (3, 0, 0, 0)]
    assert preprocess.one_hot(rows, words, drop_first=True).columns == ["k", "s_b", "s_it's"]
    codes = dictionary.fit_dictionary(train, ["s"])
    assert [r["s"] for r in preprocess.category_codes(rows, codes, ["s"], "k").orderBy("k").collect()] == [0, 2, None]
    shown = preprocess.indicator_codes(rows, codes, ["s"], True, "k").orderBy("k").collect()
    assert [r["s"] for r in shown] == [2.0, 1.0, 2.0]


@pytest.mark.parametrize("limit", [dictionary.BROADCAST_BYTES, 0])
def test_codes_are_dense_and_in_text_order(spark, monkeypatch, limit):
    """Codes by broadcast and by shuffle, with a hot text, texts that only sort by their bytes, NULL and an empty column."""
    monkeypatch.setattr(dictionary, "BROADCAST_BYTES", limit)
    texts = ["v%d" % (i % 700) for i in range(5000)] + ["hot"] * 4000 + ["", " ", "é", "z", "漢", "😀", "it's", "a\\b", None, None]
    rows = [(i, t, "same", None) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "SK_ID_CURR long, s string, flat string, gone string").repartition(5)
    fitted = dictionary.fit_dictionary(df, ["s", "flat", "gone"])
    order = {v: i for i, v in enumerate(sorted({t for t in texts if t is not None}))}
    assert fitted.sizes == {"s": len(order), "flat": 1, "gone": 0}
    assert fitted.values(spark, ["s"]) == {"s": list(order)}
    later = df.unionByName(spark.createDataFrame([(-1, "new", "other", "x")], df.schema))
    got = {r["SK_ID_CURR"]: tuple(r)[1:] for r in dictionary.encode(later, fitted, ["s", "flat", "gone"]).collect()}
    assert got == {-1: (None, None, None), **{i: (order.get(t), 0, None) for i, t, *_ in rows}}
    copy = fitted.copied(spark, fitted.path + "-copy")
    assert copy.table(spark).count() == len(order) + 1
    assert dictionary.fit_dictionary(df.where("false"), ["s"]).sizes == {"s": 0} and dictionary.fit_dictionary(df, []).sizes == {}


def test_two_million_texts(spark):
    """Fitted and applied without the driver holding a text; a third of the rows have one text."""
    many = spark.range(3_000_000).selectExpr("id AS SK_ID_CURR", "IF(id % 3 = 0, 'hot', concat('v', xxhash64(id))) AS s")
    fitted = dictionary.fit_dictionary(many, ["s"])
    assert fitted.sizes["s"] == 2_000_001
    coded = many.selectExpr("*", "s AS shown").join(fitted.of(spark, "s").withColumnRenamed("value", "s"), "s", "left_anti")
    assert coded.isEmpty()
    ends = fitted.table(spark).agg(F.min("code"), F.max("code"), F.count_distinct("code")).first()
    assert tuple(ends) == (0, 2_000_000, 2_000_001)
    codes = fitted.table(spark).toPandas().sort_values("code")["value"].to_numpy()
    assert (codes[:-1] < codes[1:]).all()
    got = dictionary.encode(many.selectExpr("*", "s AS shown"), fitted, ["s"])
    right = got.join(fitted.table(spark).withColumnRenamed("code", "s"), "s").where("shown = value")
    assert right.count() == 3_000_000


def test_target_encoding_leaves_out_the_own_fold(spark):
    rows = [(i, int(i % 3 == 0), "ab"[i % 2], i < 40) for i in range(60)]
    df = spark.createDataFrame(rows, "SK_ID_CURR long, TARGET int, s string, in_train boolean")
    train = df.where("in_train")
    prior = sum(t for _, t, _, tr in rows if tr) / 40
    means = preprocess.fit_target_means(train, ["s"])
    got = {r["SK_ID_CURR"]: r["s"] for r in preprocess.target_encode(
        df, means, ["s"], prior, is_train=F.col("in_train"), smoothing=2.0).collect()}
    fold = {i: int(hashlib.md5(f"{i}-42".encode()).hexdigest()[:7], 16) % 5 for i, *_ in rows}
    for i, _, s, tr in rows:
        used = [t for j, t, v, in_train in rows if in_train and v == s and not (tr and fold[j] == fold[i])]
        assert got[i] == pytest.approx((sum(used) + 2 * prior) / (len(used) + 2))


def test_class_weights(spark):
    df = spark.createDataFrame([(0,)] * 3 + [(1,)], "TARGET int")
    assert {r["TARGET"]: r["weight"] for r in preprocess.class_weights(df).collect()} == {0: 4 / 6, 1: 2.0}


def test_recipe_survives_json(spark, tmp_path):
    fitted = dictionary.fit_dictionary(spark.createDataFrame([("a",), ("b",)], "s string"), ["s"], str(tmp_path / "words"))
    recipe = preprocess.Recipe("scaled", {"x": 0.1, "gone": None}, {"s": "a"}, {"x": (0.1, math.pi)}, fitted)
    assert preprocess.Recipe.from_json(recipe.to_json()) == recipe
    assert recipe.features(spark) == ["x", "s_b"] and recipe.categories() == {"s": 1}
