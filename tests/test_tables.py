"""Duplicates, frequent values, bitmaps, splits by id, bucketed tables, observed joins, arrivals."""

import collections
import hashlib
import random

import pytest
from pyspark.sql import functions as F

import catalog
from riskloom.operators import assemble, checks, profiling, scoring, split
from riskloom.sources import bindings, writers
from riskloom.streaming.arrivals import score_arrivals


def shuffled_bytes(spark):
    executors = spark.sparkContext._jsc.sc().statusStore().executorList(True)
    return sum(executors.apply(i).totalShuffleWrite() for i in range(executors.size()))


@pytest.mark.parametrize("limit", [500_000, 0])
def test_duplicates_of_rows(spark, monkeypatch, limit):
    monkeypatch.setattr(profiling, "REPEATED_DIGESTS", limit)
    rows = [(None, 1, "a"), (1, None, "a"), (1, 1, None), (0, 0, ""), (None, None, None)] * 2 + [(i, i, str(i)) for i in range(50)]
    df = spark.createDataFrame(rows, "x int, y int, s string").selectExpr(
        "*", "IF(x = 0, -0.0D, 0.0D) AS zero", "IF(y = 7, double('NaN'), 1D) AS `odd name`", "array(x, y) AS list").repartition(4)
    exact = df.groupBy(*[f"`{c}`" for c in df.columns]).count()
    assert tuple(profiling.duplicate_report(df).first()) == (60, 60 - exact.count())
    kept = profiling.drop_duplicates(df)
    assert kept.columns == df.columns
    assert sorted(map(str, kept.drop("zero").collect())) == sorted(map(str, df.dropDuplicates().drop("zero").collect()))
    assert tuple(profiling.duplicate_report(df.where("false")).first()) == (0, 0)
    assert profiling.drop_duplicates(df.where("false")).count() == 0
    maps = spark.createDataFrame([({"a": 1},), ({"a": 1},)], "m map<string,int>")
    assert not profiling._hashable(maps)


def test_only_rows_with_a_repeated_digest_are_moved(spark):
    wide = spark.range(30_000).selectExpr("IF(id < 29990, id, 7) AS k", *[f"md5(concat(IF(id < 29990, id, 7), '-{i}')) AS c{i}" for i in range(20)])
    before = shuffled_bytes(spark)
    assert tuple(profiling.duplicate_report(wide).first()) == (30_000, 10)
    digests = shuffled_bytes(spark) - before
    wide.groupBy(*wide.columns).count().where("count > 1").collect()
    assert digests * 10 < shuffled_bytes(spark) - before - digests


def test_frequent_values_and_plan(spark):
    rng = random.Random(2)
    rows = [(str(i), "x" * 200 if i % 10 else "y" * 200 + str(i), rng.choice([None, None, None, "b"]), float(i % 3), "it's \\ here" if i % 5 else None)
            for i in range(4000)]
    df = spark.createDataFrame(rows, "id string, long_text string, gaps string, third double, odd string").repartition(7)
    counts = {c: collections.Counter(r[i] for r in rows).most_common(1)[0][1] / 4000 for i, c in enumerate(df.columns)}
    for share in (0.9, 0.7, 0.3, 0.05):
        got = {r["feature"]: r["top_share"] for r in profiling.near_constant(df, share).collect()}
        assert got == {c: s for c, s in counts.items() if s >= share}
    before = shuffled_bytes(spark)
    profiling.near_constant(df, 0.9).collect()
    assert shuffled_bytes(spark) - before < 400_000
    assert profiling.near_constant(df.where("false")).collect() == []


def test_bitmaps_of_whole_numbers(spark):
    df = spark.range(0, 2_000_000, 1, 8).selectExpr(
        "CAST(xxhash64(id) % 40000 AS INT) AS near", "IF(id % 3 = 0, NULL, CAST(id % 7 - 3 AS SMALLINT)) AS small",
        "id * 1000003 AS far", "CAST(id % 11 AS DOUBLE) AS whole_double", "CAST(NULL AS BIGINT) AS gone")
    assert profiling._dense_columns(df, df.columns) == ["near", "small"]
    want = df.agg(*[F.count_distinct(c).alias(c) for c in df.columns]).first().asDict()
    got = {r["feature"]: r["distinct_values"] for r in profiling.distinct_counts(df, df.columns).collect()}
    assert got == {c: n for c, n in want.items() if n}
    before = shuffled_bytes(spark)
    profiling.distinct_counts(df, ["near", "small"]).collect()
    bitmaps = shuffled_bytes(spark) - before
    df.selectExpr("inline(array(struct('near' AS f, near AS v), struct('small' AS f, CAST(small AS INT) AS v)))").distinct().groupBy("f").count().collect()
    assert bitmaps * 10 < shuffled_bytes(spark) - before - bitmaps


def split_by_hand(rows):
    """Ids in (md5, id) order of their stratum; a cut goes to the nearer end of the id that it falls in."""
    groups = {}
    for i, y in rows:
        if y is not None:
            groups.setdefault(i, []).append(y)
    strata = {}
    for i, labels in groups.items():
        strata.setdefault(min(labels), []).append((hashlib.md5("-".join(str(x) for x in (i, 42) if x is not None).encode()).hexdigest(), i))
    sizes, out = split.split_sizes({y: sum(len(groups[i]) for _, i in ids) for y, ids in strata.items()}), {}
    for y, ids in strata.items():
        train, val, _ = sizes[y]
        before = 0
        for _, i in sorted(ids, key=lambda x: (x[0], x[1] is not None, x[1])):
            n = len(groups[i])
            out[i] = next((s for s, k in (("train", train), ("val", train + val)) if 2 * (k - before) >= n and k), "eval")
            before += n
    return out, sizes


@pytest.mark.parametrize("mixed", [False, True])
def test_split_keeps_ids_together(spark, mixed):
    rng = random.Random(6)
    rows = []
    for i in [None, *range(300)]:
        label = rng.randrange(2)
        for _ in range(rng.choice([1, 1, 2, 9, 40])):
            rows.append((i, rng.choice([label, label, label, 1 - label]) if mixed else label))
    rows += [(5, None), (1000, None)] + [(77, 0 if mixed else dict(r for r in rows if r[0] == 77)[77])] * 2500
    df = spark.createDataFrame(rows, "SK_ID_CURR long, TARGET int").repartition(5)
    got = split.stratified_split_by_id(df)
    assert got.columns == ["SK_ID_CURR", "TARGET", "split"]
    found = {(r["SK_ID_CURR"], r["TARGET"] is None): r["split"] for r in got.distinct().collect()}
    want, sizes = split_by_hand(rows)
    assert found == {**{(i, False): s for i, s in want.items()}, (5, True): None, (1000, True): None}
    per_id = got.where("TARGET is not null").groupBy("SK_ID_CURR").agg(F.count_distinct("split").alias("n")).where("n > 1")
    assert per_id.isEmpty() and got.count() == len(rows)
    assert split.stratified_split_by_id(df.where("false")).collect() == []


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    left = spark.range(5000).selectExpr("id % 900 AS SK_ID_CURR", "id AS v", "concat('t', id) AS `a name`")
    right = spark.range(1000).selectExpr("id AS SK_ID_CURR", "id * 2 AS w")
    writers.write_bucketed(left, str(tmp_path / "left"), "SK_ID_CURR", 6)
    writers.write_bucketed(right, str(tmp_path / "right"), "SK_ID_CURR", 6)
    for name in ("left", "right"):
        spark.sql(f"DROP TABLE {writers._bucketed_name(str(tmp_path / name))}")    # as in another session
    a, b = (writers.read_bucketed(spark, str(tmp_path / n)) for n in ("left", "right"))
    joined = a.join(b.hint("merge"), "SK_ID_CURR", "left")
    grouped = a.groupBy("SK_ID_CURR").agg(F.count("*").alias("n"))
    for df in (joined, grouped):
        df.collect()
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    assert joined.count() == 5000 and joined.agg(F.sum("w")).first()[0] == left.agg(F.sum(F.col("SK_ID_CURR") * 2)).first()[0]


def test_bucketed_assembly_has_no_shuffle(spark, testdata):
    df = catalog.QUERIES["bucketed_assembly"](spark, testdata)
    assert df.count() == 1500
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


def test_observed_join(spark, testdata, tmp_path):
    t = bindings.load(spark, testdata)
    watched = {}
    applications = t["application"]
    twice = bindings.load(spark, testdata)["application"].select("SK_ID_CURR", F.lit(1).alias("extra"))
    twice = twice.unionByName(twice.where("SK_ID_CURR < 10"))
    assemble.assemble(applications, [("twice", twice)], watched=watched).write.parquet(str(tmp_path / "out"))
    report = {r["place"]: tuple(r)[1:] for r in checks.watched_report(spark, watched).collect()}
    n, total = applications.count(), applications.agg(F.sum("SK_ID_CURR")).first()[0]
    assert report["applications"] == (n, n, total) and report["assembled"][0] == n + 10 and report["twice"][0] == n + 10
    with pytest.raises(ValueError, match="became"):
        checks.assert_kept(watched["applications"], watched["assembled"], "rows")
    checks.assert_kept(watched["applications"], watched["applications"], "rows")


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_arrivals_are_scored_once(spark, tmp_path, fmt):
    folder, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    rows = spark.range(100).selectExpr("id AS SK_ID_CURR", "id / 100D AS probability")

    def arrive(part):
        writers.write_dataset(rows.where(f"SK_ID_CURR DIV 40 = {part}").coalesce(1), folder, fmt, "append")

    def run():
        return score_arrivals(spark, scoring.decisions, folder, rows.schema, out, state, fmt, files=1)
    arrive(0)
    assert run() == 40
    assert run() == 0
    arrive(1)
    arrive(2)
    assert run() == 60
    scores = spark.read.parquet(out)
    assert scores.count() == 100 and scores.select("SK_ID_CURR").distinct().count() == 100
    assert scores.where("(probability >= 0.48) <> (decision = 'High risk')").isEmpty()
