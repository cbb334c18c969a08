"""Column and table reports. Every report is long: one row per column."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.quantiles import quantiles, unpivoted
from ..functions.scalar import hundredths, nan_to_null, sample_skewness
from ..functions.selectors import (
    ID, LABEL, boolean_columns, day_columns, float_columns, month_columns, numeric_columns, string_columns, without)
from ..functions.sqltext import INFINITE, number, quoted, text
from ..session import stage

FENCE = 1.5
#: up to this many repeated digests (16 bytes each) are broadcast
REPEATED_DIGESTS = 500_000
#: values that a summary of frequent values tracks at least; longer texts enter it as a digest
LEAST_TRACKED, LONG_TEXT = 1024, 64
#: whole numbers of one bitmap, and values that a column needs for each bitmap
BUCKET, ROWS_PER_BUCKET = 32_768, 2_048


def _per_column(df: DataFrame, columns: Sequence[str], measure: str, name: str) -> DataFrame:
    """(feature, <name>, row_count): one measure of each column, from a single scan."""
    columns = list(columns)
    wide = df.selectExpr("count(*) AS row_count", *[
        f"{measure.format(quoted(c))} AS {quoted(c)}" for c in columns])
    return _long(wide, columns, name)


def _long(wide: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """One row of (row_count, measures...) -> (feature, <name>, row_count)."""
    pairs = ", ".join(f"struct({text(c)} AS feature, {quoted(c)} AS {name})" for c in columns)
    return wide.selectExpr(f"inline(array({pairs}))", "row_count").select("feature", name, "row_count")


# --- tables -------------------------------------------------------------------------------

def table_info(df: DataFrame) -> DataFrame:
    """One row: rows, features (columns besides the key) and missing cells."""
    cells = _per_column(df, df.columns, "count_if({} IS NULL)", "missing")
    return cells.agg(F.max("row_count").alias("row_count"), F.lit(len(df.columns) - 1).alias("feature_count"),
                     F.sum("missing").alias("missing_cells"))


def column_info(df: DataFrame) -> DataFrame:
    """(ordinal, feature, dtype, non_null) in column order."""
    described = df.sparkSession.createDataFrame(
        [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)],
        "ordinal int, feature string, dtype string")
    present = _per_column(df, df.columns, "count({})", "non_null")
    return described.join(F.broadcast(present), "feature").select("ordinal", "feature", "dtype", "non_null")


def missing_report(df: DataFrame) -> DataFrame:
    """(feature, missing, missing_pct) of the columns that miss something, most first."""
    cells = _per_column(df, df.columns, "count_if({} IS NULL)", "missing")
    return (cells.where("missing > 0")
            .select("feature", "missing", (F.col("missing") / F.col("row_count") * 100).alias("missing_pct"))
            .orderBy(F.desc("missing"), "feature"))


def infinity_report(df: DataFrame) -> DataFrame:
    """(feature, infinities) of the columns that hold any."""
    floats = float_columns(df)
    if not floats:
        return df.sparkSession.createDataFrame([], "feature string, infinities long")
    cells = _per_column(df, floats, "count_if(abs({}) = " + INFINITE + ")", "infinities")
    return cells.where("infinities > 0").select("feature", "infinities")


def feature_summary(df: DataFrame) -> DataFrame:
    """One row: how many numeric, categorical and boolean columns.

    A text column that only holds True and False counts as neither.
    """
    texts = string_columns(df)
    fixed = (F.lit(len(numeric_columns(df))).alias("numeric_columns"),
             F.lit(len(boolean_columns(df))).alias("boolean_columns"))
    truths = [F.expr(f"CAST(coalesce(bool_and({quoted(c)} IN ('True', 'False')), true) AS INT)") for c in texts]
    written = sum(truths[1:], truths[0]) if truths else F.lit(0)
    return df.agg((F.lit(len(texts)) - written).alias("categorical_columns"),
                  F.first(fixed[0]).alias("numeric_columns"), F.first(fixed[1]).alias("boolean_columns"))


def label_distribution(df: DataFrame, label: str = LABEL) -> DataFrame:
    return df.groupBy(label).agg(F.count("*").alias("n")).orderBy(label)


def head(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    """First rows by key."""
    return df.orderBy(key).limit(n)


# --- duplicates and near-constants -------------------------------------------------------

def _row_digest(df: DataFrame) -> list[Column]:
    """Two 64-bit hashes of a row that are the same for equal rows; which cells are NULL goes in as well."""
    cells = [F.col(quoted(c)) for c in df.columns]
    present = F.concat(*[F.when(c.isNull(), "0").otherwise("1") for c in cells])
    return [F.xxhash64(*cells, present).alias("__h1"), F.xxhash64(present, *reversed(cells)).alias("__h2")]


def _hashable(df: DataFrame) -> bool:
    return bool(df.columns) and "map<" not in df.schema.simpleString()


def _repeated_digests(df: DataFrame) -> tuple[DataFrame, Observation]:
    """(__h1, __h2, __n) of the digests that more than one row has; the observation counts all rows."""
    seen = Observation()
    counts = df.select(*_row_digest(df)).groupBy("__h1", "__h2").agg(F.count("*").alias("__n"))
    return stage(counts.observe(seen, F.sum("__n").alias("row_count")).where("__n > 1"), "repeated-digests"), seen


def _among(df: DataFrame, digests: DataFrame, how: str) -> DataFrame:
    """Rows of ``df`` whose digest is (left_semi) or isn't (left_anti) among ``digests``."""
    return df.select("*", *_row_digest(df)).join(digests, ["__h1", "__h2"], how).select(*[quoted(c) for c in df.columns])


def duplicate_report(df: DataFrame) -> DataFrame:
    """One row: rows, and how many of them repeat an earlier row.

    Row digests of 16 bytes are counted first; only rows whose digest repeats are moved and compared in full.
    """
    if not _hashable(df):
        return df.groupBy(*df.columns).agg(F.count("*").alias("__copies")).agg(
            F.coalesce(F.sum("__copies"), F.lit(0)).alias("row_count"),
            F.coalesce(F.sum(F.col("__copies") - 1), F.lit(0)).alias("duplicates"))
    repeated, seen = _repeated_digests(df)
    alike = _among(df, repeated.drop("__n"), "left_semi")
    return alike.groupBy(*map(quoted, df.columns)).agg(F.count("*").alias("__copies")).agg(
        F.lit(seen.get["row_count"] or 0).cast("long").alias("row_count"),
        F.coalesce(F.sum(F.col("__copies") - 1), F.lit(0)).alias("duplicates"))


def drop_duplicates(df: DataFrame) -> DataFrame:
    """Each row once. While the repeated digests fit a broadcast, rows with a digest of their own stay where they are."""
    if not _hashable(df):
        return df.dropDuplicates()
    repeated = _repeated_digests(df)[0].drop("__n")
    n = repeated.count()
    if n > REPEATED_DIGESTS:
        return df.dropDuplicates()
    few = F.broadcast(repeated)
    return _among(df, few, "left_anti").unionByName(_among(df, few, "left_semi").dropDuplicates()) if n else df


def value_text(name: str, kind: T.DataType) -> str:
    """A text that is the same for the same value only; +0 and -0 are one value."""
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return f"CAST({quoted(name)} + 0.0D AS STRING)"
    if isinstance(kind, T.BinaryType):
        return f"hex({quoted(name)})"
    plain = not isinstance(kind, (T.ArrayType, T.MapType, T.StructType))
    return f"CAST({quoted(name)} AS STRING)" if plain else f"to_json(struct({quoted(name)}))"


def _cell_texts(df: DataFrame) -> DataFrame:
    """t0, t1, ...: every cell as a text, NULL as the empty one; texts of over LONG_TEXT characters as their SHA-256."""
    def shown(f):
        cell = value_text(f.name, f.dataType)
        return f"coalesce(concat('=', if(char_length({cell}) > {LONG_TEXT}, sha2({cell}, 256), {cell})), '')"
    return df.selectExpr(*[f"{shown(f)} AS t{i}" for i, f in enumerate(df.schema.fields)])


def near_constant(df: DataFrame, share: float = 0.995) -> DataFrame:
    """(feature, top_share) of the columns where one value, NULL included, has that share.

    Summaries of frequent values, one for each column and task and merged in two levels, name the values that may have the share: a
    summary of m values counts none too low, nor too high by more than 3.5 / m of the rows, so there are few. These are
    then counted exactly, in one pass. No cell is shuffled.
    """
    spark, names = df.sparkSession, df.columns
    if not names:
        return spark.createDataFrame([], "feature string, top_share double")
    tracked = max(LEAST_TRACKED, 2 ** math.ceil(math.log2(16 / share)))
    most = math.ceil(1 / (share - 3.5 / tracked)) + 1
    fan, cells = int(spark.conf.get("spark.sql.shuffle.partitions")), _cell_texts(df)
    by_task = cells.groupBy(F.pmod(F.spark_partition_id(), F.lit(fan)).alias("task")).agg(F.count("*").alias("n"), *[
        F.call_function("approx_top_k_accumulate", F.col(f"t{i}"), F.lit(tracked)).alias(f"s{i}") for i in range(len(names))])
    merged = by_task.withColumn("every", F.lit(0)).groupBy("every").agg(F.sum("n").alias("n"), *[F.call_function("approx_top_k_estimate", F.call_function(
        "approx_top_k_combine", F.col(f"s{i}"), F.lit(tracked)), F.lit(most)).alias(f"s{i}") for i in range(len(names))]).first()
    rows = merged["n"] if merged else 0
    likely = [(i, r["item"]) for i in range(len(names) if rows else 0) for r in merged[f"s{i}"] if r["count"] >= share * rows]
    if not likely:
        return spark.createDataFrame([], "feature string, top_share double")
    counts = cells.selectExpr(*[f"count_if(t{i} = {text(value)})" for i, value in likely]).first()
    shares: dict[int, float] = {}
    for (i, _), n in zip(likely, counts):
        shares[i] = max(shares.get(i, 0.0), n / rows)
    return spark.createDataFrame([(names[i], s) for i, s in shares.items() if s >= share], "feature string, top_share double")


def near_constant_columns(train: DataFrame, share: float = 0.995) -> list[str]:
    """Column names to drop, found on train and to be dropped from train and test."""
    found = {r["feature"] for r in near_constant(train, share).collect()}
    return [c for c in train.columns if c in found]


# --- numeric columns ----------------------------------------------------------------------

def describe(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """count, mean, std, min, quartiles and max per numeric column; undefined values are NULL."""
    columns = list(columns or numeric_columns(df))
    points = quantiles(df, columns, (0.25, 0.5, 0.75))
    quartiles = df.sparkSession.createDataFrame(
        [(c, *points[None, c]) for c in columns], "feature string, q25 double, q50 double, q75 double")
    cells = unpivoted(df, columns)
    moments = cells.groupBy("feature").agg(
        F.count("value").alias("n"), nan_to_null(F.avg("value")).alias("mean"),
        nan_to_null(F.stddev_samp("value")).alias("std"), F.min("value").alias("min"), F.max("value").alias("max"))
    return moments.join(F.broadcast(quartiles), "feature").select(
        "feature", "n", "mean", "std", "min", "q25", "q50", "q75", "max")


def fences(q1: float | None, q3: float | None) -> tuple[float | None, float | None]:
    """Bounds 1.5 interquartile ranges outside the quartiles."""
    if q1 is None or q3 is None:
        return None, None
    reach = FENCE * (q3 - q1)
    return q1 - reach, q3 + reach


def fit_iqr_bounds(df: DataFrame, columns: Sequence[str] | None = None) -> dict[str, tuple]:
    """{column: (q1, q3, lower, upper)}; small, kept on the driver to be used as literals."""
    columns = list(columns or numeric_columns(df))
    points = quantiles(df, columns, (0.25, 0.75))
    return {c: (*points[None, c], *fences(*points[None, c])) for c in columns}


def bounds_table(spark, bounds: dict[str, tuple]) -> DataFrame:
    return spark.createDataFrame([(c, *b) for c, b in bounds.items()],
                                 "feature string, q1 double, q3 double, lower_bound double, upper_bound double")


def _outside() -> Column:
    return (F.col("value") < F.col("lower_bound")) | (F.col("value") > F.col("upper_bound"))


def iqr_report(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Quartiles, bounds and the rows outside; the share is of all rows, NULL ones too."""
    columns = list(columns or numeric_columns(df))
    bounds = F.broadcast(bounds_table(df.sparkSession, fit_iqr_bounds(df, columns)))
    edges = ["q1", "q3", "lower_bound", "upper_bound"]
    cells = unpivoted(df, columns).join(bounds, "feature")
    # bounds are constant per feature, so grouping by them groups by feature
    return cells.groupBy("feature", *edges).agg(
        F.count_if(_outside()).alias("outliers"),
        (F.count_if(_outside()) / F.count("*") * 100).alias("outlier_pct"))


def _dense_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Whole-number columns with at least ROWS_PER_BUCKET values for each bucket that they span (or one bucket)."""
    whole = [f.name for f in df.schema.fields if f.name in set(columns) and isinstance(f.dataType, T.IntegralType)]
    if not whole:
        return []
    ends = df.selectExpr(*[f"struct(count({quoted(c)}), min({quoted(c)}), max({quoted(c)})) AS c{i}" for i, c in enumerate(whole)]).first()
    return [c for c, (n, low, high) in zip(whole, ends) if n and (high // BUCKET - low // BUCKET + 1) * ROWS_PER_BUCKET <= max(n, ROWS_PER_BUCKET)]


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, distinct_values) of numeric columns: exact, NULL not counted.

    Whole numbers that lie close are marked in bitmaps, a bit for each value and 4 KB for 32,768 of them, and the
    bitmaps are merged; the others' distinct values are shuffled.
    """
    dense = _dense_columns(df, columns)
    loose, found = [c for c in columns if c not in dense], None
    if loose:
        values = unpivoted(df, loose).where(F.col("value").isNotNull()).distinct()
        found = values.groupBy("feature").agg(F.count("*").alias("distinct_values"))
    if dense:
        cells = ", ".join(f"CAST({quoted(c)} AS BIGINT)" for c in dense)
        listed = df.selectExpr(f"posexplode(array({cells})) AS (place, value)").where("value IS NOT NULL")
        bitmaps = listed.groupBy("place", F.bitmap_bucket_number("value").alias("bucket")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("value")).alias("bits"))
        counts = bitmaps.groupBy("place").agg(F.sum(F.bitmap_count("bits")).alias("distinct_values"))
        marked = counts.selectExpr(f"get(array({', '.join(map(text, dense))}), place) AS feature", "distinct_values")
        found = marked if found is None else found.unionByName(marked)
    return found


def skew_report(df: DataFrame, k: int | None = 20, label: str = LABEL) -> DataFrame:
    """(feature, skewness) of the numeric columns, largest absolute skew first."""
    columns = numeric_columns(df, exclude=(label,))
    skews = unpivoted(df, columns).groupBy("feature").agg(sample_skewness("value").alias("skewness"))
    ordered = skews.orderBy(F.abs("skewness").desc_nulls_last(), "feature")
    return ordered if k is None else ordered.limit(k)


def decision(label: str = LABEL) -> Column:
    """What to do with a column, from its report row; the first rule that holds."""
    feature, pct = F.col("feature"), F.col("outlier_pct")
    return (F.when(feature == label, "Target")
            .when(feature.startswith("SK_ID"), "Ignore (ID)")
            .when(F.col("distinct_values") <= 2, "Binary")
            .when(feature == "DAYS_EMPLOYED", "Replace sentinel")
            .when(pct < 5, "Keep").when(pct < 20, "Review").otherwise("Investigate"))


def column_report(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Outlier %, skew, missing %, min, max, distinct values and decision per numeric column."""
    columns = numeric_columns(df)
    bounds = F.broadcast(bounds_table(df.sparkSession, fit_iqr_bounds(df, columns)))
    cells = unpivoted(df, columns).join(bounds, "feature")
    measured = cells.groupBy("feature").agg(
        hundredths(F.count_if(_outside()) / F.count("*") * 100).alias("outlier_pct"),
        hundredths(sample_skewness("value")).alias("skewness"),
        hundredths(F.count_if(F.col("value").isNull()) / F.count("*") * 100).alias("missing_pct"),
        F.min("value").alias("min"), F.max("value").alias("max"))
    report = measured.join(distinct_counts(df, columns), "feature", "left").withColumn(
        "distinct_values", F.coalesce("distinct_values", F.lit(0)))
    return report.withColumn("decision", decision(label)).orderBy(F.desc("outlier_pct"), "feature")


def box_stats(df: DataFrame, columns: Sequence[str], label: str = LABEL) -> DataFrame:
    """Per label and feature: quartiles, whiskers at the last values inside the fences, outliers."""
    points = quantiles(df, columns, (0.25, 0.5, 0.75), by=label)
    label_type = df.schema[label].dataType.simpleString()
    boxes = df.sparkSession.createDataFrame(
        [(group, c, *q, *fences(q[0], q[2])) for (group, c), q in points.items()],
        f"`{label}` {label_type}, feature string, q1 double, median double, q3 double, "
        "lower_bound double, upper_bound double")
    value, inside = F.col("value"), ~_outside()
    cells = unpivoted(df, columns, [label]).where(value.isNotNull()).join(F.broadcast(boxes), [label, "feature"])
    return cells.groupBy(label, "feature", "q1", "median", "q3").agg(
        F.least(F.min(F.when(inside, value)), F.col("q1")).alias("low_whisker"),
        F.greatest(F.max(F.when(inside, value)), F.col("q3")).alias("high_whisker"),
        F.count_if(_outside()).alias("outliers"))


# --- clipping -------------------------------------------------------------------------------

def binary_columns(df: DataFrame) -> list[str]:
    """Columns of any type with at most two distinct values: those all equal to their min or max."""
    names = df.columns
    ends = df.selectExpr(*[f"{f}({quoted(c)}) AS {f}{i}" for i, c in enumerate(names) for f in ("min", "max")]).first()
    inner = [F.count_if(~F.col(quoted(c)).isin(F.lit(ends[f"min{i}"]), F.lit(ends[f"max{i}"]))).alias(f"b{i}")
             for i, c in enumerate(names)]
    between = df.select(*inner).first()
    return [c for i, c in enumerate(names) if not between[f"b{i}"]]


def columns_to_clip(train: DataFrame, key: str = ID, label: str = LABEL) -> list[str]:
    """Numeric columns but the key, the label, two-valued ones, days and months."""
    names = train.columns
    return without(numeric_columns(train), [key, label], binary_columns(train), day_columns(names),
                   month_columns(names))


def clip_to_bounds(df: DataFrame, bounds: dict[str, tuple], columns: Sequence[str]) -> DataFrame:
    """Clamp the columns to train bounds; columns absent from ``df`` are skipped."""
    chosen = set(columns)

    def clamped(c):
        v, (low, high) = f"CAST({quoted(c)} AS DOUBLE)", map(number, bounds[c][2:4])
        return f"CASE WHEN {quoted(c)} IS NOT NULL THEN greatest(least({v}, {high}), {low}) END AS {quoted(c)}"
    return df.selectExpr(*[clamped(c) if c in chosen else quoted(c) for c in df.columns])
