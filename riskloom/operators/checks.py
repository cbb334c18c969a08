"""Data checks: required columns, unique keys, unchanged row counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def require_columns(df: DataFrame, *names: str) -> None:
    """Fail before any job runs when a key column is absent."""
    absent = [n for n in names if n not in df.columns]
    if absent:
        raise ValueError(f"missing columns: {', '.join(absent)}")


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")


def key_report(tables: dict[str, DataFrame], key: str) -> DataFrame:
    """Per table: rows, distinct keys and whether the key is unique."""
    reports = [
        df.groupBy(key).agg(F.count("*").alias("n")).agg(
            F.lit(name).alias("table_name"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
            F.count("*").alias("key_count"),
            F.coalesce(F.max("n") <= 1, F.lit(True)).alias("is_unique"))
        for name, df in tables.items()
    ]
    report = reports[0]
    for other in reports[1:]:
        report = report.unionByName(other)
    return report


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) of each table; used to see that a left join kept its rows."""
    report = None
    for name, df in tables.items():
        one = df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        report = one if report is None else report.unionByName(one)
    return report


def watch(df: DataFrame, key: str, place: str, watched: dict[str, Observation] | None, split: str | None = None) -> DataFrame:
    """``df``, its rows and keys counted by whatever job runs over it; no scan of its own. ``watched`` gets the counts.

    ``split`` names a column whose values train and test are counted apart, where the table has it.
    """
    if watched is None:
        return df
    watched[place] = Observation()
    parts = [F.count_if(F.col(split) == v).alias(v) for v in ("train", "test")] if split in df.columns else []
    return df.observe(watched[place], F.count(F.lit(1)).alias("row_count"), F.count(key).alias("key_rows"),
                      F.sum(F.col(key).cast("decimal(38,0)")).alias("key_sum"), *parts)


def watched_report(spark: SparkSession, watched: dict[str, Observation]) -> DataFrame:
    """(place, row_count, key_rows, key_sum), a row for each watched place, once the job has run.

    A left join keeps its rows if what comes out has the rows, keys and sum of keys of the left side.
    """
    rows = [(place, *(seen.get.get(c) for c in ("row_count", "key_rows", "key_sum"))) for place, seen in watched.items()]
    return spark.createDataFrame(rows, "place string, row_count long, key_rows long, key_sum decimal(38,0)")


def assert_kept(before: Observation, after: Observation, what: str) -> None:
    """Fail if a join lost, repeated or exchanged rows of its left side, by the counts of both."""
    if before.get != after.get:
        raise ValueError(f"{what}: {before.get} became {after.get}")


def assert_unique(df: DataFrame, key: str, what: str) -> None:
    if not repeated_keys(df, key).isEmpty():
        raise ValueError(f"{what}: {key} is not unique")
