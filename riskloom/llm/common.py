"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import gc

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.session import stage, staged_path, unstage

#: stands for a missing id while rows are ordered or joined; it sorts after every real id
NO_ID = 2**63 - 1
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: a word: everything but space and tab .. carriage return
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def small_batches(spark: SparkSession) -> None:
    """Hand Python at most 2,000 rows or 16 MB at a time, as texts may be long (a setting of the session)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "16m")


def whole_text(name: str) -> Column:
    """The text of a row; null counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and return a scan of it.

    The shuffle files of the finished job are let go: Spark's cleaner drops them once
    the driver has collected the objects that stand for them.
    """
    scan = stage(df, label)
    release(df.sparkSession)
    return scan


def noted(df: DataFrame, label: str) -> DataFrame:
    """``written`` for a small table, such as the state of an iteration, with no cleaning after it."""
    return stage(df, label)


def release(spark: SparkSession) -> None:
    gc.collect()
    spark.sparkContext._jvm.System.gc()


class Scratch:
    """Tables of an iteration that are deleted once the round after the next no longer reads them."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.paths: list[str] = []

    def keep(self, df: DataFrame, label: str) -> DataFrame:
        path = staged_path(self.spark, label)
        df.write.parquet(path)
        self.paths.append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def forget(self, paths: list[str]) -> None:
        for path in paths:
            unstage(self.spark, path)
        self.paths = [p for p in self.paths if p not in paths]
