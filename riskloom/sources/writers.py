"""Sinks: datasets, column-name lists, split, small result tables."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.sqltext import quoted, text

NAMES_SCHEMA = "ordinal int, feature string"


def write_dataset(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.parquet(path)


def feature_names(df: DataFrame) -> DataFrame:
    """The table's own column names in order."""
    return df.sparkSession.createDataFrame(list(enumerate(df.columns)), NAMES_SCHEMA)


def write_split(df: DataFrame, path: str) -> None:
    """One folder per split value, so a reader of one split scans only its files."""
    df.write.mode("overwrite").partitionBy("split").parquet(path)


def read_split(spark: SparkSession, path: str, *splits: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = reader.parquet(path)
    return df.where(F.col("split").isin(*splits)) if splits else df


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int) -> None:
    """A table whose files are dealt by the key's hash and sorted by it: one file for each of ``buckets``.

    Joins and groupings by the key of tables with as many buckets then need no shuffle. What ``read_bucketed`` must know lies in a
    folder beside the files that table scans leave out.
    """
    spark = df.sparkSession
    (df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
     .option("path", path).format("parquet").saveAsTable(_bucketed_name(path)))
    spark.createDataFrame([(key, buckets, df.schema.toDDL())], "key string, buckets int, columns string").coalesce(1).write.mode(
        "overwrite").parquet(f"{path}/_bucketing")


def read_bucketed(spark: SparkSession, path: str) -> DataFrame:
    """The scan of such a table, in the session that wrote it or any other."""
    made, name = spark.read.parquet(f"{path}/_bucketing").first(), _bucketed_name(path)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({made['columns']}) USING parquet CLUSTERED BY ({quoted(made['key'])}) "
              f"SORTED BY ({quoted(made['key'])}) INTO {made['buckets']} BUCKETS LOCATION {text(path)}")
    return spark.table(name)


def _bucketed_name(path: str) -> str:
    return f"bucketed_{hashlib.md5(path.rstrip('/').encode()).hexdigest()}"


def exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)
