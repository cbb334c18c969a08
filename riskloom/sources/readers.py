"""Scans of the raw, assembled and scoring tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.selectors import float_columns, string_columns
from ..functions.sqltext import quoted, text
from .schemas import SOURCES

# The texts a CSV field may hold for "missing"; XNA and XAP are values.
MISSING_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
                  "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def normalize_missing(df: DataFrame, tokens=MISSING_TOKENS) -> DataFrame:
    """Missing-value texts and NaN become NULL; one projection, no shuffle."""
    texts, floats = set(string_columns(df)), set(float_columns(df))

    listed = ", ".join(map(text, tokens))

    def clean(name):
        c = quoted(name)
        if name in texts:
            return f"CASE WHEN {c} NOT IN ({listed}) THEN {c} END AS {c}"
        return f"nanvl({c}, NULL) AS {c}" if name in floats else c

    return df.selectExpr(*[clean(c) for c in df.columns])


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
             tokens=MISSING_TOKENS) -> DataFrame:
    """Read a CSV with a header by column name.

    The file may hold more columns than the schema and in another order. Fields are
    read as text and cast, so every missing-value text is NULL in every type; text that
    is no number at all fails the job rather than turning into NULL unseen.
    Columns without an entry in the schema are dropped; schema columns that the file
    lacks are left out (see ``scoring.pad_columns``). Without a schema all are strings.
    """
    raw = spark.read.option("header", True).option("quote", '"').option("escape", '"').csv(path)
    raw = normalize_missing(raw, tokens)
    if schema is None:
        return raw
    present = set(raw.columns)
    return raw.select([_typed(f) for f in schema.fields if f.name in present])


def _typed(field: T.StructField):
    c = F.col(field.name)
    if isinstance(field.dataType, T.StringType):
        return c
    if isinstance(field.dataType, T.IntegralType):
        # an integer column that had gaps is written as 8.0; a double on the way would change ids above 2^53
        exact = c.try_cast("decimal(38,10)")
        fault = F.raise_error(F.concat(F.lit(f"{field.name} holds no whole number: "), c)).cast("bigint")
        whole = F.coalesce(c.try_cast("bigint"), F.when(c.isNotNull(), F.when(
            exact == F.floor(exact), exact.cast("bigint")).otherwise(fault)))
        return whole.cast(field.dataType).alias(field.name)
    return c.cast(field.dataType).alias(field.name)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet unless the path says CSV; missing markers normalised either way."""
    if path.rstrip("/").endswith(".csv"):
        return read_csv(spark, path, schema)
    df = spark.read.parquet(path)
    if schema is not None:
        df = df.select([f.name for f in schema.fields if f.name in df.columns])
    return normalize_missing(df)


def stream_table(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "csv", files: int | None = None) -> DataFrame:
    """Files of a folder as they come. CSV files have a header with the schema's columns in its order; others fail the job."""
    reader = spark.readStream if files is None else spark.readStream.option("maxFilesPerTrigger", files)
    if fmt == "parquet":
        return normalize_missing(reader.schema(schema).parquet(path))
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    raw = reader.schema(texts).option("header", True).option("enforceSchema", False).option("quote", '"').option("escape", '"').csv(path)
    return normalize_missing(raw).select([_typed(f) for f in schema.fields])


def load_sources(spark: SparkSession, folder: str, fmt: str = "csv", schemas=None) -> dict[str, DataFrame]:
    """The eight raw tables of ``folder`` by name."""
    return {name: read_table(spark, f"{folder.rstrip('/')}/{name}.{fmt}", schema)
            for name, schema in (schemas or SOURCES).items()}
