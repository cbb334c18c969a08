"""Codes for the texts of a table, as a table: fitted, kept and applied without the driver seeing a text.

Distinct texts are range-partitioned and sorted by (column, text). A text's code is its place in its partition plus
the number of the column's texts in earlier partitions, so codes are dense and in text order, and a row for each
column and partition is all that is brought together.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.joins import join_rollup
from ..functions.selectors import ID
from ..functions.sqltext import quoted, text
from ..session import stage, staged_path

#: a column's texts are broadcast up to this many bytes, joined by a shuffle beyond it
BROADCAST_BYTES = 8 << 20
SCHEMA = "value string, code long, feature string"


def text_cells(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., feature, value) for every text that isn't null."""
    pairs = ", ".join(f"struct({text(c)} AS feature, {quoted(c)} AS value)" for c in columns)
    return df.selectExpr(*map(quoted, keep), f"inline(array({pairs}))").where("value IS NOT NULL")


@dataclass
class Dictionary:
    """``path`` holds (value, code) in a folder for each column; ``sizes`` and ``widths`` the texts and their bytes by column."""

    path: str
    sizes: dict[str, int]
    widths: dict[str, int]

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(SCHEMA).parquet(self.path)

    def of(self, spark: SparkSession, column: str) -> DataFrame:
        """(value, code) of one column; the scan opens that column's files only."""
        return self.table(spark).where(F.col("feature") == column).select("value", "code")

    def values(self, spark: SparkSession, columns: Sequence[str]) -> dict[str, list[str]]:
        """All texts of the columns, on the driver: for what makes one column of each text."""
        found: dict[str, list[str]] = {c: [] for c in columns}
        for r in self.table(spark).where(F.col("feature").isin(*columns)).orderBy("feature", "code").collect() if columns else []:
            found[r["feature"]].append(r["value"])
        return found

    def copied(self, spark: SparkSession, path: str) -> "Dictionary":
        self.table(spark).write.mode("overwrite").partitionBy("feature").parquet(path)
        return Dictionary(path, self.sizes, self.widths)


def fit_dictionary(df: DataFrame, columns: Sequence[str], path: str | None = None) -> Dictionary:
    """Codes 0, 1, ... of the distinct texts of each column, in text order; NULL has none.

    Copies are dropped before the shuffle. An empty table, or a column without texts, has no codes.
    """
    spark, columns = df.sparkSession, list(columns)
    path = path or staged_path(spark, "dictionary")
    if not columns:
        return Dictionary(path, {}, {})
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = text_cells(df, columns).distinct().repartitionByRange(parts, "feature", "value").sortWithinPartitions("feature", "value")
    placed = stage(ordered.select("feature", "value", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place")),
                   "dictionary-places")
    blocks = placed.groupBy("feature", "part").agg(
        F.count("*").alias("n"), F.min("place").alias("first"), F.sum(F.octet_length("value")).alias("bytes"))
    before = Window.partitionBy("feature").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # a row for each column and partition that holds texts of it: at most columns + partitions
    blocks = stage(blocks.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")), "dictionary-blocks")
    coded = placed.join(F.broadcast(blocks.select("feature", "part", "base")), ["feature", "part"])
    coded.select("value", (F.col("place") + F.col("base")).alias("code"), "feature").write.mode("overwrite").partitionBy("feature").parquet(path)
    sizes = {r["feature"]: (r["n"], r["bytes"]) for r in blocks.groupBy("feature").agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes")).collect()}
    return Dictionary(path, *({c: sizes.get(c, (0, 0))[i] for c in columns} for i in (0, 1)))


def encode(df: DataFrame, dictionary: Dictionary, columns: Sequence[str], spread_by: str = ID) -> DataFrame:
    """Replace the texts of the columns by their codes; NULL and unknown texts become NULL.

    A column with few bytes of texts is looked up by broadcast. Beyond that rows are joined by a shuffle in which hot
    texts, and rows without a text, are dealt out by ``spread_by``.
    """
    spark, names = df.sparkSession, df.columns
    for c in columns:
        if not dictionary.sizes.get(c):
            df = df.withColumn(c, F.lit(None).cast("long"))
            continue
        codes = dictionary.of(spark, c).withColumnsRenamed({"value": c, "code": "__code"})
        if dictionary.widths[c] + 8 * dictionary.sizes[c] <= BROADCAST_BYTES:
            df = df.join(F.broadcast(codes), c, "left")
        elif df.isStreaming:    # hot texts of a stream aren't known beforehand
            df = df.join(codes, c, "left")
        else:
            df = join_rollup(df, codes, c, spread_by, "left")
        df = df.drop(c).withColumnRenamed("__code", c)
    return df.select(*map(quoted, names))
