"""Sketches of many columns at once, merged in two levels so that no task takes in all of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sqltext import quoted, text


def rank_error(k: int) -> float:
    """Share of the rows by which a sketch of size ``k`` may miss a rank (99 % of the time less)."""
    return min(0.5, 2.296 / k**0.9021)


def sketch(cells: DataFrame, group: Sequence[str], k: int, counts: dict | None = None) -> DataFrame:
    """(group..., n, sketch, counts...) over the column ``value``; NULL values are not in the sketch.

    Map tasks sketch their own rows; as many groups of tasks as there are shuffle partitions are merged
    first, and their sketches, one for each group of tasks, then.
    """
    spark, extra = cells.sparkSession, dict(counts or {})
    fan = int(spark.conf.get("spark.sql.shuffle.partitions"))
    by_task = cells.withColumn("_task", F.pmod(F.spark_partition_id(), F.lit(fan))).groupBy(*group, "_task").agg(
        F.count("value").alias("n"), F.kll_sketch_agg_double("value", F.lit(k)).alias("sketch"),
        *[c.alias(name) for name, c in extra.items()])
    return by_task.groupBy(*group).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"),
                                       *[F.sum(name).alias(name) for name in extra])


def column_sketches(df: DataFrame, columns: Sequence[str], group: Sequence[str], k: int) -> DataFrame:
    """(group..., feature, n, sketch) of several columns, merged as in ``sketch``.

    A row updates the sketches of its columns where it lies; it is not made into a row for each cell.
    """
    fan, columns = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), list(columns)
    values = df.selectExpr(*map(quoted, group), *[f"CAST({quoted(c)} AS DOUBLE) AS v{i}" for i, c in enumerate(columns)])
    by_task = values.withColumn("_task", F.pmod(F.spark_partition_id(), F.lit(fan))).groupBy(*group, "_task").agg(
        *[F.expr(f"count(v{i}) AS n{i}") for i in range(len(columns))],
        *[F.expr(f"kll_sketch_agg_double(v{i}, {k}) AS s{i}") for i in range(len(columns))])
    cells = ", ".join(f"struct({text(c)} AS feature, n{i} AS n, s{i} AS sketch)" for i, c in enumerate(columns))
    return by_task.selectExpr(*map(quoted, group), f"inline(array({cells}))").groupBy(*group, "feature").agg(
        F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"))


def quantile_array(sketched: str, shares: Sequence[float]):
    """Values at the given shares of the rows; NULL where no value was sketched (column ``n``)."""
    wanted = F.array(*[F.lit(float(min(1.0, max(0.0, s)))) for s in shares])
    return F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double(sketched, wanted))
