"""Join of a fact side to a per-key rollup that survives a hot key on the fact side.

Adaptive execution splits a skewed partition only when a shuffle sits right below both
join inputs; a rollup's final aggregate stands in between, so the split is done here.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def hot_keys(df: DataFrame, key: str) -> DataFrame:
    """(hot): keys with more rows than a shuffle partition's fair share, found when the plan runs.

    There are at most as many as shuffle partitions, so the table may be broadcast. The sketch of frequent items
    is summed up by task; its counts choose the plan, never the result.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tracked = F.lit(min(100_000, 16 * parts))
    most = df.where(F.col(key).isNotNull()).agg(
        F.call_function("approx_top_k", F.col(key), F.lit(parts), tracked).alias("top"), F.count("*").alias("n"))
    return most.select(F.explode("top").alias("item"), "n").where(
        F.col("item.count") * parts > F.col("n")).select(F.col("item.item").alias("hot"))


def join_rollup(facts: DataFrame, rollup: DataFrame, key: str, spread_by: str, how: str = "inner", salts: int = 64,
                hot: DataFrame | None = None) -> DataFrame:
    """Join ``facts`` to ``rollup`` (one row per key), spreading hot keys, and facts without one, over ``salts`` tasks.

    Only the rollup rows of hot keys are repeated, so the extra volume is at most ``salts`` rows for each.
    """
    hot = F.broadcast(hot_keys(facts, key) if hot is None else hot)
    is_hot = F.col("hot").isNotNull()
    salt = F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int")
    left = facts.join(hot, F.col(key) == F.col("hot"), "left").withColumn("_salt", F.when(is_hot | F.col(key).isNull(), salt).otherwise(0)).drop("hot")
    every = F.sequence(F.lit(0), F.lit(salts - 1))
    right = rollup.join(hot, F.col(key) == F.col("hot"), "left").withColumn(
        "_salt", F.explode(F.when(is_hot, every).otherwise(F.array(F.lit(0))))).drop("hot")
    return left.join(right, [key, "_salt"], how).drop("_salt")


def _rolled_apart(rows: DataFrame, key: str, roll: Callable[[DataFrame], DataFrame], hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``roll`` of the rows of ``hot`` keys, summed before they are moved, and of all others, moved as they are."""
    is_hot = F.col(key) == F.col("hot")
    return roll(rows.join(hot, is_hot, "left_semi")), roll(rows.join(hot, is_hot, "left_anti").repartition(key))


def rolled_up(rows: DataFrame, key: str, roll: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``roll(rows)``, one row per ``key`` and partitioned by it, for many sums over few rows of a key.

    Sums made before the shuffle are several times as wide as a row and save little where a task holds hardly two rows of a
    key, which is the more so the larger the table. Rows are moved as they are instead; only those of hot keys (few, see
    ``hot_keys``) are summed first. A union keeps the partitioning that both its sides have.
    """
    few, rest = _rolled_apart(rows, key, roll, F.broadcast(hot_keys(rows, key)))
    return rest.unionByName(few)


def join_rolled(facts: DataFrame, rows: DataFrame, key: str, roll: Callable[[DataFrame], DataFrame], hot: DataFrame) -> DataFrame:
    """Inner join of ``facts`` to ``rolled_up`` rows; facts are moved once as well.

    What comes of the rows of ``hot`` keys, those of either side, is broadcast, so their facts stay where they are.
    """
    hot = F.broadcast(hot)
    is_hot = F.col(key) == F.col("hot")
    few, rest = _rolled_apart(rows, key, roll, hot)
    return facts.join(hot, is_hot, "left_anti").join(rest, key).unionByName(
        facts.join(hot, is_hot, "left_semi").join(F.broadcast(few), key))
