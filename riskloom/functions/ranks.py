"""Running totals and tie-averaged ranks over a global order, spread over value ranges.

A window without partition keys runs in one task. Values are instead cut into ranges at
fixed points (literals, so a recomputed task cuts alike), totalled per range, and the
totals of the earlier ranges are added to the running sum inside each range.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import stage
from .quantiles import INF, unpivoted
from .sketches import column_sketches, quantile_array, sketch
from .sqltext import as_double, literal, quoted, text

#: rows of a range, and size of the sketch that finds the cuts
ROWS_PER_RANGE, SKETCH = 1_000_000, 4000

Cuts = dict[str, list[float]]


def _cuts(spark: SparkSession, sketches: Callable[[int], DataFrame], group: Sequence[str], rows_per_range: int) -> dict[tuple, list[float]]:
    """{group: cuts} by the sketches of a given size; they also tell how many ranges there should be."""
    fewest = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))

    def sketched(parts):
        shares = [i / parts for i in range(1, parts)]
        return sketches(min(65_535, max(SKETCH, 10 * parts))).select(
            *group, "n", quantile_array("sketch", shares).alias("at")).collect()
    rows = sketched(fewest)
    parts = math.ceil(max((r["n"] for r in rows), default=0) / rows_per_range)
    if parts > fewest:
        rows = sketched(parts)
    return {tuple(r[g] for g in group): sorted({x for x in r["at"] or [] if abs(x) != INF}) for r in rows}


def cut_points(df: DataFrame, columns: Sequence[str], rows_per_range: int = ROWS_PER_RANGE) -> Cuts:
    """Approximate quantile cuts per column; balance depends on them, results do not.

    There are at least as many ranges as shuffle partitions, and enough for ``rows_per_range`` rows each.
    """
    found = _cuts(df.sparkSession, lambda k: column_sketches(df, columns, [], k), ["feature"], rows_per_range)
    return {c: found.get((c,), []) for c in columns}


def grouped_cells(df: DataFrame, value: str, by: Sequence[str], keep: Sequence[str],
                  rows_per_range: int = ROWS_PER_RANGE) -> tuple[DataFrame, Cuts]:
    """(keep..., by..., range, value) with cuts of each group's own, and the cuts by number of the group.

    A group whose values lie close together is cut as finely as any other. There are few groups, such as models.
    """
    by, keep = list(by), list(keep)
    rows = df.selectExpr(*map(quoted, [*keep, *by]), as_double(value, "value")).where("value IS NOT NULL")
    groups = _cuts(df.sparkSession, lambda k: sketch(rows, by, k), by, rows_per_range)
    cuts = {f"v{i}": at for i, at in enumerate(groups.values())}
    if not any(cuts.values()):
        return rows.withColumn("range", F.lit(0.0)), {}

    def member(key):
        return F.expr(" AND ".join(f"{quoted(b)} <=> {literal(k)}" for b, k in zip(by, key)) or "true")
    of_group = rows.select("*", *[F.when(member(key), F.col("value")).alias(f"v{i}") for i, key in enumerate(groups)])
    cutter = Bucketizer(splitsArray=[[-INF, *(at or [0.0]), INF] for at in cuts.values()], handleInvalid="keep",
                        inputCols=list(cuts), outputCols=[f"r{i}" for i in range(len(cuts))])
    # "keep" gives a row its group's range, and for the other groups' columns the range behind the last
    ranges = [F.when(member(key), F.col(f"r{i}")) for i, key in enumerate(groups)]
    return cutter.transform(of_group).select(*keep, *by, F.coalesce(*ranges).alias("range"), "value"), cuts


def range_cells(df: DataFrame, columns: Sequence[str], keep: Sequence[str], cuts: Cuts) -> DataFrame:
    """(keep..., feature, range, value) for every non-null cell."""
    columns = list(columns)
    if not any(cuts.get(c) for c in columns):
        cells = unpivoted(df, columns, keep).withColumn("range", F.lit(0.0))
        return cells.where(F.col("value").isNotNull())
    kept = [quoted(k) for k in keep]
    values = df.selectExpr(*kept, *[as_double(c, f"v{i}") for i, c in enumerate(columns)])
    cutter = Bucketizer(
        splitsArray=[[-INF, *(cuts.get(c) or [0.0]), INF] for c in columns], handleInvalid="keep",
        inputCols=[f"v{i}" for i in range(len(columns))], outputCols=[f"r{i}" for i in range(len(columns))])
    cells = ", ".join(f"struct({text(c)} AS feature, r{i} AS range, v{i} AS value)" for i, c in enumerate(columns))
    return cutter.transform(values).selectExpr(*kept, f"inline(array({cells}))").where("value IS NOT NULL")


def running_counts(cells: DataFrame, group: Sequence[str], sums: dict[str, str], others: dict[str, str] | None = None,
                   cuts: Cuts | None = None) -> DataFrame:
    """One row per (group, value) with the aggregates ``sums`` and ``others`` (name -> SQL) and, for
    every sum, ``<sum>_before``: its total over the smaller values of the group.

    A value held by a third of all rows is a single row here, counted before the shuffle.
    """
    def aggregates(named):
        return [F.expr(f"{sql} AS {name}") for name, sql in named.items()]
    counts = cells.groupBy(*group, "range", "value").agg(*aggregates({**sums, **(others or {})}))
    if cuts:
        counts = stage(counts, "counts")    # read for the running sums and for the range totals: cells are made once
    inner = Window.partitionBy(*group, "range").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    within = counts.select("*", *[F.coalesce(F.sum(s).over(inner), F.lit(0)).alias(f"{s}_before") for s in sums])
    if not cuts:
        return within       # a single range
    outer = Window.partitionBy(*group).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    totals = counts.groupBy(*group, "range").agg(*[F.sum(s).alias(s) for s in sums])     # one row per range
    earlier = totals.select(*[F.col(g).alias(f"_{g}") for g in [*group, "range"]], *[
        F.coalesce(F.sum(s).over(outer), F.lit(0)).alias(f"{s}_earlier") for s in sums])
    same = [F.col(g).eqNullSafe(F.col(f"_{g}")) for g in [*group, "range"]]
    return within.join(earlier, same).select(
        *counts.columns, *[(F.col(f"{s}_before") + F.col(f"{s}_earlier")).alias(f"{s}_before") for s in sums])


def average_rank(n: str = "n"):
    """Rank shared by the ``n`` tied rows of a value."""
    return F.col(f"{n}_before") + (F.col(n) + 1) / 2
