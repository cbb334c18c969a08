"""Spearman rank correlation with the label and between columns."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.quantiles import unpivoted
from ..functions.ranks import ROWS_PER_RANGE, average_rank, cut_points, range_cells, running_counts
from ..functions.selectors import ID, LABEL, numeric_columns
from ..functions.sqltext import as_double, number, quoted, text
from ..session import stage

# A value is looked up through a broadcast table when it holds at least 1/FREQUENT of a
# column's rows; there are at most FREQUENT such values per column.
FREQUENT = 2000
#: pairs of columns whose moments one pass keeps
PAIRS = 512


def spearman_with_label(df: DataFrame, columns: Sequence[str] | None = None, label: str = LABEL,
                        rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """(feature, rho) for a 0/1 label over the rows where both are present.

    Ranks of a two-valued label are a linear map of the label, which leaves the
    correlation as it is: only the feature needs ranking. NULL for a constant side.
    """
    columns = list(columns or numeric_columns(df, exclude=(label,)))
    rows = df.where(F.col(label).isNotNull())
    cuts = cut_points(rows, columns, rows_per_range)
    counts = running_counts(range_cells(rows, columns, [label], cuts), ["feature"], {"n": "count(*)"},
                            {"positives": f"sum({quoted(label)})"}, cuts)
    ranked = counts.withColumn("rank", average_rank())
    sums = ranked.groupBy("feature").agg(
        F.sum("n").alias("n"), F.sum("positives").alias("p"),
        F.sum(F.col("n") * F.col("rank")).alias("r"), F.sum(F.col("n") * F.col("rank") * F.col("rank")).alias("rr"),
        F.sum(F.col("positives") * F.col("rank")).alias("rp"), F.count("*").alias("distinct_values"))
    covariance = F.expr("rp / n - (r / n) * (p / n)")
    scale = F.expr("sqrt((rr / n - (r / n) * (r / n)) * (p / n) * (1 - p / n))")
    rho = F.when((F.col("distinct_values") > 1) & (F.col("p") > 0) & (F.col("p") < F.col("n")),
                 F.try_divide(covariance, scale))
    return sums.select("feature", rho.alias("rho"))


def top_correlated(correlations: DataFrame, k: int = 30) -> DataFrame:
    """The k strongest, undefined last; equal to nine digits counts as tied and goes by name."""
    return correlations.orderBy(F.round(F.abs("rho"), 9).desc_nulls_last(), "feature").limit(k)


def _mask_classes(df: DataFrame, columns: Sequence[str]) -> dict[str, int]:
    """Columns that are NULL in exactly the same rows share a class; eager, tiny results."""
    nulls = df.selectExpr(*[f"count_if({quoted(c)} IS NULL) AS n{i}" for i, c in enumerate(columns)]).first()
    pairs = [(i, j) for i, j in combinations(range(len(columns)), 2) if nulls[i] == nulls[j]]
    pairs = [(i, j) for i, j in pairs if nulls[i]]
    unlike = df.selectExpr("count(*)", *[
        f"count_if(({quoted(columns[i])} IS NULL) <> ({quoted(columns[j])} IS NULL))" for i, j in pairs]).first()
    differ = dict(zip(pairs, unlike[1:]))
    classes: dict[str, int] = {}
    for j, c in enumerate(columns):
        alike = [i for i in range(j) if nulls[i] == nulls[j] and not differ.get((i, j), 0)]
        classes[c] = classes[columns[alike[0]]] if alike else len(set(classes.values()))
    return classes


def spearman_matrix(df: DataFrame, columns: Sequence[str], key: str = ID,
                    rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """(feature_x, feature_y, rho): the strict lower triangle, each pair over its complete rows.

    A column is ranked once per null pattern it can be paired with (not once per pair),
    by a table (feature, value) -> ranks. Frequent values are looked up by broadcast, the
    rest by a shuffle in which no key is hot. Each row then holds its ranks side by side, and
    the moments of all pairs (of up to PAIRS in a pass) are kept in one wide aggregate: a row is never multiplied by the pairs.
    """
    columns = list(columns)
    if len(columns) < 2:
        return df.sparkSession.createDataFrame([], "feature_x string, feature_y string, rho double")
    classes = _mask_classes(df, columns)
    members = {m: next(c for c in columns if classes[c] == m) for m in sorted(set(classes.values()))}
    masks = [f"CAST({quoted(c)} IS NOT NULL AS INT) AS m{m}" for m, c in members.items()]
    sizes = [f"m{m}" for m in members]

    rows = df.selectExpr(quoted(key), *[as_double(c) for c in columns])
    cuts = cut_points(rows, columns, rows_per_range)
    cells = range_cells(rows.selectExpr("*", *masks), columns, sizes, cuts)
    counts = running_counts(cells, ["feature"], {s: f"sum({s})" for s in sizes}, {"n": "count(*)"}, cuts)
    # written once: it is read for the frequent and for the rare values
    lookup = stage(counts.select(
        "feature", "value", "n", F.array(*[average_rank(s) for s in sizes]).alias("ranks")), "ranks")

    pairs = [(i, j) for i in range(len(columns)) for j in range(i)]
    within = sorted({(i, classes[columns[j]]) for p in pairs for i, j in (p, p[::-1])})
    sizes_of = rows.selectExpr("count(*) AS total", *[
        f"count_if({quoted(columns[i])} IS NOT NULL AND {quoted(members[m])} IS NOT NULL) AS n{i}_{m}" for i, m in within]).first()
    total = sizes_of["total"]
    frequent = F.col("n") * FREQUENT >= total
    values = unpivoted(rows, columns, [key]).where(F.col("value").isNotNull())
    common = F.broadcast(lookup.where(frequent).drop("n"))  # <= FREQUENT rows per column
    first = values.join(common, ["feature", "value"], "left")
    rare = (first.where(F.col("ranks").isNull()).drop("ranks")
            .join(lookup.where(~frequent).drop("n"), ["feature", "value"]))
    ranked = first.where(F.col("ranks").isNotNull()).unionByName(rare)

    # at most one entry per column and row
    by_row = ranked.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("feature", "ranks"))).alias("ranks"))
    by_row = by_row.selectExpr(f"array({', '.join(f'try_element_at(ranks, {text(c)})' for c in columns)}) AS ranks")
    place, at_class = {m: columns.index(c) for m, c in members.items()}, {m: k for k, m in enumerate(members)}
    # the rank of column i among the rows that hold it and the columns of class m, less its mean (n + 1) / 2; 0 for other rows
    flat = by_row.selectExpr(*[
        f"CASE WHEN get(ranks, {place[m]}) IS NOT NULL AND get(ranks, {i}) IS NOT NULL THEN get(get(ranks, {i}), {at_class[m]}) - "
        f"{number((sizes_of[f'n{i}_{m}'] + 1) / 2)} ELSE 0D END AS r{i}_{m}" for i, m in within])
    rounds = -(-len(pairs) // PAIRS)
    flat = stage(flat, "row-ranks") if rounds > 1 else flat
    sums = None
    for at in range(rounds):
        some = pairs[at * PAIRS:(at + 1) * PAIRS]
        ranks = [(f"r{i}_{classes[columns[j]]}", f"r{j}_{classes[columns[i]]}") for i, j in some]
        squares = {r: f"v{k}" for k, r in enumerate(sorted({r for xy in ranks for r in xy}))}
        wide = flat.selectExpr(*[f"sum({x} * {y}) AS c{k}" for k, (x, y) in enumerate(ranks)],
                               *[f"sum({r} * {r}) AS {v}" for r, v in squares.items()])
        listed = ", ".join(f"struct({at * PAIRS + k} AS pair, c{k} AS c, {squares[x]} AS vx, {squares[y]} AS vy)"
                           for k, (x, y) in enumerate(ranks))
        one = wide.selectExpr(f"inline(array({listed}))")
        sums = one if sums is None else sums.unionByName(one)
    names = df.sparkSession.createDataFrame([(p, columns[i], columns[j]) for p, (i, j) in enumerate(pairs)],
                                            "pair int, feature_x string, feature_y string")
    return names.join(F.broadcast(sums), "pair", "left").select(
        "feature_x", "feature_y", F.try_divide(F.col("c"), F.sqrt(F.col("vx") * F.col("vy"))).alias("rho"))
