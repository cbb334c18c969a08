"""Exact, linearly interpolated quantiles of many columns without a one-task sort.

``percentile`` would hold every distinct value of a column in one task. Here a sketch, merged in two
levels, first brackets each wanted rank, then only the values inside the brackets are counted and
ordered; everything below a bracket collapses to one count on the map side. This is the path at every size.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage
from .sketches import column_sketches, quantile_array, rank_error, sketch
from .sqltext import literal, number, quoted, text

INF = float("inf")
Result = dict[tuple[object, str], list[float | None]]


def unpivoted(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., feature, value) with one row per cell; values as doubles, NULL kept."""
    kept, names = [quoted(k) for k in keep], ", ".join(text(c) for c in columns)
    cells = ", ".join(f"CAST({quoted(c)} AS DOUBLE)" for c in columns)
    listed = df.selectExpr(*kept, f"posexplode(array({cells})) AS (place, value)")
    return listed.selectExpr(*kept, f"get(array({names}), place) AS feature", "value")


def interpolate(low: float, high: float, t: float) -> float | None:
    """Point between two neighbours; an undefined difference of infinities is None."""
    gap = high - low
    value = low + gap * t if t < 0.5 else high - gap * (1 - t)
    return None if math.isnan(value) else value


def quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: str | None = None,
              accuracy: int = 4000, exact_rows: int = 1_000_000) -> Result:
    """``{(group, column): [value per probability]}``; None for a column without values.

    ``by`` names a column with few values (a label). A sketch of size ``accuracy`` brackets every rank;
    a bracket that may hold more than ``exact_rows`` values is sketched again inside itself, as often as it
    takes; then the values inside are counted and ordered. Should a bracket miss its rank, it is widened.
    """
    columns = list(columns)
    if not columns:
        return {}
    source = df.where(F.col(by).isNotNull()) if by else df
    group, error = ([by] if by else []), rank_error(accuracy)
    edges = [e for p in probs for e in (p - 2 * error, p + 2 * error)]
    first = column_sketches(source, columns, group, accuracy).select(
        *group, "feature", "n", quantile_array("sketch", edges).alias("edges")).collect()
    rows = {(r[by] if by else None, r["feature"]): r for r in first}
    sizes = {key: r["n"] for key, r in rows.items()}
    if not by:
        sizes = {(None, c): sizes.get((None, c), 0) for c in columns}

    ranks = {key: [(n - 1) * p for p in probs] for key, n in sizes.items() if n}
    bands: dict[tuple, set] = {}
    for key, positions in ranks.items():
        for i, x in enumerate(positions):
            low, high = rows[key]["edges"][2 * i:2 * i + 2]
            # the two rows beside a position may lie beyond the edges where rows are few
            band = (*key, -INF if edges[2 * i] <= 2 / sizes[key] else low, INF if edges[2 * i + 1] >= 1 - 2 / sizes[key] else high)
            bands.setdefault(band, set()).update((math.floor(x), math.ceil(x)))
    found: dict[tuple[tuple[object, str], int], float] = {}
    todo = [(*band, sorted(ks)) for band, ks in bands.items()]
    wide = max(sizes.values(), default=0) * 4 * error > exact_rows
    while todo:
        found.update(_select(source, by, _narrow(source, by, todo, accuracy, exact_rows) if wide else todo))
        # a sketch can be wrong by more than its error: such a rank is looked for among all values
        todo = [(g, c, -INF, INF, left) for g, c, _, _, ks in todo if (left := [k for k in ks if ((g, c), k) not in found])]
        wide = any(sizes[g, c] > exact_rows for g, c, *_ in todo)

    def at(key, x):
        return interpolate(found[key, math.floor(x)], found[key, math.ceil(x)], x - math.floor(x))
    return {key: [at(key, x) for x in ranks[key]] if n else [None] * len(probs) for key, n in sizes.items()}


def _in_bands(source, by, bands):
    """(band, low, value) of the values up to the upper end of each band."""
    group = [by] if by else []
    rows = [((g,) if by else ()) + (c, i, low, high) for i, (g, c, low, high, _) in enumerate(bands)]
    by_type = f"`{by}` {source.schema[by].dataType.simpleString()}, " if by else ""
    # one row per group, column and wanted rank: small whatever the data
    edges = F.broadcast(source.sparkSession.createDataFrame(rows, f"{by_type}feature string, band int, low double, high double"))
    cells = unpivoted(source, sorted({c for _, c, *_ in bands}), group).where(F.col("value").isNotNull())
    return cells.join(edges, [*group, "feature"]).where("value <= high").select("band", "low", "value")


def _narrow(source, by, bands, accuracy, exact_rows):
    """Sketch the values inside the wide bands, and shrink those bands around their ranks."""
    error, done, todo = rank_error(accuracy), [], [(*b[:4], [k]) for b in bands for k in b[4]]
    while todo:
        inside = _in_bands(source, by, todo).select(
            "band", F.when(F.col("value") >= F.col("low"), F.col("value")).alias("value"))
        sketched = stage(sketch(inside, ["band"], accuracy, {"below": F.count_if(F.col("value").isNull())}), "bands")
        measured = {r["band"]: (r["n"], r["below"]) for r in sketched.select("band", "n", "below").collect()}
        open_bands, cuts = [], {}
        for i, band in enumerate(todo):
            size, below = measured.get(i, (0, 0))
            rank = band[4][0] - below
            if size <= exact_rows or not 0 <= rank < size:
                done.append(band)
            else:
                cuts[i] = (rank / size - 2 * error, (rank + 1) / size + 2 * error)
        points = F.coalesce(*[F.when(F.col("band") == i, quantile_array("sketch", c)) for i, c in cuts.items()], F.lit(None))
        for r in (sketched.select("band", points.alias("at")).where("at is not null").collect() if cuts else []):
            g, c, low, high, ks = todo[r["band"]]
            at_low, at_high = cuts[r["band"]]
            shrunk = (g, c, low if at_low <= 0 else r["at"][0], high if at_high >= 1 else r["at"][1], ks)
            # ties fill a band that doesn't shrink, or whose ends meet: few distinct values are left in it
            (done if shrunk[2:4] in ((low, high), (shrunk[2], shrunk[2])) else open_bands).append(shrunk)
        todo = open_bands
    return done


def _select(source, by, bands):
    """Order statistics of the bands: {((group, column), rank): value}."""
    # one row per band and wanted rank: small whatever the data
    targets = F.broadcast(source.sparkSession.createDataFrame(
        [(i, k) for i, (*_, ks) in enumerate(bands) for k in ks], "band int, k long"))
    names = {c: f"v{i}" for i, c in enumerate(dict.fromkeys(c for _, c, *_ in bands))}
    values = source.selectExpr(*([quoted(by)] if by else []), *[f"CAST({quoted(c)} AS DOUBLE) AS {v}" for c, v in names.items()])

    def of(band, test):
        g, c, low, high, _ = band
        here = f"{names[c]} {test.format(low=number(low), high=number(high))}"
        return f"{quoted(by)} = {literal(g)} AND {here}" if by else here
    # cells leave their row only inside a band; those below one are counted side by side
    kept = ", ".join(f"CASE WHEN {of(b, 'BETWEEN {low} AND {high}')} THEN named_struct('band', {i}, 'value', {names[b[1]]}) END"
                     for i, b in enumerate(bands))
    inside = values.selectExpr(f"inline(filter(array({kept}), x -> x IS NOT NULL))").groupBy("band", "value").agg(F.count("*").alias("n"))
    below = values.selectExpr(*[f"count_if({of(b, '< {low}')}) AS b{i}" for i, b in enumerate(bands)])
    listed = ", ".join(f"named_struct('band', {i}, 'value', CAST(NULL AS DOUBLE), 'n', b{i})" for i in range(len(bands)))
    counts = inside.unionByName(below.selectExpr(f"inline(array({listed}))"))
    upto = F.sum("n").over(Window.partitionBy("band").orderBy(F.col("value").asc_nulls_first()))
    hits = (counts.withColumn("upto", upto).where("value IS NOT NULL").join(targets, "band")
            .where("upto - n <= k AND k < upto").select("band", "k", "value"))
    return {((bands[r["band"]][0], bands[r["band"]][1]), r["k"]): r["value"] for r in hits.collect()}
