"""Exact stratified train / validation / evaluation split, as a row-wise expression.

Within each label, rows are ordered by a hash of the id and cut at exact counts. Only the
(hash, id) at each cut is looked up, by counting hash prefixes, so the table itself is
neither shuffled nor sorted, and any task computes the same split again after a failure.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.selectors import ID, LABEL
from ..functions.sqltext import quoted
from ..session import stage

SPLITS = ("train", "val", "eval")
_STEP = 3          # hex digits per look-up round: 4096 prefixes


def split_hash(key: str, seed: int) -> Column:
    return F.md5(F.concat_ws("-", F.col(key).cast("string"), F.lit(str(seed))))


def proportional(counts: dict, draws: int) -> dict:
    """Share ``draws`` over the classes by size; leftovers to the largest remainders, then by label."""
    size = sum(counts.values())
    exact = {c: n / size * draws for c, n in counts.items()}
    shares = {c: math.floor(x) for c, x in exact.items()}
    left = draws - sum(shares.values())
    order = sorted(counts, key=lambda c: (-(exact[c] - shares[c]), c))
    return {c: shares[c] + (1 if c in order[:left] else 0) for c in counts}


def split_sizes(counts: dict, holdout: float = 0.30, eval_share: float = 0.50) -> dict:
    """{label: (train, val, eval)} rows: ``holdout`` taken off, then ``eval_share`` of it."""
    rows = sum(counts.values())
    held = math.ceil(holdout * rows)
    train = proportional(counts, rows - held)
    rest = {c: n - train[c] for c, n in counts.items()}
    val = proportional(rest, held - math.ceil(eval_share * held))
    return {c: (train[c], val[c], rest[c] - val[c]) for c in counts}


def _label_counts(df: DataFrame, label: str) -> dict:
    """Rows by label; one entry per class."""
    rows = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n")).collect()
    return {r[label]: r["n"] for r in rows}


def _find_cuts(keys: DataFrame, wanted: set) -> dict:
    """{(label, k): (hash, id, whether the id goes before the cut)} of the k-th row of each label, in (hash, id) order.

    ``keys`` has a row for each id, with its number of rows ``n``. Every round counts by a longer prefix of the hash; it
    ends when a single id is left under each. A cut within an id's rows goes to the nearer end of them.
    """
    spark, kind = keys.sparkSession, keys.schema["label"].dataType.simpleString()
    open_cuts = {cut: ("", cut[1]) for cut in wanted}   # prefix so far, rank below it
    for length in [*range(_STEP, 32, _STEP), 32]:
        asked = spark.createDataFrame(sorted({(lab, p) for (lab, _), (p, _) in open_cuts.items()}, key=str),
                                      f"asked_label {kind}, asked string")
        here = (F.col("label") == F.col("asked_label")) & F.col("hash").startswith(F.col("asked"))
        counted = keys.join(F.broadcast(asked), here).groupBy(
            "label", "asked", F.substring("hash", 1, length).alias("prefix")).agg(
                F.sum("n").alias("n"), F.count("*").alias("ids"), F.min("hash").alias("hash"), F.min("id").alias("id")).collect()
        under: dict = {}
        for row in sorted(counted, key=lambda r: r["prefix"]):
            under.setdefault((row["label"], row["asked"]), []).append(row)
        cuts = {}
        for (lab, k), (prefix, rank) in open_cuts.items():
            for row in under[lab, prefix]:
                if rank <= row["n"]:
                    open_cuts[lab, k] = (row["prefix"], rank)
                    if row["ids"] == 1:
                        cuts[lab, k] = (row["hash"], row["id"], 2 * rank >= row["n"])
                    break
                rank -= row["n"]
        if len(cuts) == len(open_cuts):
            return cuts
    raise ValueError("the split id is not unique; see stratified_split_by_id")


def _splits(keys: DataFrame, sizes: dict, stratum: Column, key: str, hashed: Column) -> Column:
    """The split of a row by its stratum and its id's place among the cuts."""
    ends = {lab: (train, train + val) for lab, (train, val, _) in sizes.items()}
    wanted = {(lab, k) for lab, ks in ends.items() for k in ks if k > 0}
    cuts = _find_cuts(keys, wanted) if wanted else {}

    def upto(lab, k):
        if k == 0:
            return F.lit(False)
        h, i, included = cuts[lab, k]
        here = F.col(key).eqNullSafe(F.lit(i)) if included else F.lit(False)
        return (hashed < h) | ((hashed == h) & (F.coalesce(F.col(key) < F.lit(i), F.lit(False)) | here))
    chosen = F.lit(None).cast("string")
    for lab, (train_end, val_end) in ends.items():
        within = F.when(upto(lab, train_end), "train").when(upto(lab, val_end), "val").otherwise("eval")
        chosen = F.when(stratum == lab, within).otherwise(chosen)
    return chosen


def stratified_split(df: DataFrame, key: str = ID, label: str = LABEL, holdout: float = 0.30,
                     eval_share: float = 0.50, seed: int = 42) -> DataFrame:
    """Add ``split``: class shares kept to within one row, sizes exact. ``key`` must be unique.

    A row without a label belongs to no split (NULL): it can neither train nor be evaluated.
    """
    sizes = split_sizes(_label_counts(df, label), holdout, eval_share)
    hashed = split_hash(key, seed)
    keys = df.select(F.col(label).alias("label"), F.col(key).alias("id"), hashed.alias("hash"), F.lit(1).alias("n"))
    return df.withColumn("split", _splits(keys, sizes, F.col(label), key, hashed))


def stratified_split_by_id(df: DataFrame, key: str = ID, label: str = LABEL, holdout: float = 0.30,
                           eval_share: float = 0.50, seed: int = 42) -> DataFrame:
    """Add ``split`` to a table whose ids repeat: all rows of an id are in one split, sizes exact to within one id.

    An id counts with all its labelled rows, for the least label among them. Rows are counted by id where they lie; the
    table is joined to ids that have several labels only, if there are any. A row without a label belongs to no
    split (NULL); rows without an id are one group.
    """
    hashed = split_hash(key, seed)
    ids = stage(df.where(F.col(label).isNotNull()).groupBy(F.col(key).alias("id")).agg(
        F.count("*").alias("n"), F.min(label).alias("label"), F.max(label).alias("greatest")), "split-ids")
    counts = {r["label"]: r["n"] for r in ids.groupBy("label").agg(F.sum("n").alias("n")).collect()}
    keys = ids.select("label", "id", split_hash("id", seed).alias("hash"), "n")
    mixed = ids.where("label <> greatest").select(F.col("id").alias("_id"), F.col("label").alias("_stratum"))
    names = df.columns
    if not mixed.isEmpty():
        df = df.join(mixed, F.col(key).eqNullSafe(F.col("_id")), "left")
        stratum = F.when(F.col(label).isNotNull(), F.coalesce("_stratum", label))
    else:
        stratum = F.col(label)
    chosen = _splits(keys, split_sizes(counts, holdout, eval_share), stratum, key, hashed)
    return df.select(*[F.col(quoted(c)) for c in names], chosen.alias("split"))
