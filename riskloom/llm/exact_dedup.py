"""Exact dedup by content sort: range partitions of the normalised bytes, sorted, neighbours compared."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.llm.common import NO_ID, ascii_lower, partitions, table, whole_text, written

#: rows drawn for each range, and leading bytes that a splitter shows
SAMPLED_PER_RANGE, SPLITTER_BYTES = 64, 64
SPLITTERS = "array<struct<p:string,h:bigint,k:bigint>>"


def _key(norm: Column, order: Column) -> Column:
    """What a splitter shows of a row: leading bytes as hex, a hash of all bytes, the order of its id."""
    lead = F.hex(F.substring(F.encode(norm, "UTF-8"), 1, SPLITTER_BYTES))
    return F.struct(lead.alias("p"), F.xxhash64(norm).alias("h"), order.alias("k"))


def _splitters(rows: DataFrame, ranges: int) -> list[dict]:
    """At most ``ranges - 1`` keys that cut a random sample of ``ranges * SAMPLED_PER_RANGE`` rows evenly."""
    total = rows.count()
    share = min(1.0, ranges * SAMPLED_PER_RANGE / max(total, 1))
    drawn = sorted({tuple(r[0]) for r in rows.sample(share, seed=11).select(_key(F.col("norm"), F.col("k"))).collect()})
    cuts = sorted({drawn[i * len(drawn) // ranges] for i in range(1, ranges)}) if drawn else []
    return [{"p": p, "h": h, "k": k} for p, h, k in cuts]


def _place(cuts: list[dict], key: Column) -> Column:
    """Binary search: the row's range, and whether a splitter carries the same text."""
    table = F.from_json(F.lit(json.dumps(cuts)), SPLITTERS)
    steps = F.array(*[F.lit(2**b) for b in range(len(cuts).bit_length() - 1, -1, -1)])
    start = F.struct(F.lit(0).alias("at"), key.alias("key"))

    def step(acc: Column, width: Column) -> Column:
        further = acc["at"] + width
        fits = (further <= len(cuts)) & (F.get(table, further - 1) <= acc["key"])
        return F.struct(F.when(fits, further).otherwise(acc["at"]).alias("at"), acc["key"].alias("key"))

    def same(cut: Column, key: Column) -> Column:
        return F.coalesce((cut["p"] == key["p"]) & (cut["h"] == key["h"]), F.lit(False))

    def finish(acc: Column) -> Column:
        cut = same(F.get(table, acc["at"] - 1), acc["key"]) | same(F.get(table, acc["at"]), acc["key"])
        return F.struct(acc["at"].alias("range"), cut.alias("cut"))

    return F.aggregate(steps, start, step, finish)


def exact_dedup(docs: DataFrame, keep: str = "smallest", id_col: str = "doc_id", text_col: str = "text",
                ranges: int | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256, n_bytes.

    Texts are equal when their bytes are equal after lower-casing A-Z. A bounded random sample gives
    splitters; rows are dealt to the ranges between them by (leading bytes, hash, id), sorted by their whole
    text (Spark's sort spills), and the dense rank compares each text in full with its neighbour. The id is
    part of the splitters, so a text that fills many ranges is cut; the pieces of such a text, at most two for
    each splitter, are put together by SHA-256 through a broadcast table of that size.

    ``keep`` names the id that stays, "smallest" or "largest". A null text counts as empty; a null id stays
    only when its group has no other id. Of rows that repeat both id and text one is kept. An empty table
    gives no rows. Other columns are not read.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError(f"keep: {keep}")
    ranges = ranges or partitions(docs.sparkSession)
    ident = F.col(id_col).cast("long")
    order = ident if keep == "smallest" else F.bitwise_not(ident)
    rows = docs.select(ident.alias("id"), F.coalesce(order, F.lit(NO_ID)).alias("k"),
                       ascii_lower(whole_text(text_col)).alias("norm"))
    cuts = _splitters(rows, ranges)
    dealt = (rows.withColumn("place", _place(cuts, _key(F.col("norm"), F.col("k"))))
             .select("id", "k", "norm", F.col("place.range").alias("range"), F.col("place.cut").alias("cut"))
             .repartitionById(len(cuts) + 1, F.col("range")))
    sorted_texts = Window.partitionBy("range").orderBy("norm")
    ranked = dealt.withColumn("run", F.dense_rank().over(sorted_texts)).select(
        "id", "k", "range", "cut", "run", F.sha2(F.encode("norm", "UTF-8"), 256).alias("sha"),
        F.octet_length("norm").cast("long").alias("n_bytes"))
    run = Window.partitionBy("range", "run").orderBy("k")
    whole = run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    local = written(ranked.withColumns({
        "nth": F.row_number().over(run), "first_k": F.first("k").over(whole), "first_id": F.first("id").over(whole),
        "size": F.count("*").over(whole)}), "exact-dedup")
    # a text that a splitter carries may lie in several ranges; there are fewer such runs than twice the splitters
    joined = local.where("cut and nth = 1").groupBy("sha").agg(
        F.min("first_k").alias("all_k"), F.min_by("first_id", "first_k").alias("all_id"),
        F.sum("size").alias("all_size"))
    out = local.join(F.broadcast(joined.withColumnRenamed("sha", "cut_sha")),
                     F.col("cut") & (F.col("sha") == F.col("cut_sha")), "left")
    return out.select(
        F.col("id").alias("doc_id"),
        F.when(F.col("cut"), F.col("all_id")).otherwise(F.col("first_id")).alias("keep_id"),
        F.coalesce("all_size", "size").alias("group_size"),
        ((F.col("nth") == 1) & (F.col("k") == F.coalesce("all_k", "first_k"))).alias("kept"),
        F.col("sha").alias("text_sha256"), "n_bytes")


def op1_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup(table(spark, folder, "documents"), keep="largest")


ORACLE = """
WITH t AS (
    SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
    FROM documents),
g AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256, strlen(norm) AS n_bytes
FROM t JOIN g USING (norm)
"""
