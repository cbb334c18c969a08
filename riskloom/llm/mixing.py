"""Mixing sources to target weights by entropy balancing: Newton steps on the convex dual, then whole copies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.llm.common import WORD, noted, table, whole_text, written

#: no document comes more often than this
MOST_COPIES = 2
#: Newton steps at most, relative error at which a source is solved, and rounds that mend what rounding left
STEPS, SOLVED, MENDING = 40, 1e-7, 6
#: leading bits of a document's hash that divide a class of equal documents
HASH_BITS = 10


def source_targets(classes: DataFrame, share: float, weights: list[float]) -> DataFrame:
    """Per source (``src`` a struct, so null is a source): source_size, target.

    Sources in code-point order, null last, weigh ``weights`` in turn. The total is ``share`` of all sizes;
    a target stops at MOST_COPIES times its source's size and the excess is reshared by weight until none is
    above, that is target = min(cap, level * weight) with one level for all: sources by cap / weight, the
    first k stand at their caps, and the level is what remains over the weights that remain.
    """
    sizes = classes.groupBy("src").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"))
    named = Window.orderBy(F.col("src.missing"), F.col("src.name"))
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(F.row_number().over(named) - 1, F.lit(len(weights))))
    caps = sizes.select("src", "source_size", weight.alias("weight"),
                        (F.lit(float(MOST_COPIES)) * F.col("source_size")).alias("cap"))
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("src.missing"), F.col("src.name"))
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(F.lit(0))
    left = F.greatest(F.lit(0.0), F.lit(share) * F.sum("source_size").over(every)
                      - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
    rest = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    levels = caps.withColumn("level", left / rest)
    # the first source, in this order, that the level does not lift above its cap sets the level of the rest
    first = F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(F.col("cap") / F.col("weight"), "level"))
                  ).over(every)["level"]
    return levels.withColumn("final", first).select(
        "src", "source_size", F.coalesce(F.least("cap", F.col("final") * F.col("weight")), "cap").alias("target"))


def _rate(tilt: Column, x: Column) -> Column:
    return F.least(F.lit(float(MOST_COPIES)), F.exp(F.least(tilt * x, F.lit(50.0))))


def solve_tilts(classes: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source the dual variable ``tilt``: the sum over documents of rate * size meets the target.

    Entropy balancing looks for rates as near to 1 as possible (least sum of r ln r - r, 0 <= r <= 2) that
    give each source its words; the solution is r = min(2, exp(tilt * size / mean size)). The dual is convex
    in the tilt, so a Newton step is taken where it stays inside the bracket known so far, else the bracket is
    halved. Each step sums the classes of all sources where they lie and writes one row per source.
    """
    # at these bounds every rate that can be 2 is 2, and next to nothing is taken
    bounds = classes.where("size > 0").groupBy("src").agg(
        F.min("size").alias("least"), (F.sum(F.col("n") * F.col("size")) / F.sum("n")).alias("mean"))
    low = F.lit(-700.0) * F.col("mean") / F.col("least")
    high = F.log(F.lit(float(MOST_COPIES))) * F.col("mean") / F.col("least")
    start = F.when(F.col("target") >= MOST_COPIES * F.col("source_size"), high).otherwise(0.0)
    state = noted(targets.join(bounds, "src").select(
        "src", "target", "mean", start.alias("tilt"), F.lit(False).alias("solved"), low.alias("low"), high.alias("high")),
        "mix-tilts")
    for _ in range(STEPS):
        x = F.col("size") / F.col("mean")
        rate = _rate(F.col("tilt"), x)
        slope = F.when(rate < MOST_COPIES, rate * x).otherwise(0.0)
        sums = classes.where("size > 0").join(state, "src").groupBy("src").agg(
            F.sum(F.col("n") * F.col("size") * rate).alias("got"), F.sum(F.col("n") * F.col("size") * slope).alias("slope"))
        after = state.join(sums, "src")
        gap = F.col("got") - F.col("target")
        low = F.when(gap <= 0, F.col("tilt")).otherwise(F.col("low"))
        high = F.when(gap >= 0, F.col("tilt")).otherwise(F.col("high"))
        newton = F.col("tilt") - gap / F.col("slope")
        step = F.when((F.col("slope") > 0) & (newton > low) & (newton < high), newton).otherwise((low + high) / 2)
        done = F.abs(gap) <= SOLVED * F.greatest("target", F.lit(1.0))
        state = noted(after.select("src", "target", "mean", F.when(done, F.col("tilt")).otherwise(step).alias("tilt"),
                                     done.alias("solved"), low.alias("low"), high.alias("high")), "mix-tilts")
        if state.where("not solved").isEmpty():
            break
    return state.select("src", "mean", "tilt")


def class_copies(classes: DataFrame, targets: DataFrame) -> DataFrame:
    """Per (source, size): ``copies``, the copies that its documents get together.

    Rates summed in order of size and rounded give every class a whole number whose running total is never
    off by more than one half. What a source then lacks or has too much, less than its longest document, is
    mended in rounds: the largest size that fits into the gap gives or loses as many copies as fit.
    """
    tilts = solve_tilts(classes, targets)
    in_order = Window.partitionBy("src").orderBy(F.col("size").desc()).rowsBetween(Window.unboundedPreceding, 0)
    rated = classes.join(tilts, "src", "left").withColumn(
        "sum", F.sum(F.col("n") * F.coalesce(_rate(F.col("tilt"), F.col("size") / F.col("mean")), F.lit(1.0))).over(in_order))
    whole = F.floor(F.col("sum") + 0.5 + 1e-9)
    order = Window.partitionBy("src").orderBy(F.col("size").desc())
    copies = noted(rated.select("src", "size", "n", F.least(
        F.lit(MOST_COPIES) * F.col("n"), F.greatest(F.lit(0), whole - F.coalesce(F.lag(whole).over(order), F.lit(0))))
        .alias("copies")), "mix-copies")
    for _ in range(MENDING):
        gaps = copies.groupBy("src").agg(F.sum(F.col("copies") * F.col("size")).alias("taken")).join(targets, "src").select(
            "src", F.round(F.col("target") - F.col("taken")).cast("long").alias("gap"))
        room = F.when(F.col("gap") > 0, F.lit(MOST_COPIES) * F.col("n") - F.col("copies")).otherwise(F.col("copies"))
        fits = copies.where("size > 0").join(gaps, "src").withColumn("room", room).where("room > 0 and size <= abs(gap)")
        best = fits.groupBy("src").agg(F.max_by(F.struct("size", "gap", "room"), "size").alias("best")).select(
            F.col("src").alias("mended"), F.col("best.size").alias("at"), (F.signum("best.gap").cast("long") * F.least(
                F.col("best.room"), F.floor(F.abs("best.gap") / F.col("best.size")))).alias("change"))
        copies = noted(copies.join(best, (F.col("src") == F.col("mended")) & (F.col("size") == F.col("at")), "left").select(
            "src", "size", "n", (F.col("copies") + F.coalesce("change", F.lit(0))).alias("copies")), "mix-copies")
    return copies


def mix(docs: DataFrame, share: float = 1.5, weights: tuple[float, ...] = (5, 2, 1), id_col: str = "doc_id",
        text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per row of ``docs``: doc_id, size, source_size, target, copies, taken.

    Size is the number of words. Documents of one source and size are alike to the mix, so everything is
    solved on the table of (source, size) classes, which is far smaller than the corpus however large a single
    source is; only the last step goes back to the rows: a class of n documents with m copies gives each
    m div n and one more to the first m mod n in the order of their hash, counted in up to 2**HASH_BITS
    parts of the class. ``taken`` = copies * size.

    Null texts have size 0 and rate 1; null sources are a source of their own. Equal ids (repeated rows) may
    share copies in any order. Empty tables give no rows; other columns are not read.
    """
    src = F.struct(F.col(source_col).isNull().alias("missing"), F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("name"))
    hashed = F.xxhash64(F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    rows = written(docs.select(
        F.col(id_col).alias("doc_id"), src.alias("src"), hashed.alias("hash"),
        F.regexp_count(whole_text(text_col), F.lit(WORD)).cast("long").alias("size")), "mix-sizes")
    classes = written(rows.groupBy("src", "size").agg(F.count("*").alias("n")), "mix-classes")
    targets = noted(source_targets(classes, share, list(weights)), "mix-targets")
    copies = class_copies(classes, targets)
    part = F.shiftright(F.col("hash"), 64 - HASH_BITS)
    parts = rows.groupBy("src", "size", part.alias("part")).agg(F.count("*").alias("in_part"))
    ahead = Window.partitionBy("src", "size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    plan = parts.withColumn("ahead", F.coalesce(F.sum("in_part").over(ahead), F.lit(0))).join(
        copies, ["src", "size"]).join(targets, "src")
    # written first: else the join would be dealt by (src, size), as the sums before it are, and a class be one task's
    plan = written(plan, "mix-plan")
    nth = F.row_number().over(Window.partitionBy("src", "size", "part").orderBy("hash", "doc_id"))
    out = rows.withColumn("part", part).join(plan, ["src", "size", "part"]).withColumn("nth", F.col("ahead") + nth)
    mine = F.expr("copies div n") + (F.col("nth") <= F.col("copies") % F.col("n")).cast("long")
    return out.select("doc_id", "size", "source_size", "target", mine.alias("copies"), (mine * F.col("size")).alias("taken"))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **settings) -> DataFrame:
    """``docs`` with every row as often as the mix takes it (0, 1 or 2 times), with all its columns.

    Rows that repeat an id each come as often as the one that comes most.
    """
    plan = mix(docs, id_col=id_col, text_col=text_col, source_col=source_col, **settings).where("copies > 0").groupBy(
        F.col("doc_id").alias("mixed_id")).agg(F.max("copies").cast("int").alias("mixed_copies"))
    names = [F.col(f"d.`{c}`") for c in docs.columns]
    joined = docs.alias("d").join(plan.alias("p"), F.col(f"d.`{id_col}`").eqNullSafe(F.col("p.mixed_id")))
    return joined.select(*names, F.explode(F.sequence(F.lit(1), F.col("p.mixed_copies"))).alias("__copy")).drop("__copy")


def op5_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mix(table(spark, folder, "documents"))
