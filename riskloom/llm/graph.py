"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import Scratch, noted


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); the component is its smallest node.

    Each round takes the smallest label among the neighbours and then the label of that label, so labels run
    along chains in doubling steps; every round is written, and only the number of changes reaches the driver.
    """
    scratch = Scratch(edges.sparkSession)
    both = scratch.keep(edges.select("a", "b").union(edges.select("b", "a")).where("a != b").distinct(), "edges")
    state = scratch.keep(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("component")), "labels")
    while True:
        near = both.join(state, F.col("b") == F.col("node")).groupBy("a").agg(F.min("component").alias("near"))
        lower = state.join(near, F.col("node") == F.col("a")).select(
            "node", F.col("component").alias("old"), F.least("component", "near").alias("found"))
        target = state.select(F.col("node").alias("label"), F.col("component").alias("beyond"))
        after = scratch.keep(lower.join(target, F.col("found") == F.col("label")).select(
            "node", "old", F.least("found", "beyond").alias("component")), "labels")
        state = after.select("node", "component")
        if after.where("old != component").isEmpty():
            result = noted(state, "components")
            scratch.forget(list(scratch.paths))
            return result
