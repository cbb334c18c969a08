"""Scoring of batches as they arrive in a folder: each file once, however often the job is started."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..sources.readers import stream_table


def score_arrivals(spark: SparkSession, score: Callable[[DataFrame], DataFrame], source: str, schema: T.StructType, out: str,
                   checkpoint: str, fmt: str = "csv", files: int | None = None) -> int:
    """Score the files of ``source`` that no earlier run has scored, add the scores to ``out`` and end; the number of rows read.

    The checkpoint remembers files, and the file sink commits what a micro-batch wrote as a whole, so a run that dies is
    taken up where it was and no row is scored twice. ``files`` bounds those of a micro-batch. ``score`` is a
    projection or a join with fitted tables, as of a saved bundle. Readers of ``out`` see committed files only.
    """
    scored = score(stream_table(spark, source, schema, fmt, files))
    query = (scored.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
             .outputMode("append").trigger(availableNow=True).start())
    query.awaitTermination()
    return sum(p["numInputRows"] for p in query.recentProgress)
