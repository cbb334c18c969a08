"""Score the files that came into a folder since the last run.

    spark-submit -m riskloom.plans.score_arrivals --artifacts ARTIFACTS --arrivals FOLDER --out SCORES --checkpoint STATE
"""

from __future__ import annotations

import argparse

from pyspark.sql import types as T

from ..functions.selectors import ID
from ..session import get_session
from ..streaming.arrivals import score_arrivals
from .score_batch import choose_bundle


def run(spark, artifacts: str, arrivals: str, out: str, checkpoint: str, fmt: str = "csv", threshold: float | None = None) -> int:
    """Files hold the id and the features of the model, CSV in this order."""
    bundle = choose_bundle(spark, artifacts)
    schema = T.StructType([T.StructField(ID, T.LongType()), *bundle.input_schema.fields])
    return score_arrivals(spark, lambda rows: bundle.score(rows, threshold), arrivals, schema, out, checkpoint, fmt)


def main(argv=None):
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--artifacts", required=True)
    parser.add_argument("--arrivals", required=True)
    parser.add_argument("--out", required=True)
    parser.add_argument("--checkpoint", required=True)
    parser.add_argument("--format", default="csv", choices=("csv", "parquet"))
    parser.add_argument("--threshold", type=float)
    args = parser.parse_args(argv)
    run(get_session("score_arrivals"), args.artifacts, args.arrivals, args.out, args.checkpoint, args.format, args.threshold)


if __name__ == "__main__":
    main()
