"""Score a batch of applicants: probability, decision and risk band.

    spark-submit -m riskloom.plans.score_batch --artifacts ARTIFACTS --batch BATCH.csv --out SCORES
"""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.selectors import ID
from ..operators.metrics import top_models
from ..operators.models import KEY_OF, load_bundle
from ..session import get_session
from ..sources.readers import read_table
from ..sources.writers import exists, write_dataset


def choose_bundle(spark, artifacts: str):
    """The final model, or else the best baseline."""
    if exists(spark, f"{artifacts}/final/metadata"):
        return load_bundle(spark, f"{artifacts}/final")
    best = top_models(spark.read.parquet(f"{artifacts}/baseline_results"), 1).first()
    return load_bundle(spark, f"{artifacts}/baselines/{KEY_OF[best['model']]}")


def read_batch(spark, bundle, path: str):
    """The applicants of a file, with the columns that the model knows."""
    return read_table(spark, path, T.StructType([T.StructField(ID, T.LongType()), *bundle.input_schema.fields]))


def run(spark, artifacts: str, batch: str, out: str, threshold: float | None = None, applicant: int | None = None) -> None:
    bundle = choose_bundle(spark, artifacts)
    rows = read_batch(spark, bundle, batch)
    if applicant is not None:
        rows = rows.where(F.col(ID) == applicant)
    write_dataset(bundle.score(rows, threshold), out)


def main(argv=None):
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--artifacts", required=True)
    parser.add_argument("--batch", required=True)
    parser.add_argument("--out", required=True)
    parser.add_argument("--threshold", type=float)
    parser.add_argument("--applicant", type=int)
    args = parser.parse_args(argv)
    run(get_session("score_batch"), args.artifacts, args.batch, args.out, args.threshold, args.applicant)


if __name__ == "__main__":
    main()
