"""Raw tables -> one feature row per applicant, for train and test.

    spark-submit -m riskloom.plans.build_dataset --source RAW --out BUILT [--format csv]
"""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from ..functions.selectors import ID, LABEL
from ..operators.assemble import build
from ..operators.checks import assert_kept, assert_unique, watched_report
from ..session import get_session
from ..sources.readers import load_sources
from ..sources.writers import feature_names, write_dataset


def run(spark, source: str, out: str, fmt: str = "csv", null_sentinel_first: bool = False) -> None:
    """Writes both datasets (parquet), the column names of each, and the counts observed while they were joined."""
    sources = load_sources(spark, source, fmt)
    for name in ("application_train", "application_test"):
        assert_unique(sources[name], ID, name)
    watched: dict = {}
    built = build(sources, null_sentinel_first, watched)
    # both datasets come out of one plan; the folder per dataset keeps their scans apart
    built.write.mode("overwrite").partitionBy("dataset").parquet(f"{out}/final")
    assert_kept(watched["applications"], watched["assembled"], "applicants")
    write_dataset(watched_report(spark, watched).coalesce(1), f"{out}/observed")
    for dataset, dropped in (("train", ["dataset"]), ("test", ["dataset", LABEL])):
        names = feature_names(spark.read.parquet(f"{out}/final").where(F.col("dataset") == dataset).drop(*dropped))
        write_dataset(names.coalesce(1), f"{out}/final_{dataset}_feature_names", "csv")


def read_built(spark, out: str, dataset: str):
    df = spark.read.parquet(f"{out}/final").where(F.col("dataset") == dataset).drop("dataset")
    return df.drop(LABEL) if dataset == "test" else df


def main(argv=None):
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--source", required=True)
    parser.add_argument("--out", required=True)
    parser.add_argument("--format", default="csv", choices=("csv", "parquet"))
    parser.add_argument("--null-sentinel-first", action="store_true")
    args = parser.parse_args(argv)
    run(get_session("build_dataset"), args.source, args.out, args.format, args.null_sentinel_first)


if __name__ == "__main__":
    main()
