"""Built dataset -> cleaned train and test, and the column report of train.

    spark-submit -m riskloom.plans.clean_dataset --built BUILT --out CLEAN
"""

from __future__ import annotations

import argparse

from ..operators.cleaning import clean
from ..operators.profiling import column_report
from ..session import get_session
from ..sources.writers import write_dataset
from .build_dataset import read_built


def run(spark, built: str, out: str) -> None:
    for dataset in ("train", "test"):
        write_dataset(clean(read_built(spark, built, dataset)), f"{out}/final_{dataset}_cleaned")
    report = column_report(spark.read.parquet(f"{out}/final_train_cleaned"))
    write_dataset(report.coalesce(1), f"{out}/column_report")


def main(argv=None):
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--built", required=True)
    parser.add_argument("--out", required=True)
    args = parser.parse_args(argv)
    run(get_session("clean_dataset"), args.built, args.out)


if __name__ == "__main__":
    main()
