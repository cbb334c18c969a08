"""Cleaned train -> split, four baselines, comparison table.

    spark-submit -m riskloom.plans.train_models --clean CLEAN --out ARTIFACTS
"""

from __future__ import annotations

import argparse

from ..operators.metrics import compare_models
from ..operators.models import train_baselines
from ..operators.split import stratified_split
from ..operators.stopping import PATIENCE
from ..session import get_session
from ..sources.writers import read_split, write_dataset, write_split


def run(spark, clean: str, out: str, rounds: int | None = None, patience: int = PATIENCE) -> None:
    rows = stratified_split(spark.read.parquet(f"{clean}/final_train_cleaned"))
    write_split(rows, f"{out}/split")
    split = read_split(spark, f"{out}/split", schema=rows.schema)
    scored, _ = train_baselines(split, rounds, folder=f"{out}/baselines", patience=patience)
    write_dataset(compare_models(scored).coalesce(1), f"{out}/baseline_results")


def main(argv=None):
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--clean", required=True)
    parser.add_argument("--out", required=True)
    parser.add_argument("--rounds", type=int)
    parser.add_argument("--patience", type=int, default=PATIENCE)
    args = parser.parse_args(argv)
    run(get_session("train_models"), args.clean, args.out, args.rounds, args.patience)


if __name__ == "__main__":
    main()
