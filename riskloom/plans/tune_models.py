"""Search the two best baseline families on train and validation rows; resumable.

    spark-submit -m riskloom.plans.tune_models --artifacts ARTIFACTS [--trials 100]
"""

from __future__ import annotations

import argparse

from ..operators.metrics import top_models
from ..operators.models import KEY_OF, validation_objective
from ..operators.search import N_TRIALS, search, search_summary
from ..operators.stopping import PATIENCE
from ..session import get_session
from ..sources.writers import read_split, write_dataset


def run(spark, artifacts: str, trials: int = N_TRIALS, rounds: int | None = None,
        patience: int = PATIENCE) -> None:
    best = top_models(spark.read.parquet(f"{artifacts}/baseline_results"), 2).collect()
    train, val = (read_split(spark, f"{artifacts}/split", s).drop("split") for s in ("train", "val"))
    found = search(spark, [KEY_OF[r["model"]] for r in best], validation_objective(train, val, rounds, patience=patience),
                   f"{artifacts}/trials", trials)
    write_dataset(search_summary(found).coalesce(1), f"{artifacts}/best_params")


def main(argv=None):
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--artifacts", required=True)
    parser.add_argument("--trials", type=int, default=N_TRIALS)
    parser.add_argument("--rounds", type=int)
    parser.add_argument("--patience", type=int, default=PATIENCE)
    args = parser.parse_args(argv)
    run(get_session("tune_models"), args.artifacts, args.trials, args.rounds, args.patience)


if __name__ == "__main__":
    main()
