"""Refit on all cleaned train rows and save the scoring bundle.

    spark-submit -m riskloom.plans.final_model --clean CLEAN --artifacts ARTIFACTS
"""

from __future__ import annotations

import argparse

from ..operators.metrics import top_models
from ..operators.models import train_final
from ..operators.search import best_params, read_trials
from ..session import get_session


def run(spark, clean: str, artifacts: str, family: str = "catbc", rounds: int | None = None) -> None:
    """Tuned parameters of the family are used when there are any."""
    source = f"{clean}/final_train_cleaned"
    tuned = best_params(read_trials(spark, f"{artifacts}/trials")).get(family, {}).get("params")
    best = top_models(spark.read.parquet(f"{artifacts}/baseline_results"), 1).first()
    train_final(spark.read.parquet(source), f"{artifacts}/final", tuned, family, rounds,
                (best["model"], best["roc_auc"]), source)


def main(argv=None):
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--clean", required=True)
    parser.add_argument("--artifacts", required=True)
    parser.add_argument("--family", default="catbc", choices=("sgd", "xgb", "lgbm", "catbc"))
    parser.add_argument("--rounds", type=int)
    args = parser.parse_args(argv)
    run(get_session("final_model"), args.clean, args.artifacts, args.family, args.rounds)


if __name__ == "__main__":
    main()
