"""The exploratory reports of a built dataset, one small table each.

    spark-submit -m riskloom.plans.profile_dataset --built BUILT --out REPORTS
"""

from __future__ import annotations

import argparse

from ..functions.selectors import LABEL
from ..operators import correlation, profiling
from ..operators.cleaning import infinities_to_null
from ..session import get_session, stage
from ..sources.writers import feature_names, write_dataset
from .build_dataset import read_built


def reports(train) -> dict:
    """Reports in the order of the exploration: infinities, duplicates and near-constant
    columns are taken out of the working copy as it goes on."""
    found = {
        "table_info": profiling.table_info(train),
        "column_info": profiling.column_info(train),
        "missing": profiling.missing_report(train),
        "label_distribution": profiling.label_distribution(train),
        "feature_summary": profiling.feature_summary(train),
        "describe": profiling.describe(train),
        "infinities": profiling.infinity_report(train),
        "duplicates": profiling.duplicate_report(train),
    }
    finite = infinities_to_null(train)
    constant = profiling.near_constant_columns(finite)
    kept = stage(profiling.drop_duplicates(finite).drop(*constant), "profiled")
    with_label = correlation.spearman_with_label(kept)
    heatmap = [r["feature"] for r in correlation.top_correlated(with_label, 30).collect()]
    found.update({
        "near_constant": profiling.near_constant(finite),
        "skew": profiling.skew_report(kept),
        "spearman_with_label": with_label,
        "spearman_matrix": correlation.spearman_matrix(kept, [*heatmap, LABEL]),
        "box_stats": profiling.box_stats(kept, heatmap[:20]),
        "iqr": profiling.iqr_report(kept),
        "feature_names": feature_names(kept),
    })
    return found


def run(spark, built: str, out: str) -> None:
    for name, report in reports(read_built(spark, built, "train")).items():
        write_dataset(report.coalesce(1), f"{out}/{name}")   # a row per column or pair


def main(argv=None):
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--built", required=True)
    parser.add_argument("--out", required=True)
    args = parser.parse_args(argv)
    run(get_session("profile_dataset"), args.built, args.out)


if __name__ == "__main__":
    main()
