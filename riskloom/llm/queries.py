"""The registered queries of this subpackage and their statements."""

from __future__ import annotations

import corpus_pipeline
from riskloom.llm import (chosen_path, chunk_dedup, decontaminate, exact_dedup, mixing, periodic_runs, quality, secret_scan,
                          structure_repair, suffix_dedup, token_cache, token_orc, url_filter)

QUERIES = {
    "op1_exact_dedup": exact_dedup.op1_exact_dedup,
    "op2_quality": quality.op2_quality,
    "op3_token_orc": token_orc.op3_token_orc,
    "op4_url_filter": url_filter.op4_url_filter,
    "op5_mixing": mixing.op5_mixing,
    "op6_decontaminate": decontaminate.op6_decontaminate,
    "op7_chunk_dedup": chunk_dedup.op7_chunk_dedup,
    "op8_secret_scan": secret_scan.op8_secret_scan,
    "op9_chosen_path": chosen_path.op9_chosen_path,
    "op10_suffix_dedup": suffix_dedup.op10_suffix_dedup,
    "op11_token_counts": token_cache.op11_token_counts,
    "op12_periodic_runs": periodic_runs.op12_periodic_runs,
    "op13_structure_repair": structure_repair.op13_structure_repair,
    "pipeline": corpus_pipeline.run,
}

#: what SQL can express; the other queries are tested against brute force
STATEMENTS = {
    "op1_exact_dedup": exact_dedup.ORACLE,
    "op4_url_filter": url_filter.ORACLE,
}
