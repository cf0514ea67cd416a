"""Queries of the operators, and SQL for those that SQL can express."""

from __future__ import annotations

import corpus_pipeline

from .exact_dedup import OP4_SQL, op4_exact_dedup
from .filter_audit import OP12_SQL, op12_filter_audit
from .mixing import op5_mixing
from .near_dup import op7_near_dedup
from .piece_sampling import op10_piece_sampling
from .private_data import op11_private_data
from .secrets import op6_secret_scans
from .source_divergence import OP13_SQL, op13_source_divergence
from .substring_dedup import op8_substring_dedup
from .token_counts import op1_token_counts
from .topk_search import OP9_SQL, op9_topk_search
from .toxicity import op2_toxicity
from .url_filter import OP3_SQL, op3_url_filter

QUERIES = {
    "pipeline": corpus_pipeline.run,
    "op1_token_counts": op1_token_counts,
    "op2_toxicity": op2_toxicity,
    "op3_url_filter": op3_url_filter,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_mixing": op5_mixing,
    "op6_secret_scans": op6_secret_scans,
    "op7_near_dedup": op7_near_dedup,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_topk_search": op9_topk_search,
    "op10_piece_sampling": op10_piece_sampling,
    "op11_private_data": op11_private_data,
    "op12_filter_audit": op12_filter_audit,
    "op13_source_divergence": op13_source_divergence,
}

SQL = {
    "op3_url_filter": OP3_SQL,
    "op4_exact_dedup": OP4_SQL,
    "op9_topk_search": OP9_SQL,
    "op12_filter_audit": OP12_SQL,
    "op13_source_divergence": OP13_SQL,
}
