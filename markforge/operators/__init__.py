"""DataFrame -> DataFrame operators."""

from markforge.operators.budgets import structural_filter, token_filter, with_token_count, within_structure
from markforge.operators.cascade import cascade, first_valid_round, generate_round, generation_inputs, submission
from markforge.operators.normalize import drop_empty, normalize_pairs, to_pairs
from markforge.operators.report import (
    fallback_report,
    output_quality,
    quality_summary,
    require_sources,
    rows_per_group,
    runtime_estimate,
    split_counts,
)
from markforge.operators.sampling import (
    capped_sample,
    capped_sample_by,
    exact_split,
    file_row_id,
    head_cap,
    preview,
    rank_cut,
    seeded_shuffle,
    with_input_position,
)
from markforge.operators.union import shared_pairs, union_sources

__all__ = [
    "capped_sample", "capped_sample_by", "cascade", "drop_empty", "exact_split", "fallback_report", "file_row_id", "first_valid_round",
    "generate_round", "generation_inputs", "head_cap", "normalize_pairs", "output_quality", "preview",
    "quality_summary", "rank_cut", "require_sources", "rows_per_group", "runtime_estimate",
    "seeded_shuffle", "split_counts", "structural_filter", "submission", "to_pairs", "token_filter",
    "shared_pairs",
    "union_sources", "with_input_position", "with_token_count", "within_structure",
]
