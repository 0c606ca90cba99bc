"""Column -> Column scalars (native expressions unless stated otherwise)."""

from markforge.functions.chat import completion_text, decoded_prompt, generation_prompt, training_text
from markforge.functions.markup import (
    block_pattern,
    ends_with_close_tag,
    extract_last_block,
    fallback,
    is_valid_markup,
    repair_attributes,
    valid_markup_py,
)
from markforge.functions.text import (
    blank_to_null,
    count_literal,
    first_non_empty,
    is_truthy,
    null_sentinels_to_null,
    py_strip,
    starts_with_ci,
)
from markforge.functions.tokens import (
    TOKEN_PATTERN,
    count_tokens,
    generation_budget,
    token_ids,
    truncated_length,
)

__all__ = [
    "TOKEN_PATTERN", "blank_to_null", "block_pattern", "completion_text", "count_literal", "count_tokens",
    "decoded_prompt",
    "ends_with_close_tag", "extract_last_block", "fallback", "first_non_empty",
    "generation_budget", "generation_prompt", "is_truthy", "is_valid_markup",
    "null_sentinels_to_null", "py_strip", "repair_attributes", "starts_with_ci",
    "token_ids", "training_text", "truncated_length", "valid_markup_py",
]
