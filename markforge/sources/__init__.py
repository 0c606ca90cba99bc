"""Readers and writers."""

from markforge.sources.readers import (
    WIDE_SOURCE_FIELDS,
    csv_to_parquet,
    load_shared_pairs,
    load_sources,
    read_csv_text,
    read_pairs_csv,
    read_source,
    read_test_prompts,
)
from markforge.sources.salvage import Salvaged, salvage
from markforge.sources.sinks import write_corpus, write_csv, write_submission

__all__ = [
    "Salvaged", "WIDE_SOURCE_FIELDS", "csv_to_parquet", "load_shared_pairs", "load_sources", "read_csv_text", "read_pairs_csv",
    "read_source", "read_test_prompts", "salvage", "write_corpus", "write_csv", "write_submission",
]
