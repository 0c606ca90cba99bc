"""Streaming use of the row-local operators."""

from markforge.streaming.postprocess import candidate_stream, postprocess_stream, write_stream

__all__ = ["candidate_stream", "postprocess_stream", "write_stream"]
