"""Streaming variants (Structured Streaming) of the incremental operators."""

from .upsert_stream import upsert_stream

__all__ = ["upsert_stream"]
