"""Incremental landing of raw files into bronze with Structured Streaming."""

from .landing import land_stream

__all__ = ["land_stream"]
