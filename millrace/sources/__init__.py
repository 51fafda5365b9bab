"""Readers."""

from millrace.sources.registry import read_source, source_frame

__all__ = ["read_source", "source_frame"]
