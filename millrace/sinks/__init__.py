"""Writers."""

from millrace.sinks.registry import write_sink

__all__ = ["write_sink"]
