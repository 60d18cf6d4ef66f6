"""Structured Streaming drivers for the incremental loads."""

from .incremental import ARRIVAL_SCHEMA, start_incremental_load

__all__ = ["ARRIVAL_SCHEMA", "start_incremental_load"]
