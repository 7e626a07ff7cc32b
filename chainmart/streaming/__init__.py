"""Structured Streaming forms of the incremental jobs."""

from .jobs import dedupe_stream, land_stream, run_once, tumbling_averages
from .upsert import dedupe_into, merge_into, read_or_none, upsert_into

__all__ = [
    "dedupe_into",
    "dedupe_stream",
    "land_stream",
    "merge_into",
    "read_or_none",
    "run_once",
    "tumbling_averages",
    "upsert_into",
]
