"""Scans, parsers of the raw formats, and sinks."""

from .parsers import (
    BLOCK_FIELDS,
    CANDLE_FIELDS,
    explode_listings,
    parse_blocks,
    parse_candles,
    parse_klines,
    parse_listings,
)
from .scans import RECORD_SEPARATOR, scan_documents, scan_jsonl, scan_partition
from .sinks import append_documents, append_rows, write_csv, write_jsonl, write_merged

__all__ = [
    "BLOCK_FIELDS",
    "CANDLE_FIELDS",
    "RECORD_SEPARATOR",
    "append_documents",
    "append_rows",
    "explode_listings",
    "parse_blocks",
    "parse_candles",
    "parse_klines",
    "parse_listings",
    "scan_documents",
    "scan_jsonl",
    "scan_partition",
    "write_csv",
    "write_jsonl",
    "write_merged",
]
