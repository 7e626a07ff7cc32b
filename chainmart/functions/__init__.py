"""Column expressions: built-in Spark functions only, so they stay inside code generation."""

from .bands import corr_band
from .numbers import as_decimal, base16_to_long, hex_to_long, pearson
from .text import blank_to_null, clean_symbol, cursor_key, interval_seconds, split_symbol
from .times import (
    at,
    calendar_fields,
    from_epoch_ms,
    from_epoch_s,
    hours_between,
    iso_date,
    iso_timestamp,
    minute_bucket,
    minute_ceiling,
    time_key,
)

__all__ = [
    "at",
    "as_decimal",
    "base16_to_long",
    "blank_to_null",
    "calendar_fields",
    "clean_symbol",
    "corr_band",
    "cursor_key",
    "from_epoch_ms",
    "from_epoch_s",
    "hex_to_long",
    "hours_between",
    "interval_seconds",
    "iso_date",
    "iso_timestamp",
    "minute_bucket",
    "minute_ceiling",
    "pearson",
    "split_symbol",
    "time_key",
]
