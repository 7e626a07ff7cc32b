"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Quote assets, tried in this order, and seconds per interval unit.
QUOTE_ASSETS = ("USDT", "USDC", "BUSD", "USD", "EUR", "BTC", "ETH", "BNB", "TRY")
UNIT_SECONDS = {"s": 1, "m": 60, "h": 3600, "d": 86400, "w": 604800}


def blank_to_null(c: Column) -> Column:
    """Trimmed text, NULL when nothing is left."""
    return F.nullif(F.trim(c), F.lit(""))


def clean_symbol(c: Column) -> Column:
    """Trimmed upper-case symbol, NULL when blank."""
    return F.upper(blank_to_null(c))


def split_symbol(c: Column) -> Column:
    """``struct<base, quote>`` by known quote asset; both NULL when none fits.

    The base group is lazy: the longest quote suffix wins (``ETHBUSD`` is ETH/BUSD).
    """
    pattern = f"^(.+?)({'|'.join(QUOTE_ASSETS)})$"
    s = F.upper(F.trim(c))
    part = lambda i: F.nullif(F.regexp_extract(s, pattern, i), F.lit(""))
    return F.struct(part(1).alias("base"), part(2).alias("quote"))


def interval_seconds(c: Column) -> Column:
    """Candle interval text to seconds, unknown as NULL. Case is ignored, so ``1M`` is 60."""
    x = F.lower(F.trim(c))
    units = F.create_map(*[F.lit(v) for kv in UNIT_SECONDS.items() for v in kv])
    count = F.substring(x, 1, F.length(x) - 1).try_cast("bigint")
    seconds = F.try_multiply(count, F.element_at(units, F.right(x, F.lit(1))))
    return F.when(x.rlike("^[+-]?[0-9]+[smhdw]$"), seconds.try_cast("int"))


def cursor_key(*parts: Column) -> Column:
    """Identifier from text parts joined by ``__``: other characters become ``_``, ends trimmed."""
    cleaned = [
        F.regexp_replace(F.regexp_replace(p, "[^A-Za-z0-9]+", "_"), "^_+|_+$", "") for p in parts
    ]
    return F.concat_ws("__", *cleaned)
