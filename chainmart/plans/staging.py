"""Landing to staging: typed, validated, one row per natural key; rejects keep their reason."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import as_decimal, blank_to_null, clean_symbol, hex_to_long, iso_date, iso_timestamp
from ..operators.merge import insert_if_absent, merge_upsert
from ..operators.quality import Rule, split_valid
from ..sources.parsers import QUOTE_FIELDS, explode_listings, field

# Precision and scale of the staged measures, text widths.
CANDLE_DECIMALS = {
    "open": (20, 8),
    "high": (20, 8),
    "low": (20, 8),
    "close": (20, 8),
    "volume": (28, 8),
    "quote_asset_volume": (28, 8),
    "taker_buy_base_volume": (28, 8),
    "taker_buy_quote_volume": (28, 8),
}
METRIC_DECIMALS = {
    "price": (20, 8),
    "volume_24h": (20, 2),
    "market_cap": (20, 2),
    "percent_change_1h": (10, 4),
    "percent_change_24h": (10, 4),
    "percent_change_7d": (10, 4),
    "circulating_supply": (20, 2),
    "total_supply": (20, 2),
    "max_supply": (20, 2),
}
SYMBOL_WIDTH, NAME_WIDTH, SLUG_WIDTH = 20, 200, 200


def fits(raw: Column, cast: Column) -> Column:
    """Whether a raw measure survives its cast; absent and NaN values become NULL and pass."""
    return raw.isNull() | F.lower(raw.cast("string")).isin("nan") | cast.isNotNull()


def price_rule(close: Column) -> Rule:
    """A candle without a close passes; otherwise the close must be a number above zero."""
    return Rule("bad_close", close.isNull() | F.coalesce(close.try_cast("double") > 0, F.lit(False)))


def listing_price_rule(price: Column, is_number: Column | None = None) -> Rule:
    """A listed asset needs a price above zero; a number written as text does not count."""
    positive = price.try_cast("double") > 0
    return Rule("bad_price", positive if is_number is None else is_number & positive)


def candle_rules() -> list[Rule]:
    """Rules for landed candles (text columns, as landing keeps them)."""
    return [
        Rule("blank_symbol", blank_to_null(F.col("symbol")).isNotNull()),
        Rule("blank_interval", blank_to_null(F.col("interval")).isNotNull()),
        Rule("no_open_time", F.col("open_time_ms").isNotNull()),
        Rule("no_close_time", F.col("close_time_ms").isNotNull()),
        price_rule(F.col("close")),
        *[
            Rule(f"out_of_range_{c}", fits(F.col(c), as_decimal(F.col(c), p, s)))
            for c, (p, s) in CANDLE_DECIMALS.items()
        ],
    ]


def clean_candles(landed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(typed candles, rejects)``."""
    valid, rejects = split_valid(landed, candle_rules())
    typed = valid.withColumns(
        {
            "raw_key": F.concat_ws("|", "symbol", "interval"),
            "symbol": clean_symbol(F.col("symbol")),
            "interval": F.trim("interval"),
            "trading_day": iso_date(F.col("trading_day")),
            "number_of_trades": F.col("number_of_trades").try_cast("int"),
            **{c: as_decimal(F.col(c), p, s) for c, (p, s) in CANDLE_DECIMALS.items()},
        }
    )
    return typed, rejects


CANDLE_COLUMNS = (
    "symbol",
    "interval",
    "open_time_ms",
    "close_time_ms",
    "trading_day",
    "open",
    "high",
    "low",
    "close",
    "volume",
    "quote_asset_volume",
    "number_of_trades",
    "taker_buy_base_volume",
    "taker_buy_quote_volume",
    "source_file",
    "ingested_at",
)


def stage_candles(
    target: DataFrame | None,
    landed: DataFrame,
    now: Column,
    order: Sequence[str] = ("updated_at", "raw_key"),
) -> tuple[DataFrame, DataFrame]:
    """``(new staging state, rejects)``: last write per candle, a known trading day is kept.

    Landing keys are raw text and two of them may clean to the same candle; the raw
    spelling settles what equal stamps leave open.
    """
    typed, rejects = clean_candles(landed)
    updates = typed.select(
        *CANDLE_COLUMNS, now.alias("staged_at"), *[c for c in order if c not in CANDLE_COLUMNS]
    )
    keys = ["symbol", "interval", "open_time_ms"]
    return merge_upsert(target, updates, keys, order, {"trading_day": "keep_if_null"}), rejects


def block_rules() -> list[Rule]:
    """Rules for landed blocks."""
    return [
        Rule("no_hash", F.coalesce(F.col("hash") != "", F.lit(False))),
        Rule("no_number", F.col("number").isNotNull()),
        Rule("no_timestamp", F.col("timestamp_unix").isNotNull()),
    ]


def clean_blocks(landed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(typed blocks, rejects)``; nested fields come out of the raw document."""
    valid, rejects = split_valid(landed, block_rules())
    number = lambda name: hex_to_long(field("raw", name))
    typed = valid.select(
        F.col("hash").alias("block_hash"),
        F.col("number").alias("block_number"),
        "timestamp_unix",
        F.col("tx_count").cast("int").alias("tx_count"),
        field("raw", "miner").alias("miner"),
        number("gasUsed").alias("gas_used"),
        number("gasLimit").alias("gas_limit"),
        number("size").try_cast("int").alias("size_bytes"),
        number("baseFeePerGas").alias("base_fee_per_gas"),
        number("blobGasUsed").alias("blob_gas_used"),
        number("excessBlobGas").alias("excess_blob_gas"),
        iso_date(F.col("ingestion_ds")).alias("ingestion_ds"),
        "ingested_at",
        "updated_at",
    )
    return typed, rejects


def stage_blocks(
    target: DataFrame | None, landed: DataFrame, now: Column, order: Sequence[str] = ("updated_at",)
) -> tuple[DataFrame, DataFrame]:
    """``(new staging state, rejects)``: last write per hash, a known landing day is kept."""
    typed, rejects = clean_blocks(landed)
    keep = [c for c in typed.columns if c != "updated_at"]
    updates = typed.select(*keep, now.alias("staged_at"), *[c for c in order if c not in keep])
    return merge_upsert(target, updates, ["block_hash"], order, {"ingestion_ds": "keep_if_null"}), rejects


def listing_rules() -> list[Rule]:
    """Rules for listed assets."""
    return [
        Rule("incomplete", F.col("is_complete")),
        Rule("no_id", F.col("crypto_id") != 0),
        Rule("blank_symbol", blank_to_null(F.col("symbol")).isNotNull()),
        Rule("blank_name", blank_to_null(F.col("name")).isNotNull()),
        Rule("symbol_too_long", F.length(F.trim("symbol")) <= SYMBOL_WIDTH),
        Rule("name_too_long", F.length(F.trim("name")) <= NAME_WIDTH),
        Rule("slug_too_long", F.col("slug").isNull() | (F.length("slug") <= SLUG_WIDTH)),
        listing_price_rule(F.col("price"), F.col("price_is_number")),
        *[
            Rule(f"out_of_range_{c}", fits(F.col(c), as_decimal(F.col(c), p, s)))
            for c, (p, s) in METRIC_DECIMALS.items()
        ],
    ]


def clean_listings(raw: DataFrame, doc: str, *keep: str) -> tuple[DataFrame, DataFrame]:
    """``(assets with typed metrics, rejects)`` out of listing documents."""
    valid, rejects = split_valid(explode_listings(raw, doc, *keep), listing_rules())
    typed = valid.select(
        *keep,
        "pos",
        "crypto_id",
        clean_symbol(F.col("symbol")).alias("symbol"),
        F.trim("name").alias("name"),
        "slug",
        iso_timestamp(F.col("last_updated")).cast("timestamp_ntz").alias("last_updated"),
        *[
            as_decimal(F.col(c), *METRIC_DECIMALS[c]).alias("price_usd" if c == "price" else c)
            for c in QUOTE_FIELDS
        ],
    )
    return typed, rejects


def stage_cryptos(target: DataFrame | None, listings: DataFrame, order: Sequence[str], now: Column) -> DataFrame:
    """Master data per asset: every later listing replaces it."""
    updates = listings.select(
        "crypto_id", "symbol", "name", "slug", "last_updated", now.alias("processed_at"), *order
    )
    return merge_upsert(target, updates, ["crypto_id"], order)


def stage_metrics(
    target: DataFrame | None, listings: DataFrame, order: Sequence[str], recorded_at: str = "recorded_at"
) -> DataFrame:
    """Metrics per (asset, recording time): the first one stays."""
    measures = ["price_usd", *[c for c in QUOTE_FIELDS if c != "price"]]
    extra = [c for c in order if c not in ("crypto_id", "recorded_at")]
    updates = listings.select("crypto_id", F.col(recorded_at).alias("recorded_at"), *measures, *extra)
    return insert_if_absent(target, updates, ["crypto_id", "recorded_at"], order).select(
        "crypto_id", "recorded_at", *measures
    )
