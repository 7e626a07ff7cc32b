"""Raw formats to rows: candle and block documents, listing documents, positional klines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import base16_to_long
from ..operators.quality import Rule, tag_rejects

# Document fields with their types. Prices stay text until staging
# decides what is numeric.
CANDLE_FIELDS = {
    "symbol": "string",
    "interval": "string",
    "open_time_ms": "bigint",
    "close_time_ms": "bigint",
    "trading_day": "string",
    "open": "string",
    "high": "string",
    "low": "string",
    "close": "string",
    "volume": "string",
    "quote_asset_volume": "string",
    "number_of_trades": "string",
    "taker_buy_base_volume": "string",
    "taker_buy_quote_volume": "string",
}
CANDLE_KEYS = ("symbol", "interval", "open_time_ms")
STAMPS = ("ingested_at", "ingestion_ds", "source_file", "updated_at", "source_ingested_at")
BLOCK_FIELDS = {
    "miner": "string",
    "gasUsed": "string",
    "gasLimit": "string",
    "size": "string",
    "baseFeePerGas": "string",
    "blobGasUsed": "string",
    "excessBlobGas": "string",
}
LISTING_FIELDS = ("id", "symbol", "name", "slug", "last_updated")
QUOTE_FIELDS = (
    "price",
    "volume_24h",
    "market_cap",
    "percent_change_1h",
    "percent_change_24h",
    "percent_change_7d",
    "circulating_supply",
    "total_supply",
    "max_supply",
)
KLINE_FIELDS = (
    "open_time_ms",
    "open",
    "high",
    "low",
    "close",
    "volume",
    "close_time_ms",
    "quote_asset_volume",
    "number_of_trades",
    "taker_buy_base_volume",
    "taker_buy_quote_volume",
)
KLINE_REQUIRED = 7


def field(doc: str, name: str, to: str = "string") -> Column:
    """A field of a VARIANT object; NULL when missing, null or not convertible."""
    return F.try_variant_get(F.col(doc), f"$.{name}", to)


def has_field(doc: str, name: str) -> Column:
    """Whether the object carries the field at all; a JSON null counts as present."""
    return F.try_variant_get(F.col(doc), f"$.{name}", "variant").isNotNull()


def open_fields(doc: str, declared: Sequence[str]) -> Column:
    """Fields of a VARIANT object that are not declared, as a map to their JSON texts; ``null`` for a JSON null."""
    every = F.try_variant_get(F.col(doc), "$", "map<string,variant>")
    others = F.map_filter(every, lambda name, _: ~name.isin(list(declared)))
    return F.transform_values(others, lambda _, value: F.to_json(value))


def parse_candles(lines: DataFrame, ingestion_ds: str | Column, now: Column) -> DataFrame:
    """Candle documents with their landing envelope and a ``reject_reason``.

    The source's own ``ingested_at`` is kept as ``source_ingested_at``; ``fields_present``
    records which fields the document carried, for the field-level merge; ``extra`` has the
    fields that are not declared, but for those whose names the landing stamps take.
    """
    rules = [
        Rule("not_an_object", F.col("doc").isNotNull()),
        *[Rule(f"missing_{k}", has_field("doc", k)) for k in CANDLE_KEYS],
    ]
    carried = [F.when(has_field("doc", f), F.lit(f)) for f in CANDLE_FIELDS]
    source_stamp = field("doc", "ingested_at")
    return tag_rejects(lines, rules).select(
        *[field("doc", f, t).alias(f) for f, t in CANDLE_FIELDS.items()],
        source_stamp.alias("source_ingested_at"),
        F.filter(
            F.array(*carried, F.when(source_stamp.isNotNull(), F.lit("source_ingested_at"))),
            lambda x: x.isNotNull(),
        ).alias("fields_present"),
        open_fields("doc", [*CANDLE_FIELDS, *STAMPS]).alias("extra"),
        now.alias("ingested_at"),
        (F.lit(ingestion_ds) if isinstance(ingestion_ds, str) else ingestion_ds).alias("ingestion_ds"),
        F.col("file_name").alias("source_file"),
        now.alias("updated_at"),
        "file_path",
        "file_block_start",
        "row_id",
        "reject_reason",
    )


def parse_blocks(lines: DataFrame, ingestion_ds: str | Column, now: Column) -> DataFrame:
    """Block documents: a small typed envelope, the raw document, and a ``reject_reason``.

    Numbers are always read as base 16 here. A missing timestamp is allowed,
    a malformed one is not.
    """
    number_hex, ts_hex = field("doc", "number"), field("doc", "timestamp")
    is_text = lambda f: F.schema_of_variant(F.try_variant_get("doc", f"$.{f}", "variant")) == "STRING"
    blank = lambda c: F.coalesce(c == "", F.lit(True))
    rules = [
        Rule("not_an_object", F.col("doc").isNotNull()),
        Rule("missing_hash", ~blank(field("doc", "hash"))),
        Rule("missing_number", ~blank(number_hex)),
        Rule("bad_number", is_text("number") & base16_to_long(number_hex).isNotNull()),
        Rule("bad_timestamp", blank(ts_hex) | (is_text("timestamp") & base16_to_long(ts_hex).isNotNull())),
    ]
    transactions = F.try_variant_get("doc", "$.transactions", "array<variant>")
    return tag_rejects(lines, rules).select(
        field("doc", "hash").alias("hash"),
        base16_to_long(number_hex).alias("number"),
        number_hex.alias("number_hex"),
        base16_to_long(ts_hex).alias("timestamp_unix"),
        F.coalesce(F.array_size(transactions), F.lit(0)).alias("tx_count"),
        F.col("doc").alias("raw"),
        now.alias("ingested_at"),
        (F.lit(ingestion_ds) if isinstance(ingestion_ds, str) else ingestion_ds).alias("ingestion_ds"),
        F.col("file_name").alias("source_file"),
        now.alias("updated_at"),
        "file_path",
        "file_block_start",
        "row_id",
        "reject_reason",
    )


def parse_listings(docs: DataFrame, *keep: str) -> DataFrame:
    """Listing documents with the number of assets each one carries; bad files give NULL."""
    return docs.select(
        *keep,
        "file_path",
        "file_name",
        F.array_size(F.try_variant_get("doc", "$.data", "array<variant>")).alias("n_assets"),
        F.col("doc").isNotNull().alias("parsed"),
    )


def explode_listings(raw: DataFrame, doc: str, *keep: str) -> DataFrame:
    """One row per listed asset (``pos`` is its place) with quote fields and presence flags."""
    items = raw.select(
        *keep, F.posexplode(F.try_variant_get(F.col(doc), "$.data", "array<variant>")).alias("pos", "item")
    )
    complete = has_field("item", "quote.USD")
    for f in LISTING_FIELDS:
        complete = complete & has_field("item", f)
    return items.select(
        *keep,
        "pos",
        complete.alias("is_complete"),
        F.schema_of_variant(F.try_variant_get("item", "$.quote.USD.price", "variant"))
        .rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$")
        .alias("price_is_number"),
        field("item", "id", "bigint").alias("crypto_id"),
        *[field("item", f).alias(f) for f in LISTING_FIELDS[1:]],
        *[field("item", f"quote.USD.{f}").alias(f) for f in QUOTE_FIELDS],
    )


def parse_klines(
    payloads: DataFrame, payload: str, now_ms: Column, keep: tuple[str, ...] = ("symbol", "interval")
) -> DataFrame:
    """Positional kline arrays to typed candles.

    Arrays shorter than the required fields and candles still open at ``now_ms`` are
    dropped; optional fields an array does not reach are NULL.
    """
    arrays = payloads.select(
        *keep, F.explode(F.from_json(F.col(payload), "array<array<string>>")).alias("k")
    ).where(F.array_size("k") >= KLINE_REQUIRED)
    types = {"open_time_ms": "bigint", "close_time_ms": "bigint", "number_of_trades": "bigint"}
    candles = arrays.select(
        *keep,
        *[
            F.get("k", F.lit(i)).try_cast(types.get(name, "double")).alias(name)
            for i, name in enumerate(KLINE_FIELDS)
        ],
    )
    return candles.where(F.col("close_time_ms") <= now_ms)
