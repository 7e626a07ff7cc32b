"""Star schema: six dimensions and three facts.

Surrogate keys are computed from the natural key (a hash for names, microseconds for
time), so loads need no shared counter, repeat identically after a lost executor, and
never touch the large time dimension to resolve a key.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import (
    blank_to_null,
    calendar_fields,
    clean_symbol,
    from_epoch_ms,
    from_epoch_s,
    interval_seconds,
    split_symbol,
    time_key,
)
from ..operators.joins import lookup_keys
from ..operators.merge import insert_if_absent, merge_upsert
from ..operators.quality import Rule, split_valid
from ..operators.quarantine import Lookup, resolve

# Seeded members.
EXCHANGE = "Binance"
CHAIN, CHAIN_ID = "Ethereum", 1


@dataclass(frozen=True)
class Star:
    """The tables the analysis jobs read."""

    dim_exchange: DataFrame
    dim_asset: DataFrame
    dim_interval: DataFrame
    dim_chain: DataFrame
    dim_crypto: DataFrame
    fact_candle: DataFrame
    fact_block: DataFrame
    fact_snapshot: DataFrame


def surrogate(natural: Column) -> Column:
    """Key of a name-like member."""
    return F.xxhash64(natural)


def seed_exchanges(spark: SparkSession, names: Sequence[str] = (EXCHANGE,)) -> DataFrame:
    """Exchange members to insert where absent."""
    members = F.array(*[F.struct(F.lit(n).alias("exchange_name")) for n in names])
    rows = spark.range(1).select(F.inline(members))
    return rows.select(surrogate(F.col("exchange_name")).alias("exchange_key"), "exchange_name")


def seed_chains(spark: SparkSession, chains: Sequence[tuple[str, int]] = ((CHAIN, CHAIN_ID),)) -> DataFrame:
    """Chain members to insert or update."""
    members = F.array(*[F.struct(F.lit(n).alias("chain_name"), F.lit(i).alias("chain_id")) for n, i in chains])
    rows = spark.range(1).select(F.inline(members))
    return rows.select(surrogate(F.col("chain_name")).alias("chain_key"), "chain_name", "chain_id")


def build_dim_exchange(existing: DataFrame | None, names: DataFrame) -> DataFrame:
    """Known exchanges stay, new ``exchange_name`` values are added."""
    fresh = names.select(surrogate(F.col("exchange_name")).alias("exchange_key"), "exchange_name").distinct()
    return insert_if_absent(existing, fresh, ["exchange_name"], ["exchange_key"])


def build_dim_chain(existing: DataFrame | None, chains: DataFrame) -> DataFrame:
    """Chains with the latest ``chain_id``."""
    fresh = chains.select(
        "chain_name", surrogate(F.col("chain_name")).alias("chain_key"), "chain_id", F.col("chain_id").alias("_o")
    )
    return merge_upsert(existing, fresh, ["chain_name"], ["_o"])


def build_dim_time(existing: DataFrame | None, *timestamps: tuple[DataFrame, Column]) -> DataFrame:
    """Distinct points in time of all ``(df, timestamp)`` pairs with their calendar fields."""
    points = reduce(
        DataFrame.union, [df.select(ts.cast("timestamp").alias("ts_utc")) for df, ts in timestamps]
    )
    points = points.where(F.col("ts_utc").isNotNull()).distinct()
    ts = F.col("ts_utc")
    rows = points.select(time_key(ts).alias("time_key"), ts, *calendar_fields(ts))
    return insert_if_absent(existing, rows, ["time_key"], ["time_key"]) if existing is not None else rows


def build_dim_asset(existing: DataFrame | None, candles: DataFrame) -> DataFrame:
    """Assets with their base and quote parts; a known part is never erased."""
    symbols = candles.select(clean_symbol(F.col("symbol")).alias("symbol")).distinct()
    parts = split_symbol(F.col("symbol"))
    fresh = symbols.where(F.col("symbol").isNotNull()).select(
        surrogate(F.col("symbol")).alias("asset_key"),
        "symbol",
        parts["base"].alias("base_asset"),
        parts["quote"].alias("quote_asset"),
    )
    if existing is None:
        return fresh
    return merge_upsert(
        existing,
        fresh.withColumn("_o", F.lit(0)),
        ["symbol"],
        ["_o"],
        {"base_asset": "keep_if_null", "quote_asset": "keep_if_null"},
    )


def build_dim_interval(existing: DataFrame | None, candles: DataFrame) -> DataFrame:
    """Intervals with their length; a known length is never erased."""
    names = candles.select(blank_to_null(F.col("interval")).alias("interval")).distinct()
    fresh = names.where(F.col("interval").isNotNull()).select(
        surrogate(F.col("interval")).alias("interval_key"),
        "interval",
        interval_seconds(F.col("interval")).alias("interval_seconds"),
    )
    if existing is None:
        return fresh
    return merge_upsert(
        existing, fresh.withColumn("_o", F.lit(0)), ["interval"], ["_o"], {"interval_seconds": "keep_if_null"}
    )


def build_dim_crypto(existing: DataFrame | None, cryptos: DataFrame, order: Sequence[str]) -> DataFrame:
    """Assets of the market listing; the latest description replaces the old one."""
    rows = cryptos.select(
        "crypto_id",
        clean_symbol(F.col("symbol")).alias("symbol"),
        blank_to_null(F.col("name")).alias("name"),
        F.nullif("slug", F.lit("")).alias("slug"),
        "last_updated",
        *[F.col(o).alias(f"_order_{o}") for o in order],
    ).where("symbol is not null and name is not null")
    return merge_upsert(existing, rows, ["crypto_id"], [f"_order_{o}" for o in order])


def split_candles(
    staged: DataFrame, dim_asset: DataFrame, dim_interval: DataFrame
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(ready, waiting, rejects)``: candles whose members are known, ones that wait for a member, unusable ones."""
    rules = [
        Rule("blank_symbol", clean_symbol(F.col("symbol")).isNotNull()),
        Rule("blank_interval", blank_to_null(F.col("interval")).isNotNull()),
        Rule("no_open_time", from_epoch_ms(F.col("open_time_ms")).isNotNull()),
        Rule("no_close_time", from_epoch_ms(F.col("close_time_ms")).isNotNull()),
    ]
    valid, rejects = split_valid(staged, rules)
    valid = valid.withColumns({"symbol": clean_symbol(F.col("symbol")), "interval": F.trim("interval")})
    lookups = candle_lookups(dim_asset, dim_interval)
    ready, waiting = resolve(valid, lookups)
    return ready.select(*staged.columns), waiting, rejects


def candle_lookups(dim_asset: DataFrame, dim_interval: DataFrame) -> list[Lookup]:
    return [Lookup("asset", dim_asset, "symbol", "asset_key"), Lookup("interval", dim_interval, "interval", "interval_key")]


def split_snapshots(metrics: DataFrame, cryptos: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(ready, waiting, rejects)``: metrics of described assets, ones whose asset is not described yet, unusable ones."""
    rules = [Rule("no_asset", F.col("crypto_id").isNotNull()), Rule("no_time", F.col("recorded_at").isNotNull())]
    valid, rejects = split_valid(metrics, rules)
    ready, waiting = resolve(valid, snapshot_lookups(cryptos))
    return ready.select(*metrics.columns), waiting, rejects


def snapshot_lookups(cryptos: DataFrame) -> list[Lookup]:
    described = cryptos.where(
        blank_to_null(F.col("symbol")).isNotNull() & blank_to_null(F.col("name")).isNotNull()
    ).select("crypto_id", F.col("crypto_id").alias("known_id"))
    return [Lookup("crypto", described, "crypto_id", "known_id")]


CANDLE_FACT_KEYS = ("exchange_key", "asset_key", "interval_key", "open_time_key")
CANDLE_MEASURES = (
    "open",
    "high",
    "low",
    "close",
    "volume",
    "quote_asset_volume",
    "number_of_trades",
    "taker_buy_base_volume",
    "taker_buy_quote_volume",
)


def load_fact_candle(
    existing: DataFrame | None,
    staged: DataFrame,
    dim_asset: DataFrame,
    dim_interval: DataFrame,
    order: Sequence[str],
    exchange: str = EXCHANGE,
) -> DataFrame:
    """Candle facts after the load; rows without a usable key are left out."""
    keyed = lookup_keys(
        staged.withColumn("symbol", clean_symbol(F.col("symbol"))).withColumn("interval", F.trim("interval")),
        [(dim_asset, "symbol", "asset_key"), (dim_interval, "interval", "interval_key")],
    )
    rows = keyed.select(
        surrogate(F.lit(exchange)).alias("exchange_key"),
        "asset_key",
        "interval_key",
        time_key(from_epoch_ms(F.col("open_time_ms"))).alias("open_time_key"),
        time_key(from_epoch_ms(F.col("close_time_ms"))).alias("close_time_key"),
        "trading_day",
        *CANDLE_MEASURES,
        "source_file",
        "ingested_at",
        *[F.col(o).alias(f"_order_{o}") for o in order],
    ).where("open_time_key is not null and close_time_key is not null")
    return merge_upsert(
        existing, rows, CANDLE_FACT_KEYS, [f"_order_{o}" for o in order], {"trading_day": "keep_if_null"}
    )


BLOCK_MEASURES = (
    "block_hash",
    "tx_count",
    "miner",
    "gas_used",
    "gas_limit",
    "size_bytes",
    "base_fee_per_gas",
    "blob_gas_used",
    "excess_blob_gas",
    "ingested_at",
    "ingestion_ds",
)


def load_fact_block(
    existing: DataFrame | None, staged: DataFrame, order: Sequence[str], chain: str = CHAIN
) -> DataFrame:
    """Block facts after the load: the latest row per (chain, number) wins."""
    rows = staged.select(
        surrogate(F.lit(chain)).alias("chain_key"),
        "block_number",
        time_key(from_epoch_s(F.col("timestamp_unix"))).alias("block_time_key"),
        *BLOCK_MEASURES,
        *[F.col(o).alias(f"_order_{o}") for o in order],
    ).where("block_time_key is not null")
    return merge_upsert(
        existing,
        rows,
        ["chain_key", "block_number"],
        [f"_order_{o}" for o in order],
        {"ingestion_ds": "keep_if_null"},
    )


SNAPSHOT_MEASURES = (
    "price_usd",
    "volume_24h",
    "market_cap",
    "percent_change_1h",
    "percent_change_24h",
    "percent_change_7d",
    "circulating_supply",
    "total_supply",
    "max_supply",
)


def load_fact_snapshot(existing: DataFrame | None, metrics: DataFrame, cryptos: DataFrame) -> DataFrame:
    """Market snapshots after the load: metrics of known assets, the latest id per key wins."""
    described = metrics.join(
        cryptos.where(blank_to_null(F.col("symbol")).isNotNull() & blank_to_null(F.col("name")).isNotNull()).select(
            "crypto_id"
        ),
        "crypto_id",
    )
    rows = described.select(
        "crypto_id",
        time_key(F.col("recorded_at")).alias("time_key"),
        F.col("metric_id").alias("staged_metric_id"),
        *SNAPSHOT_MEASURES,
        F.col("metric_id").alias("_order_id"),
    ).where("time_key is not null")
    return merge_upsert(existing, rows, ["crypto_id", "time_key"], ["_order_id"])
