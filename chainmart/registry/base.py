"""Registration, and the given tables seen as candles, blocks, snapshots and assets.

``events`` supplies all three time series (by event type) and ``customer`` the listed
assets. Each shape exists twice: as a DataFrame and as the SQL of its oracle.
"""

from __future__ import annotations

import textwrap
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.analytics import Selection
from ..plans.star import build_dim_asset, build_dim_interval, seed_chains, seed_exchanges

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

START, END = "2024-01-08 00:00:00", "2024-01-22 00:00:00"
NOW = "2024-01-22 00:00:00"
SELECTION = Selection(base_symbol="FURNITURE")


def query(name: str, oracle: str | None = None):
    """Register a query and, where SQL can say the same, its oracle."""

    def register(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = textwrap.dedent(oracle).strip()
        return fn

    return register


# Schemas are declared, so building a query reads no file footers.
SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def utc(c: str | Column) -> Column:
    """``timestamp_ntz`` of the tables as a UTC timestamp."""
    return (F.col(c) if isinstance(c, str) else c).cast("timestamp")


def r6(c: str | Column) -> Column:
    """Six digits, as the oracles round."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("double"), 6)


def rounded(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: r6(c) for c in cols})


# the counter inside props, read once per expression
K = "cast(get_json_object(props, '$.k') as bigint)"


def candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged candles out of the ``view`` events."""
    return (
        table(spark, sf_dir, "events")
        .where("event_type = 'view'")
        .selectExpr(
            "event_id",
            "ts",
            "if(user_id % 4 = 0, 'BTCUSDT', 'ETHUSDT') as symbol",
            "if(event_id % 10 = 0, '5m', '1m') as interval",
            "unix_millis(cast(ts as timestamp)) as open_time_ms",
            "unix_millis(cast(ts as timestamp)) + 59999 as close_time_ms",
            "to_date(ts) as trading_day",
            "value as open",
            f"value + {K} as high",
            "value as low",
            "value as close",
            f"cast({K} as double) as volume",
            f"value * {K} as quote_asset_volume",
            f"cast({K} as int) as number_of_trades",
            "cast(null as double) as taker_buy_base_volume",
            "cast(null as double) as taker_buy_quote_volume",
            "'events' as source_file",
            "cast(ts as timestamp) as ingested_at",
        )
    )


CANDLE = """
    v_candle AS (
      SELECT event_id, ts,
             CASE WHEN user_id % 4 = 0 THEN 'BTCUSDT' ELSE 'ETHUSDT' END AS symbol,
             CASE WHEN event_id % 10 = 0 THEN '5m' ELSE '1m' END AS interval,
             epoch_us(ts) // 1000 AS open_time_ms, epoch_us(ts) // 1000 + 59999 AS close_time_ms,
             CAST(ts AS DATE) AS trading_day, value AS close,
             CAST(json_extract(props, '$.k') AS BIGINT) AS k,
             CAST(json_extract(props, '$.k') AS BIGINT) AS volume,
             value * CAST(json_extract(props, '$.k') AS BIGINT) AS quote_asset_volume
      FROM events WHERE event_type = 'view')"""


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged blocks out of the ``click`` events."""
    return (
        table(spark, sf_dir, "events")
        .where("event_type = 'click'")
        .selectExpr(
            "event_id",
            "ts",
            "concat('0x', lpad(lower(hex(event_id)), 64, '0')) as block_hash",
            "event_id as block_number",
            "unix_seconds(cast(ts as timestamp)) as timestamp_unix",
            f"cast({K} as int) as tx_count",
            "cast(null as string) as miner",
            f"{K} * 1000 as gas_used",
            "cast(null as bigint) as gas_limit",
            "cast(null as int) as size_bytes",
            "cast(round(value * 1e9) as bigint) as base_fee_per_gas",
            "cast(null as bigint) as blob_gas_used",
            "cast(null as bigint) as excess_blob_gas",
            "cast(ts as timestamp) as ingested_at",
            "to_date(ts) as ingestion_ds",
        )
    )


BLOCK = """
    v_block AS (
      SELECT event_id, ts, '0x' || lpad(lower(hex(event_id)), 64, '0') AS block_hash,
             event_id AS block_number, CAST(floor(epoch(ts)) AS BIGINT) AS timestamp_unix,
             CAST(json_extract(props, '$.k') AS BIGINT) AS tx_count,
             CAST(json_extract(props, '$.k') AS BIGINT) * 1000 AS gas_used,
             CAST(round(value * 1e9) AS BIGINT) AS base_fee_per_gas
      FROM events WHERE event_type = 'click')"""


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged market metrics out of the ``purchase`` events."""
    absent = ("percent_change_1h", "percent_change_24h", "percent_change_7d")
    absent += ("circulating_supply", "total_supply", "max_supply")
    return (
        table(spark, sf_dir, "events")
        .where("event_type = 'purchase'")
        .selectExpr(
            "user_id + 1 as crypto_id",
            "event_id as metric_id",
            "ts as recorded_at",
            "value as price_usd",
            f"value * {K} as volume_24h",
            f"if(event_id % 7 <> 0, value * {K} * 1000, null) as market_cap",
            *[f"cast(null as double) as {c}" for c in absent],
        )
    )


SNAPSHOT = """
    v_snapshot AS (
      SELECT user_id + 1 AS crypto_id, event_id AS metric_id, ts AS recorded_at, value AS price_usd,
             value * CAST(json_extract(props, '$.k') AS BIGINT) AS volume_24h,
             CASE WHEN event_id % 7 <> 0
                  THEN value * CAST(json_extract(props, '$.k') AS BIGINT) * 1000 END AS market_cap
      FROM events WHERE event_type = 'purchase')"""


def cryptos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listed assets out of ``customer``; symbols repeat on purpose."""
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey + 1 as crypto_id",
        "c_mktsegment as symbol",
        "c_name as name",
        "lower(c_name) as slug",
        "cast(null as timestamp_ntz) as last_updated",
    )


CRYPTO = """
    v_crypto AS (
      SELECT c_custkey + 1 AS crypto_id, c_mktsegment AS symbol, c_name AS name FROM customer)"""


class EventStar:
    """The shapes as a loaded star schema, one fact row per event; tables are built when asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def dim_exchange(self) -> DataFrame:
        return seed_exchanges(self.spark)

    @cached_property
    def dim_asset(self) -> DataFrame:
        return build_dim_asset(None, candles(self.spark, self.sf_dir))

    @cached_property
    def dim_interval(self) -> DataFrame:
        return build_dim_interval(None, candles(self.spark, self.sf_dir))

    @cached_property
    def dim_chain(self) -> DataFrame:
        return seed_chains(self.spark)

    @cached_property
    def dim_crypto(self) -> DataFrame:
        return cryptos(self.spark, self.sf_dir)

    @cached_property
    def fact_candle(self) -> DataFrame:
        return candles(self.spark, self.sf_dir).selectExpr(
            "xxhash64('Binance') as exchange_key",
            "xxhash64(symbol) as asset_key",
            "xxhash64(interval) as interval_key",
            "unix_micros(timestamp_millis(open_time_ms)) as open_time_key",
            "close",
            "quote_asset_volume",
        )

    @cached_property
    def fact_block(self) -> DataFrame:
        return blocks(self.spark, self.sf_dir).selectExpr(
            "xxhash64('Ethereum') as chain_key",
            "unix_micros(timestamp_seconds(timestamp_unix)) as block_time_key",
            "block_number",
            "base_fee_per_gas",
        )

    @cached_property
    def fact_snapshot(self) -> DataFrame:
        return snapshots(self.spark, self.sf_dir).selectExpr(
            "crypto_id",
            "unix_micros(cast(recorded_at as timestamp)) as time_key",
            "metric_id as staged_metric_id",
            "price_usd",
            "volume_24h",
            "market_cap",
            "percent_change_24h",
        )


def star(spark: SparkSession, sf_dir: str) -> EventStar:
    return EventStar(spark, sf_dir)


# SQL of the bucketed aggregates shared by several oracles.
WINDOW = f"ts >= TIMESTAMP '{START}' AND ts < TIMESTAMP '{END}'"
BUCKET = "date_trunc('minute', ts) - to_minutes(CAST(extract(minute FROM ts) % 10 AS BIGINT))"
PRICE = f"""
    price AS (
      SELECT {BUCKET} AS b, avg(close) AS avg_close_usdt, avg(quote_asset_volume) AS avg_volume_usdt
      FROM v_candle
      WHERE symbol = 'ETHUSDT' AND interval = '1m' AND close IS NOT NULL AND {WINDOW}
      GROUP BY 1)"""
FEE = f"""
    fee AS (
      SELECT {BUCKET} AS b, avg(CAST(base_fee_per_gas AS DOUBLE)) / 1e9 AS avg_base_fee_gwei
      FROM v_block WHERE {WINDOW} GROUP BY 1)"""
BUCKETS = f"""
    {CANDLE.strip()}, {BLOCK.strip()}, {PRICE.strip()}, {FEE.strip()},
    buckets AS (
      SELECT b AS hour_ts, avg_close_usdt, avg_volume_usdt, avg_base_fee_gwei
      FROM price JOIN fee USING (b))"""
