"""Dimensions, facts and star joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import from_epoch_ms, from_epoch_s
from ..operators import lookup_keys, star_join
from ..plans import star as st
from . import base as b
from .base import BLOCK, CANDLE, CRYPTO, SNAPSHOT, query, rounded



@query(
    "dim_time_build",
    f"""
    WITH {CANDLE}, {BLOCK},
    points AS (
      SELECT make_timestamp_ms(open_time_ms) AS ts FROM v_candle
      UNION SELECT make_timestamp_ms(close_time_ms) FROM v_candle
      UNION SELECT make_timestamp_ms(timestamp_unix * 1000) FROM v_block)
    SELECT epoch_us(ts) AS time_key, ts AS ts_utc, CAST(ts AS DATE) AS date, year(ts) AS year, quarter(ts) AS quarter,
           month(ts) AS month, day(ts) AS day, hour(ts) AS hour, minute(ts) AS minute, dayofweek(ts) AS day_of_week,
           weekofyear(ts) AS week_of_year, dayofweek(ts) IN (0, 6) AS is_weekend
    FROM points
    """,
)
def dim_time_build(spark, sf_dir):
    c, k = b.candles(spark, sf_dir), b.blocks(spark, sf_dir)
    old = st.build_dim_time(None, (c, from_epoch_ms(F.col("open_time_ms"))))
    new = st.build_dim_time(
        old, (c, from_epoch_ms(F.col("close_time_ms"))), (k, from_epoch_s(F.col("timestamp_unix")))
    )
    return new.withColumn("ts_utc", F.col("ts_utc").cast("timestamp_ntz"))


@query(
    "dim_asset_build",
    f"""
    WITH {CANDLE}
    SELECT DISTINCT symbol, substr(symbol, 1, 3) AS base_asset, 'USDT' AS quote_asset FROM v_candle
    UNION ALL SELECT DISTINCT c_mktsegment, 'kept', NULL FROM customer
    """,
)
def dim_asset_build(spark, sf_dir):
    """Market segments do not split, so what is known about them must survive the update."""
    segments = b.table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("symbol"))
    old = st.build_dim_asset(None, segments).withColumn("base_asset", F.lit("kept"))
    seen = b.candles(spark, sf_dir).select("symbol").unionByName(segments)
    return st.build_dim_asset(old, seen).drop("asset_key")


@query(
    "dim_interval_build",
    """
    SELECT DISTINCT p_size || 'm' AS interval, CAST(p_size * 60 AS INTEGER) AS interval_seconds FROM part
    UNION ALL SELECT DISTINCT p_type, CAST(7 AS INTEGER) FROM part
    """,
)
def dim_interval_build(spark, sf_dir):
    part = b.table(spark, sf_dir, "part")
    types = part.select(F.col("p_type").alias("interval"))
    old = st.build_dim_interval(None, types).withColumn("interval_seconds", F.lit(7))
    seen = part.select(F.concat(F.col("p_size").cast("string"), F.lit("m ")).alias("interval")).unionByName(types)
    return st.build_dim_interval(old, seen).drop("interval_key")


@query(
    "dim_crypto_build",
    f"WITH {CRYPTO} SELECT crypto_id, upper(symbol) AS symbol, name, lower(name) AS slug FROM v_crypto",
)
def dim_crypto_build(spark, sf_dir):
    assets = b.cryptos(spark, sf_dir)
    old = st.build_dim_crypto(None, assets.withColumn("name", F.lit("old name")), ["crypto_id"])
    fresh = assets.select("crypto_id", F.lower("symbol").alias("symbol"), "name", "slug", "last_updated")
    return st.build_dim_crypto(old, fresh, ["crypto_id"]).drop("last_updated")


@query(
    "dim_seed",
    """
    SELECT DISTINCT 'exchange' AS kind, n_name AS name, CAST(NULL AS INTEGER) AS id FROM nation
    UNION ALL SELECT 'exchange', 'Binance', NULL
    UNION ALL SELECT 'chain', 'Ethereum', 1
    UNION ALL SELECT 'chain', n_name, n_nationkey + 100 FROM nation
    """,
)
def dim_seed(spark, sf_dir):
    """Seeding on top of members that exist: exchanges stay, chains take the new id."""
    nation = b.table(spark, sf_dir, "nation")
    exchanges = nation.select(F.col("n_name").alias("exchange_name"))
    exchanges = st.build_dim_exchange(st.build_dim_exchange(None, exchanges), st.seed_exchanges(spark))
    chains = nation.select(F.col("n_name").alias("chain_name"), F.col("n_nationkey").alias("chain_id"))
    old = st.build_dim_chain(st.build_dim_chain(None, chains), st.seed_chains(spark))
    chains = st.build_dim_chain(old, chains.withColumn("chain_id", F.col("chain_id") + 100))
    return (
        exchanges.select(F.lit("exchange").alias("kind"), F.col("exchange_name").alias("name"))
        .withColumn("id", F.lit(None).cast("int"))
        .unionByName(chains.select(F.lit("chain").alias("kind"), F.col("chain_name").alias("name"), F.col("chain_id").alias("id")))
    )


STARRED = f"""
    {CANDLE.strip()},
    starred AS (
      SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'Elsewhere' ELSE 'Binance' END AS exchange_name, symbol,
             substr(symbol, 1, 3) AS base_asset, interval, CASE interval WHEN '1m' THEN 60 ELSE 300 END AS interval_seconds,
             make_timestamp_ms(open_time_ms) AS ts_utc, dayofweek(ts) IN (0, 6) AS is_weekend, close
      FROM v_candle)"""


def _starred(spark, sf_dir, exchange=None, symbol=None, interval=None):
    """Candles of two exchanges joined with their dimensions, each narrowed where a value is given."""
    c = b.candles(spark, sf_dir).withColumn(
        "exchange_name", F.when(F.col("event_id") % 3 == 0, "Elsewhere").otherwise("Binance")
    )
    fact = c.select(
        "event_id",
        st.surrogate(F.col("exchange_name")).alias("exchange_key"),
        st.surrogate(F.col("symbol")).alias("asset_key"),
        st.surrogate(F.col("interval")).alias("interval_key"),
        st.time_key(from_epoch_ms(F.col("open_time_ms"))).alias("time_key"),
        "close",
    )
    exchanges = st.build_dim_exchange(st.build_dim_exchange(None, c), st.seed_exchanges(spark))
    only = lambda dim, col, value: dim if value is None else dim.where(F.col(col) == value)
    joined = star_join(
        fact,
        [
            (only(exchanges, "exchange_name", exchange), "exchange_key"),
            (only(st.build_dim_asset(None, c), "symbol", symbol), "asset_key"),
            (only(st.build_dim_interval(None, c), "interval", interval), "interval_key"),
            (st.build_dim_time(None, (c, from_epoch_ms(F.col("open_time_ms")))), "time_key"),
        ],
    )
    return joined.select(
        "event_id",
        "exchange_name",
        "symbol",
        "base_asset",
        "interval",
        "interval_seconds",
        F.col("ts_utc").cast("timestamp_ntz").alias("ts_utc"),
        "is_weekend",
        "close",
    )


@query("star_join_candles", f"WITH {STARRED} SELECT * FROM starred")
def star_join_candles(spark, sf_dir):
    return _starred(spark, sf_dir)


@query(
    "star_join_filtered",
    f"""
    WITH {STARRED}
    SELECT * FROM starred WHERE exchange_name = 'Binance' AND symbol = 'ETHUSDT' AND interval = '1m'
    """,
)
def star_join_filtered(spark, sf_dir):
    return _starred(spark, sf_dir, exchange="Binance", symbol="ETHUSDT", interval="1m")


@query(
    "star_join_wide",
    """
    SELECT n_name, p_brand, year(o_orderdate) AS order_year, count(*) AS n_lines,
           round(CAST(sum(CAST(l_extendedprice AS DECIMAL(12, 2)) * (1 - CAST(l_discount AS DECIMAL(4, 2)))) AS DOUBLE), 4) AS revenue
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey
         JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey
    GROUP BY ALL
    """,
)
def star_join_wide(spark, sf_dir):
    t = lambda name: b.table(spark, sf_dir, name)
    fact = t("lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"),
        F.col("l_partkey").alias("p_partkey"),
        F.col("l_suppkey").alias("s_suppkey"),
        (F.col("l_extendedprice").cast("decimal(12,2)") * (1 - F.col("l_discount").cast("decimal(4,2)"))).alias("net"),
    )
    suppliers = t("supplier").join(t("nation"), F.col("s_nationkey") == F.col("n_nationkey")).select(
        "s_suppkey", "n_name"
    )
    joined = star_join(
        fact,
        [
            (t("part").select("p_partkey", "p_brand"), "p_partkey"),
            (suppliers, "s_suppkey"),
            (t("orders").select("o_orderkey", "o_orderdate"), "o_orderkey"),
        ],
    )
    return joined.groupBy("n_name", "p_brand", F.year("o_orderdate").alias("order_year")).agg(
        F.count("*").alias("n_lines"), F.round(F.sum("net").cast("double"), 4).alias("revenue")
    )


@query(
    "lookup_keys_missed",
    f"""
    WITH {SNAPSHOT}
    SELECT metric_id, symbol FROM v_snapshot
    JOIN (SELECT c_custkey + 1 AS crypto_id, c_mktsegment AS symbol FROM customer WHERE c_acctbal > 0) USING (crypto_id)
    """,
)
def lookup_keys_missed(spark, sf_dir):
    """Rows whose asset is unknown (here: customers in debt) drop out."""
    known = b.table(spark, sf_dir, "customer").where("c_acctbal > 0").select(
        (F.col("c_custkey") + 1).alias("crypto_id"), F.col("c_mktsegment").alias("symbol")
    )
    return lookup_keys(b.snapshots(spark, sf_dir), [(known, "crypto_id", "symbol")]).select("metric_id", "symbol")


@query(
    "fact_candle_load",
    f"""
    WITH {CANDLE}
    SELECT symbol, interval, epoch_us(make_timestamp_ms(open_time_ms)) AS open_time_key,
           epoch_us(make_timestamp_ms(close_time_ms)) AS close_time_key, trading_day, close,
           round(quote_asset_volume, 6) AS quote_asset_volume, CAST(k AS INTEGER) AS number_of_trades
    FROM v_candle
    QUALIFY row_number() OVER (PARTITION BY symbol, interval, open_time_ms ORDER BY event_id DESC) = 1
    """,
)
def fact_candle_load(spark, sf_dir):
    """A second load restates every third candle without its day, which must survive."""
    c = b.candles(spark, sf_dir)
    asset, interval = st.build_dim_asset(None, c), st.build_dim_interval(None, c)
    first = c.withColumn("close", F.col("close") + F.when(F.col("event_id") % 3 == 0, 1.0).otherwise(0.0))
    old = st.load_fact_candle(None, first, asset, interval, ["event_id"])
    again = c.where(F.col("event_id") % 3 == 0).withColumn("trading_day", F.lit(None).cast("date"))
    fact = st.load_fact_candle(old, again, asset, interval, ["event_id"])
    named = star_join(fact, [(asset, "asset_key"), (interval, "interval_key")])
    return rounded(
        named.select(
            "symbol",
            "interval",
            "open_time_key",
            "close_time_key",
            "trading_day",
            "close",
            "quote_asset_volume",
            "number_of_trades",
        ),
        "quote_asset_volume",
    )


@query(
    "fact_block_load",
    f"""
    WITH {BLOCK}
    SELECT block_number, timestamp_unix * 1000000 AS block_time_key, block_hash, CAST(tx_count AS INTEGER) AS tx_count,
           gas_used, base_fee_per_gas, CAST(ts AS DATE) AS ingestion_ds FROM v_block
    """,
)
def fact_block_load(spark, sf_dir):
    """The first load saw other hashes (a re-organised chain); the later row per number wins."""
    k = b.blocks(spark, sf_dir)
    old = st.load_fact_block(None, k.withColumn("block_hash", F.reverse("block_hash")), ["ts", "event_id"])
    fact = st.load_fact_block(old, k.withColumn("ingestion_ds", F.lit(None).cast("date")), ["ts", "event_id"])
    return fact.select(
        "block_number", "block_time_key", "block_hash", "tx_count", "gas_used", "base_fee_per_gas", "ingestion_ds"
    )


@query(
    "fact_snapshot_load",
    f"""
    WITH {SNAPSHOT}, {CRYPTO}
    SELECT crypto_id, epoch_us(recorded_at) AS time_key, metric_id AS staged_metric_id, price_usd,
           round(volume_24h, 6) AS volume_24h, round(market_cap, 6) AS market_cap
    FROM v_snapshot JOIN v_crypto USING (crypto_id)
    QUALIFY row_number() OVER (PARTITION BY crypto_id, recorded_at ORDER BY metric_id DESC) = 1
    """,
)
def fact_snapshot_load(spark, sf_dir):
    fact = st.load_fact_snapshot(None, b.snapshots(spark, sf_dir), b.cryptos(spark, sf_dir))
    return rounded(
        fact.select("crypto_id", "time_key", "staged_metric_id", "price_usd", "volume_24h", "market_cap"),
        "volume_24h",
        "market_cap",
    )
