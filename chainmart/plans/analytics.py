"""Analysis jobs over the star schema: ``(star, parameters, window) -> DataFrame``.

The clock is always an argument, so a run can be repeated. Facts are filtered on
their time key before anything else, which prunes row groups in the scan.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import at, minute_bucket, minute_ceiling, pearson, time_key
from ..operators.asof import asof_join
from ..operators.joins import scalar_key
from ..operators.merge import dedupe, merge_upsert
from .star import Star


@dataclass(frozen=True)
class Selection:
    """Which market, chain and asset an analysis looks at."""

    exchange: str = "Binance"
    asset: str = "ETHUSDT"
    interval: str = "1m"
    chain: str = "Ethereum"
    base_symbol: str = "ETH"
    bucket_minutes: int = 10

    def __post_init__(self) -> None:
        for name in ("exchange", "interval", "chain"):
            object.__setattr__(self, name, str(getattr(self, name)).strip())
        for name in ("asset", "base_symbol"):
            object.__setattr__(self, name, str(getattr(self, name)).strip().upper())


def lookback(now: dt.datetime, days: int = 30) -> tuple[dt.datetime, dt.datetime]:
    """Half-open window ``[now - days, now)``; at least one day."""
    return now - dt.timedelta(days=max(1, int(days))), now


def _in_window(key: str, start, end) -> Column:
    """Half-open window on a time key."""
    return (F.col(key) >= time_key(at(start))) & (F.col(key) < time_key(at(end)))


def _ts(key: str) -> Column:
    return F.timestamp_micros(key).cast("timestamp_ntz")


def selected_candles(star: Star, sel: Selection, start, end) -> DataFrame:
    """Candles of the selection within the window: ``(ts, close, quote_asset_volume)``.

    Each dimension is narrowed to one member, so its key is looked up as a scalar and
    compared in the scan; nothing is joined and no dimension is sent around.
    """
    exchange = scalar_key(star.dim_exchange, F.col("exchange_name") == sel.exchange, "exchange_key")
    asset = scalar_key(star.dim_asset, F.col("symbol") == sel.asset, "asset_key")
    interval = scalar_key(star.dim_interval, F.col("interval") == sel.interval, "interval_key")
    return star.fact_candle.where(
        F.col("close").isNotNull()
        & _in_window("open_time_key", start, end)
        & (F.col("asset_key") == asset)
        & (F.col("interval_key") == interval)
        & (F.col("exchange_key") == exchange)
    ).select(_ts("open_time_key").alias("ts"), "close", "quote_asset_volume")


def selected_blocks(star: Star, sel: Selection, start, end) -> DataFrame:
    """Blocks of the chain within the window: ``(ts, base_fee_per_gas)``."""
    chain = scalar_key(star.dim_chain, F.col("chain_name") == sel.chain, "chain_key")
    return star.fact_block.where(
        F.col("base_fee_per_gas").isNotNull()
        & _in_window("block_time_key", start, end)
        & (F.col("chain_key") == chain)
    ).select(_ts("block_time_key").alias("ts"), "base_fee_per_gas")


def price_by(candles: DataFrame, group: Column, name: str) -> DataFrame:
    """Average close and quote volume per group."""
    return candles.groupBy(group.alias(name)).agg(
        F.avg(F.col("close").cast("double")).alias("avg_close_usdt"),
        F.avg(F.col("quote_asset_volume").cast("double")).alias("avg_volume_usdt"),
    )


def fee_by(blocks: DataFrame, group: Column, name: str) -> DataFrame:
    """Average base fee per group, wei scaled to gwei."""
    return blocks.groupBy(group.alias(name)).agg(
        (F.avg(F.col("base_fee_per_gas").cast("double")) / F.lit(1e9)).alias("avg_base_fee_gwei")
    )


def bucket_price_fee(star: Star, sel: Selection, start, end) -> DataFrame:
    """Buckets having both a price and a fee."""
    bucket = minute_bucket(F.col("ts"), sel.bucket_minutes)
    price = price_by(selected_candles(star, sel, start, end), bucket, "hour_ts")
    fee = fee_by(selected_blocks(star, sel, start, end), bucket, "hour_ts")
    return price.join(fee, "hour_ts")


def upsert_buckets(target: DataFrame | None, buckets: DataFrame, now: Column) -> DataFrame:
    """Bucket table after a run: recomputed buckets replace their old values."""
    updates = buckets.withColumn("computed_at", now).withColumn("_o", F.lit(0))
    return merge_upsert(target, updates, ["hour_ts"], ["_o"])


def window_of(buckets: DataFrame, start, end, ts: str = "hour_ts") -> DataFrame:
    """Rows of the half-open window."""
    return buckets.where((F.col(ts) >= at(start)) & (F.col(ts) < at(end)))


def corr_run_summary(
    buckets: DataFrame, sel: Selection, start, end, now, min_rows: int = 3
) -> DataFrame:
    """The run's history row, or no row when fewer than ``min_rows`` buckets overlap."""
    fee = F.col("avg_base_fee_gwei")
    return (
        window_of(buckets, start, end)
        .agg(
            F.count("*").cast("int").alias("n_hours"),
            pearson(F.col("avg_close_usdt"), fee).alias("corr_price_vs_base_fee_gwei"),
            pearson(F.col("avg_volume_usdt"), fee).alias("corr_volume_vs_base_fee_gwei"),
        )
        .where(F.col("n_hours") >= min_rows)
        .select(
            at(now).alias("run_ts"),
            at(start).alias("window_start"),
            at(end).alias("window_end"),
            F.lit(sel.asset).alias("asset_symbol"),
            F.lit(sel.interval).alias("candle_interval"),
            F.lit(sel.exchange).alias("exchange_name"),
            F.lit(sel.chain).alias("chain_name"),
            "n_hours",
            "corr_price_vs_base_fee_gwei",
            "corr_volume_vs_base_fee_gwei",
        )
    )


def latest_per_crypto(star: Star) -> DataFrame:
    """The newest snapshot of each asset, one aggregation instead of a self-join."""
    measures = [c for c in star.fact_snapshot.columns if c not in ("crypto_id", "time_key")]
    return (
        star.fact_snapshot.groupBy("crypto_id")
        .agg(
            F.max("time_key").alias("time_key"),
            F.max_by(F.struct(*measures), F.struct("time_key", "staged_metric_id")).alias("_m"),
        )
        .select("crypto_id", "time_key", "_m.*")
    )


def top_assets(star: Star, n: int = 10) -> DataFrame:
    """Top ``n`` assets by market cap from each asset's newest snapshot.

    The limit comes first (each task keeps n rows); only those n rows are ranked.
    """
    n = max(1, int(n))
    ranking = [
        F.col("market_cap").desc_nulls_last(),
        F.col("volume_24h").desc_nulls_last(),
        F.col("symbol"),
        F.col("crypto_id"),
    ]
    described = latest_per_crypto(star).join(star.dim_crypto.select("crypto_id", "symbol", "name"), "crypto_id")
    best = described.orderBy(*ranking).limit(n)
    return best.select(
        _ts("time_key").alias("snapshot_ts"),
        F.row_number().over(Window.orderBy(*ranking)).alias("rank"),
        "crypto_id",
        "symbol",
        "name",
        "price_usd",
        "volume_24h",
        "market_cap",
        "percent_change_24h",
    )


def upsert_top_assets(target: DataFrame | None, top: DataFrame, now: Column) -> DataFrame:
    """Ranking table after a run; assets that dropped out keep their old rows."""
    updates = top.withColumn("computed_at", now).withColumn("_o", F.lit(0))
    return merge_upsert(target, updates, ["snapshot_ts", "crypto_id"], ["_o"])


def base_snapshots(star: Star, sel: Selection) -> DataFrame:
    """Snapshots of the selection's base asset: ``(ts, price_usd, market_cap, staged_metric_id)``."""
    crypto = scalar_key(star.dim_crypto, F.col("symbol") == sel.base_symbol, "crypto_id")
    return star.fact_snapshot.where(F.col("crypto_id") == crypto)


def daily_last_snapshot(star: Star, sel: Selection, start, end) -> DataFrame:
    """The last snapshot of each day of the base asset."""
    rows = base_snapshots(star, sel).where(_in_window("time_key", start, end))
    return (
        rows.groupBy(F.to_date(_ts("time_key")).alias("trading_date"))
        .agg(F.max_by(F.struct("price_usd", "market_cap"), F.struct("time_key", "staged_metric_id")).alias("_s"))
        .select(
            "trading_date",
            F.col("_s.price_usd").cast("double").alias("cmc_price_usd"),
            F.col("_s.market_cap").cast("double").alias("cmc_market_cap"),
        )
    )


def integrated_daily(star: Star, sel: Selection, start, end) -> DataFrame:
    """Days on which any of price, fee or snapshot exists."""
    day = F.to_date("ts")
    price = price_by(selected_candles(star, sel, start, end), day, "trading_date")
    fee = fee_by(selected_blocks(star, sel, start, end), day, "trading_date")
    snap = daily_last_snapshot(star, sel, start, end)
    joined = price.join(fee, "trading_date", "full_outer").join(snap, "trading_date", "full_outer")
    return joined.where(F.col("trading_date").isNotNull()).select(
        "trading_date",
        F.lit(sel.base_symbol).alias("base_symbol"),
        "cmc_price_usd",
        "cmc_market_cap",
        F.col("avg_close_usdt").alias("binance_avg_close_usdt"),
        F.col("avg_volume_usdt").alias("binance_avg_volume_usdt"),
        F.col("avg_base_fee_gwei").alias("eth_avg_base_fee_gwei"),
    )


def upsert_daily(target: DataFrame | None, days: DataFrame, now: Column) -> DataFrame:
    """Daily table after a run. The key is the date alone: another base symbol overwrites."""
    updates = days.withColumn("computed_at", now).withColumn("_o", F.lit(0))
    return merge_upsert(target, updates, ["trading_date"], ["_o"])


def bucket_spine(star: Star, sel: Selection, start, end) -> DataFrame:
    """Every bucket in which a candle or a block lies."""
    bucket = minute_bucket(F.col("ts"), sel.bucket_minutes).alias("bucket_ts")
    candles = selected_candles(star, sel, start, end).select(bucket)
    blocks = selected_blocks(star, sel, start, end).select(bucket)
    return candles.union(blocks).distinct()


def integrated_buckets(star: Star, sel: Selection, start, end) -> DataFrame:
    """Buckets with price, fee and the base asset's latest snapshot as of the bucket start.

    The full outer join of the two aggregates is the spine and both left joins in
    one step. Snapshots are first thinned to the last one per minute: buckets start
    on whole minutes, so none of the dropped ones can ever be the answer.
    """
    bucket = minute_bucket(F.col("ts"), sel.bucket_minutes)
    price = price_by(selected_candles(star, sel, start, end), bucket, "bucket_ts")
    fee = fee_by(selected_blocks(star, sel, start, end), bucket, "bucket_ts")
    spine = price.join(fee, "bucket_ts", "full_outer").where(
        (F.col("bucket_ts") >= at(start)) & (F.col("bucket_ts") < at(end))
    )
    snapshots = (
        base_snapshots(star, sel)
        .where(F.col("time_key") < time_key(at(end)))
        .groupBy(minute_ceiling(_ts("time_key")).alias("seen_at"))
        .agg(
            F.max_by(F.struct("price_usd", "market_cap"), F.struct("time_key", "staged_metric_id")).alias("_s")
        )
        .select(
            "seen_at",
            F.col("_s.price_usd").cast("double").alias("cmc_price_usd"),
            F.col("_s.market_cap").cast("double").alias("cmc_market_cap"),
        )
    )
    joined = asof_join(
        spine,
        snapshots,
        ts="bucket_ts",
        right_ts="seen_at",
        payload=["cmc_price_usd", "cmc_market_cap"],
        slot="day",
        left_is_unique=True,
    )
    return joined.select(
        "bucket_ts",
        F.lit(sel.base_symbol).alias("base_symbol"),
        "cmc_price_usd",
        "cmc_market_cap",
        F.col("avg_close_usdt").alias("binance_avg_close_usdt"),
        F.col("avg_volume_usdt").alias("binance_avg_volume_usdt"),
        F.col("avg_base_fee_gwei").alias("eth_avg_base_fee_gwei"),
    )


def recompute_touched_buckets(
    target: DataFrame, blocks: DataFrame, late: DataFrame, n: int, ts: str = "ts"
) -> DataFrame:
    """Fee buckets after late rows arrived: only buckets the late rows fall into are recomputed.

    ``blocks`` already contains the late rows; untouched buckets come from ``target``.
    """
    bucket = minute_bucket(F.col(ts), n).alias("hour_ts")
    touched = late.select(bucket).distinct()
    # buckets never leave their hour, so whole hours around the late rows suffice to read
    hour = F.expr("interval 1 hour")
    first = late.agg(F.date_trunc("hour", F.min(ts)).cast("timestamp_ntz")).scalar()
    last = late.agg(F.date_trunc("hour", F.max(ts)).cast("timestamp_ntz") + hour).scalar()
    near = blocks.where((F.col(ts) >= first) & (F.col(ts) < last))
    again = near.withColumn("hour_ts", bucket).join(touched, "hour_ts", "left_semi")
    fresh = fee_by(again, F.col("hour_ts"), "hour_ts")
    kept = target.join(touched, "hour_ts", "left_anti")
    return kept.unionByName(fresh.select(*target.columns))


def last_per_day(df: DataFrame, ts: str, tie: str) -> DataFrame:
    """The last whole row of each calendar day."""
    return dedupe(df.withColumn("trading_date", F.to_date(ts)), ["trading_date"], [ts, tie])
