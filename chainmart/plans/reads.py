"""Read queries over the analysis tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import at, hours_between, pearson
from .analytics import window_of


def read_bucket_range(buckets: DataFrame, start, end) -> DataFrame:
    """Buckets of the half-open window in time order."""
    return window_of(buckets, start, end).orderBy("hour_ts")


def summary_stats(buckets: DataFrame, start, end) -> DataFrame:
    """Correlations, count, time span and averages of the window as one row."""
    fee, ts = F.col("avg_base_fee_gwei"), F.col("hour_ts")
    return window_of(buckets, start, end).agg(
        pearson(F.col("avg_close_usdt"), fee).alias("corr_price_vs_base_fee"),
        pearson(F.col("avg_volume_usdt"), fee).alias("corr_volume_vs_base_fee"),
        F.count("*").alias("n_hours"),
        F.min(ts).alias("first_hour"),
        F.max(ts).alias("last_hour"),
        F.avg("avg_close_usdt").alias("avg_price"),
        F.avg("avg_volume_usdt").alias("avg_volume"),
        F.avg(fee).alias("avg_base_fee"),
        hours_between(F.min(ts), F.max(ts)).alias("span_hours"),
    )


def latest_runs(runs: DataFrame, k: int = 10, ts: str = "run_ts", tie: str | None = None) -> DataFrame:
    """The latest ``k`` runs, oldest first. Both sorts handle k rows per task at most."""
    newest = [F.col(ts).desc(), *([F.col(tie).desc()] if tie else [])]
    shown = [F.col(ts), *([F.col(tie)] if tie else [])]
    return runs.orderBy(*newest).limit(k).orderBy(*shown)


def read_daily_range(days: DataFrame, start, end) -> DataFrame:
    """Daily rows of the half-open window by date, with the (single) base symbol shown on top."""
    picked = days.where(
        (F.col("trading_date") >= at(start).cast("date")) & (F.col("trading_date") < at(end).cast("date"))
    )
    shown = picked.agg(F.min("base_symbol")).scalar()
    return picked.withColumn("shown_symbol", shown).orderBy("trading_date")


def latest_snapshot_ts(snapshots: DataFrame, start, end, ts: str = "snapshot_ts") -> DataFrame:
    """Newest snapshot time of the window, else the newest of all, else NULL; one pass."""
    inside = (F.col(ts) >= at(start)) & (F.col(ts) < at(end))
    return snapshots.agg(F.coalesce(F.max(F.when(inside, F.col(ts))), F.max(ts)).alias("snapshot_ts"))


def read_snapshot_ranked(top: DataFrame, snapshot_ts) -> DataFrame:
    """One snapshot's ranking in order; ``snapshot_ts`` may be a scalar subquery."""
    return top.where(F.col("snapshot_ts") == at(snapshot_ts)).orderBy("rank")


def latest_snapshot_count(snapshots: DataFrame, ts: str = "snapshot_ts") -> DataFrame:
    """Newest snapshot time and its number of rows."""
    return (
        snapshots.groupBy(F.col(ts).alias("snapshot_ts"))
        .agg(F.count("*").alias("n_rows"))
        .orderBy(F.col("snapshot_ts").desc())
        .limit(1)
    )


def rows_in_window(days: DataFrame, start, end, day: str = "trading_date") -> DataFrame:
    """Number of rows in the *closed* date window (both ends count)."""
    inside = F.col(day).between(at(start).cast("date"), at(end).cast("date"))
    return days.where(inside).agg(F.count("*").alias("n_rows"))
