"""Analysis jobs, statistics and read queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import at, corr_band, minute_bucket, pearson
from ..operators import asof_join, describe, exact_quantiles, regression_line
from ..plans import analytics as an
from ..plans import reads
from . import base as b
from .base import BLOCK, BUCKETS, CANDLE, CRYPTO, END, FEE, NOW, PRICE, SELECTION, SNAPSHOT, START, query, r6, rounded

AVERAGES = ("avg_close_usdt", "avg_volume_usdt", "avg_base_fee_gwei")
ROUNDED_BUCKET = """hour_ts, round(avg_close_usdt, 6) AS avg_close_usdt,
       round(avg_volume_usdt, 6) AS avg_volume_usdt, round(avg_base_fee_gwei, 6) AS avg_base_fee_gwei"""
INTEGRATED = (
    "cmc_price_usd",
    "cmc_market_cap",
    "binance_avg_close_usdt",
    "binance_avg_volume_usdt",
    "eth_avg_base_fee_gwei",
)


def _buckets(spark, sf_dir):
    return an.bucket_price_fee(b.star(spark, sf_dir), SELECTION, START, END)


@query(
    "integrated_buckets",
    f"""
    WITH {CANDLE}, {BLOCK}, {SNAPSHOT}, {CRYPTO}, {PRICE}, {FEE},
    spine AS (SELECT b FROM price UNION SELECT b FROM fee),
    snaps AS (
      SELECT recorded_at, price_usd, market_cap FROM v_snapshot
      WHERE crypto_id = (SELECT min(crypto_id) FROM v_crypto WHERE symbol = 'FURNITURE')
        AND recorded_at < TIMESTAMP '{END}')
    SELECT s.b AS bucket_ts, 'FURNITURE' AS base_symbol,
           round(c.price_usd, 6) AS cmc_price_usd, round(c.market_cap, 6) AS cmc_market_cap,
           round(p.avg_close_usdt, 6) AS binance_avg_close_usdt,
           round(p.avg_volume_usdt, 6) AS binance_avg_volume_usdt,
           round(f.avg_base_fee_gwei, 6) AS eth_avg_base_fee_gwei
    FROM spine s LEFT JOIN price p USING (b) LEFT JOIN fee f USING (b)
    ASOF LEFT JOIN snaps c ON c.recorded_at <= s.b
    WHERE s.b >= TIMESTAMP '{START}' AND s.b < TIMESTAMP '{END}'
    """,
)
def integrated_buckets(spark, sf_dir):
    return rounded(an.integrated_buckets(b.star(spark, sf_dir), SELECTION, START, END), *INTEGRATED)


@query("bucket_price_fee", f"WITH {BUCKETS} SELECT {ROUNDED_BUCKET} FROM buckets")
def bucket_price_fee(spark, sf_dir):
    return rounded(_buckets(spark, sf_dir), *AVERAGES)


@query(
    "bucket_spine",
    f"""
    WITH {CANDLE}, {BLOCK}, {PRICE}, {FEE}
    SELECT b AS bucket_ts FROM price UNION SELECT b AS bucket_ts FROM fee
    """,
)
def bucket_spine(spark, sf_dir):
    return an.bucket_spine(b.star(spark, sf_dir), SELECTION, START, END)


@query(
    "asof_snapshot",
    f"""
    WITH {CANDLE}, {SNAPSHOT},
    points AS (
      SELECT DISTINCT event_id % 5 AS grp,
             date_trunc('minute', ts) - to_minutes(CAST(extract(minute FROM ts) % 10 AS BIGINT)) AS bucket_ts
      FROM v_candle),
    quotes AS (
      SELECT crypto_id % 5 AS grp, recorded_at, metric_id, price_usd, market_cap FROM v_snapshot
      QUALIFY row_number() OVER (PARTITION BY crypto_id % 5, recorded_at ORDER BY metric_id DESC) = 1)
    SELECT p.grp, p.bucket_ts, q.metric_id, q.price_usd, round(q.market_cap, 6) AS market_cap
    FROM points p ASOF LEFT JOIN quotes q ON p.grp = q.grp AND q.recorded_at <= p.bucket_ts
    """,
)
def asof_snapshot(spark, sf_dir):
    points = (
        b.candles(spark, sf_dir)
        .select((F.col("event_id") % 5).alias("grp"), minute_bucket(F.col("ts"), 10).alias("bucket_ts"))
        .distinct()
    )
    quotes = b.snapshots(spark, sf_dir).withColumn("grp", F.col("crypto_id") % 5)
    joined = asof_join(
        points,
        quotes,
        ts="bucket_ts",
        right_ts="recorded_at",
        payload=["metric_id", "price_usd", "market_cap"],
        by=["grp"],
        tie="metric_id",
        left_is_unique=True,
    )
    return rounded(joined, "market_cap")


@query(
    "asof_candles",
    f"""
    WITH {CANDLE}, {SNAPSHOT},
    quotes AS (
      SELECT recorded_at, metric_id, price_usd FROM v_snapshot
      QUALIFY row_number() OVER (PARTITION BY recorded_at ORDER BY metric_id DESC) = 1)
    SELECT c.event_id, c.symbol, c.ts, q.metric_id, q.price_usd
    FROM v_candle c ASOF LEFT JOIN quotes q ON q.recorded_at <= c.ts
    """,
)
def asof_candles(spark, sf_dir):
    """Every candle with the market's latest snapshot: one key holds all rows."""
    left = b.candles(spark, sf_dir).select("event_id", "symbol", "ts")
    return asof_join(
        left,
        b.snapshots(spark, sf_dir),
        ts="ts",
        right_ts="recorded_at",
        payload=["metric_id", "price_usd"],
        tie="metric_id",
    )


DAILY = f"""
    {CANDLE.strip()}, {BLOCK.strip()}, {SNAPSHOT.strip()}, {CRYPTO.strip()},
    price AS (
      SELECT CAST(ts AS DATE) AS d, avg(close) AS c, avg(quote_asset_volume) AS v FROM v_candle
      WHERE symbol = 'ETHUSDT' AND interval = '1m' AND {b.WINDOW} GROUP BY 1),
    fee AS (
      SELECT CAST(ts AS DATE) AS d, avg(CAST(base_fee_per_gas AS DOUBLE)) / 1e9 AS g
      FROM v_block WHERE {b.WINDOW} GROUP BY 1),
    snap AS (
      SELECT DISTINCT ON (CAST(recorded_at AS DATE)) CAST(recorded_at AS DATE) AS d, price_usd, market_cap
      FROM v_snapshot
      WHERE crypto_id = (SELECT min(crypto_id) FROM v_crypto WHERE symbol = 'FURNITURE')
        AND recorded_at >= TIMESTAMP '{START}' AND recorded_at < TIMESTAMP '{END}'
      ORDER BY CAST(recorded_at AS DATE), recorded_at DESC, metric_id DESC)"""
DAILY_COLUMNS = """d AS trading_date, 'FURNITURE' AS base_symbol,
       round(price_usd, 6) AS cmc_price_usd, round(market_cap, 6) AS cmc_market_cap,
       round(c, 6) AS binance_avg_close_usdt, round(v, 6) AS binance_avg_volume_usdt,
       round(g, 6) AS eth_avg_base_fee_gwei"""


@query(
    "integrated_daily",
    f"WITH {DAILY} SELECT {DAILY_COLUMNS} FROM price FULL JOIN fee USING (d) FULL JOIN snap USING (d)",
)
def integrated_daily(spark, sf_dir):
    return rounded(an.integrated_daily(b.star(spark, sf_dir), SELECTION, START, END), *INTEGRATED)


@query(
    "daily_last_snapshot",
    f"""
    WITH {SNAPSHOT}
    SELECT DISTINCT ON (CAST(recorded_at AS DATE)) CAST(recorded_at AS DATE) AS trading_date,
           crypto_id, metric_id, recorded_at, price_usd, round(market_cap, 6) AS market_cap
    FROM v_snapshot ORDER BY CAST(recorded_at AS DATE), recorded_at DESC, metric_id DESC
    """,
)
def daily_last_snapshot(spark, sf_dir):
    last = an.last_per_day(b.snapshots(spark, sf_dir), "recorded_at", "metric_id")
    return rounded(
        last.select("trading_date", "crypto_id", "metric_id", "recorded_at", "price_usd", "market_cap"),
        "market_cap",
    )


TOP = f"""
    {SNAPSHOT.strip()}, {CRYPTO.strip()},
    latest AS (
      SELECT * FROM v_snapshot
      QUALIFY row_number() OVER (PARTITION BY crypto_id ORDER BY recorded_at DESC, metric_id DESC) = 1),
    ranked AS (
      SELECT recorded_at AS snapshot_ts,
             row_number() OVER (ORDER BY market_cap DESC NULLS LAST, volume_24h DESC NULLS LAST,
                                symbol, crypto_id) AS rank,
             crypto_id, symbol, name, price_usd, volume_24h, market_cap
      FROM latest JOIN v_crypto USING (crypto_id))"""
TOP_COLUMNS = """snapshot_ts, rank, crypto_id, symbol, name, price_usd,
       round(volume_24h, 6) AS volume_24h, round(market_cap, 6) AS market_cap"""


def _top(spark, sf_dir, n=10):
    return an.top_assets(b.star(spark, sf_dir), n).drop("percent_change_24h")


@query("top_assets", f"WITH {TOP} SELECT {TOP_COLUMNS} FROM ranked WHERE rank <= 10")
def top_assets(spark, sf_dir):
    return rounded(_top(spark, sf_dir), "volume_24h", "market_cap")


@query(
    "top_assets_upsert",
    f"""
    WITH {TOP}, old AS (
      SELECT snapshot_ts, rank + 100 AS rank, crypto_id, symbol, 'old' AS name, price_usd, volume_24h, market_cap
      FROM ranked WHERE rank <= 25),
    new AS (SELECT * FROM ranked WHERE rank <= 10),
    merged AS (
      SELECT * FROM new UNION ALL
      SELECT * FROM old WHERE (snapshot_ts, crypto_id) NOT IN (SELECT (snapshot_ts, crypto_id) FROM new))
    SELECT {TOP_COLUMNS} FROM merged
    """,
)
def top_assets_upsert(spark, sf_dir):
    """The ranking table after two runs: what fell out of the top ten stays."""
    old = an.upsert_top_assets(
        None, _top(spark, sf_dir, 25).withColumns({"rank": F.col("rank") + 100, "name": F.lit("old")}), at(START)
    )
    merged = an.upsert_top_assets(old, _top(spark, sf_dir, 10), at(NOW))
    return rounded(merged.drop("computed_at"), "volume_24h", "market_cap")


def _corr(x: str) -> str:
    expr = f"corr({x}, avg_base_fee_gwei)"
    return f"CASE WHEN isnan({expr}) THEN NULL ELSE round({expr}, 6) END"


@query(
    "corr_price_volume_fee",
    f"""
    WITH {BUCKETS}
    SELECT {_corr('avg_close_usdt')} AS corr_price_vs_base_fee,
           {_corr('avg_volume_usdt')} AS corr_volume_vs_base_fee FROM buckets
    """,
)
def corr_price_volume_fee(spark, sf_dir):
    fee = F.col("avg_base_fee_gwei")
    return _buckets(spark, sf_dir).agg(
        r6(pearson(F.col("avg_close_usdt"), fee)).alias("corr_price_vs_base_fee"),
        r6(pearson(F.col("avg_volume_usdt"), fee)).alias("corr_volume_vs_base_fee"),
    )


@query(
    "summary_stats",
    f"""
    WITH {BUCKETS}
    SELECT {_corr('avg_close_usdt')} AS corr_price_vs_base_fee,
           {_corr('avg_volume_usdt')} AS corr_volume_vs_base_fee,
           count(*) AS n_hours, min(hour_ts) AS first_hour, max(hour_ts) AS last_hour,
           round(avg(avg_close_usdt), 6) AS avg_price, round(avg(avg_volume_usdt), 6) AS avg_volume,
           round(avg(avg_base_fee_gwei), 6) AS avg_base_fee,
           round(epoch(max(hour_ts) - min(hour_ts)) / 3600.0, 6) AS span_hours
    FROM buckets
    """,
)
def summary_stats(spark, sf_dir):
    stats = reads.summary_stats(_buckets(spark, sf_dir), START, END)
    return rounded(
        stats,
        "corr_price_vs_base_fee",
        "corr_volume_vs_base_fee",
        "avg_price",
        "avg_volume",
        "avg_base_fee",
        "span_hours",
    )


RUN_SUMMARY = f"""
    SELECT TIMESTAMP '{NOW}' AS run_ts, TIMESTAMP '{START}' AS window_start, TIMESTAMP '{END}' AS window_end,
           'ETHUSDT' AS asset_symbol, '1m' AS candle_interval, 'Binance' AS exchange_name,
           'Ethereum' AS chain_name, CAST(count(*) AS INTEGER) AS n_hours,
           {_corr('avg_close_usdt')} AS corr_price_vs_base_fee_gwei,
           {_corr('avg_volume_usdt')} AS corr_volume_vs_base_fee_gwei
    FROM buckets HAVING count(*) >= 3"""


@query("corr_run_summary", f"WITH {BUCKETS} {RUN_SUMMARY}")
def corr_run_summary(spark, sf_dir):
    run = an.corr_run_summary(_buckets(spark, sf_dir), SELECTION, START, END, NOW)
    return rounded(run, "corr_price_vs_base_fee_gwei", "corr_volume_vs_base_fee_gwei")


MEASURES = [
    f"""SELECT '{m}' AS measure, count({m}) AS count, round(avg({m}), 6) AS mean,
           round(stddev_samp({m}), 6) AS std, round(min({m}), 6) AS min,
           round(quantile_cont({m}, 0.25), 6) AS p25, round(quantile_cont({m}, 0.5), 6) AS p50,
           round(quantile_cont({m}, 0.75), 6) AS p75, round(max({m}), 6) AS max FROM buckets"""
    for m in AVERAGES
]


@query("describe_measures", f"WITH {BUCKETS} " + " UNION ALL ".join(MEASURES))
def describe_measures(spark, sf_dir):
    buckets = _buckets(spark, sf_dir).select(*AVERAGES).persist()
    try:
        out = describe(buckets, AVERAGES)
    finally:
        buckets.unpersist()
    return rounded(out, "mean", "std", "min", "p25", "p50", "p75", "max")


@query(
    "describe_lineitem",
    " UNION ALL ".join(
        f"""SELECT '{m}' AS measure, CAST({p} AS DOUBLE) AS p, count({m}) AS n,
               round(quantile_cont({m}, {p}), 6) AS value FROM lineitem"""
        for m in ("l_extendedprice", "l_quantity")
        for p in (0.01, 0.25, 0.5, 0.75, 0.99)
    ),
)
def describe_lineitem(spark, sf_dir):
    """Exact quantiles of raw measures, one of them with few distinct values."""
    out = exact_quantiles(
        b.table(spark, sf_dir, "lineitem"), ["l_extendedprice", "l_quantity"], (0.01, 0.25, 0.5, 0.75, 0.99)
    )
    return rounded(out, "value")


RAW = ["l_extendedprice", "l_quantity", "l_discount"]


@query(
    "describe_lineitem_summary",
    " UNION ALL ".join(
        f"""SELECT '{m}' AS measure, count({m}) AS count, round(avg({m}), 4) AS mean, round(stddev_samp({m}), 4) AS std,
               round(min({m}), 4) AS min, round(quantile_cont({m}, 0.25), 4) AS p25, round(quantile_cont({m}, 0.5), 4) AS p50,
               round(quantile_cont({m}, 0.75), 4) AS p75, round(max({m}), 4) AS max FROM lineitem"""
        for m in RAW
    ),
)
def describe_lineitem_summary(spark, sf_dir):
    """Count, mean, deviation, extremes and exact quartiles of raw measures."""
    out = describe(b.table(spark, sf_dir, "lineitem"), RAW)
    return out.select("measure", "count", *[F.round(c, 4).alias(c) for c in out.columns[2:]])


@query(
    "regression_line",
    f"""
    WITH {BUCKETS},
    fit AS (
      SELECT regr_slope(avg_base_fee_gwei, avg_close_usdt) AS s,
             regr_intercept(avg_base_fee_gwei, avg_close_usdt) AS i,
             count(*) AS n, min(avg_close_usdt) AS lo, max(avg_close_usdt) AS hi FROM buckets)
    SELECT CAST(p AS INTEGER) AS point, round(lo + (hi - lo) * p / 99.0, 6) AS x,
           CASE WHEN isnan(s) THEN NULL ELSE round(s * (lo + (hi - lo) * p / 99.0) + i, 6) END AS y,
           CASE WHEN isnan(s) THEN NULL ELSE round(s, 6) END AS slope,
           CASE WHEN isnan(s) THEN NULL ELSE round(i, 6) END AS intercept, n
    FROM fit, range(100) t(p) WHERE n >= 2
    """,
)
def regression_line_query(spark, sf_dir):
    line = regression_line(_buckets(spark, sf_dir), "avg_close_usdt", "avg_base_fee_gwei")
    return rounded(line, "x", "y", "slope", "intercept")


@query(
    "latest_snapshot_count",
    f"""
    WITH {SNAPSHOT}
    SELECT date_trunc('day', recorded_at) AS snapshot_ts, count(*) AS n_rows FROM v_snapshot
    GROUP BY 1 ORDER BY 1 DESC LIMIT 1
    """,
)
def latest_snapshot_count(spark, sf_dir):
    days = b.snapshots(spark, sf_dir).select(
        F.date_trunc("day", "recorded_at").cast("timestamp_ntz").alias("snapshot_ts")
    )
    return reads.latest_snapshot_count(days)


@query(
    "latest_snapshot_ts",
    f"""
    WITH {SNAPSHOT}
    SELECT 'inside' AS asked, max(recorded_at) AS snapshot_ts FROM v_snapshot
    WHERE recorded_at >= TIMESTAMP '{START}' AND recorded_at < TIMESTAMP '{END}'
    UNION ALL
    SELECT 'fallback', max(recorded_at) FROM v_snapshot
    """,
)
def latest_snapshot_ts(spark, sf_dir):
    snaps = b.snapshots(spark, sf_dir)
    pick = lambda name, start, end: reads.latest_snapshot_ts(snaps, start, end, "recorded_at").select(
        F.lit(name).alias("asked"), "snapshot_ts"
    )
    empty = ("2030-01-01 00:00:00", "2030-02-01 00:00:00")
    return pick("inside", START, END).unionByName(pick("fallback", *empty))


@query(
    "rows_in_window",
    f"""
    WITH {SNAPSHOT}
    SELECT count(*) AS n_rows FROM v_snapshot
    WHERE CAST(recorded_at AS DATE) BETWEEN DATE '{START[:10]}' AND DATE '{END[:10]}'
    """,
)
def rows_in_window(spark, sf_dir):
    days = b.snapshots(spark, sf_dir).select(F.to_date("recorded_at").alias("trading_date"))
    return reads.rows_in_window(days, START, END)


@query(
    "latest_runs",
    """
    SELECT o_orderkey AS run_key, o_orderdate AS run_ts, o_totalprice FROM orders
    ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 20
    """,
)
def latest_runs(spark, sf_dir):
    runs = b.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("run_key"), F.col("o_orderdate").alias("run_ts"), "o_totalprice"
    )
    return reads.latest_runs(runs, 20, tie="run_key")


@query(
    "read_bucket_range",
    f"""
    WITH {BUCKETS} SELECT {ROUNDED_BUCKET} FROM buckets
    WHERE hour_ts >= TIMESTAMP '2024-01-10 00:00:00' AND hour_ts < TIMESTAMP '2024-01-15 00:00:00'
    ORDER BY hour_ts
    """,
)
def read_bucket_range(spark, sf_dir):
    picked = reads.read_bucket_range(_buckets(spark, sf_dir), "2024-01-10 00:00:00", "2024-01-15 00:00:00")
    return rounded(picked, *AVERAGES)


@query(
    "read_daily_range",
    f"""
    WITH {DAILY}, days AS (
      SELECT {DAILY_COLUMNS} FROM price FULL JOIN fee USING (d) FULL JOIN snap USING (d))
    SELECT *, 'FURNITURE' AS shown_symbol FROM days
    WHERE trading_date >= DATE '2024-01-10' AND trading_date < DATE '2024-01-15' ORDER BY trading_date
    """,
)
def read_daily_range(spark, sf_dir):
    days = an.integrated_daily(b.star(spark, sf_dir), SELECTION, START, END)
    picked = reads.read_daily_range(days, "2024-01-10 00:00:00", "2024-01-15 00:00:00")
    return rounded(picked, *INTEGRATED)


@query(
    "read_snapshot_ranked",
    f"""
    WITH {TOP}, stored AS (SELECT * FROM ranked WHERE rank <= 25)
    SELECT {TOP_COLUMNS} FROM stored
    WHERE snapshot_ts = (SELECT max(snapshot_ts) FROM stored) ORDER BY rank
    """,
)
def read_snapshot_ranked(spark, sf_dir):
    stored = _top(spark, sf_dir, 25)
    newest = stored.agg(F.max("snapshot_ts")).scalar()
    return rounded(reads.read_snapshot_ranked(stored, newest), "volume_24h", "market_cap")


@query(
    "corr_band_by_day",
    f"""
    WITH {BUCKETS},
    daily AS (
      SELECT CAST(hour_ts AS DATE) AS trading_date, corr(avg_close_usdt, avg_base_fee_gwei) AS r
      FROM buckets GROUP BY 1)
    SELECT trading_date, CASE WHEN isnan(r) THEN NULL ELSE round(r, 6) END AS r,
           CASE WHEN r IS NULL OR isnan(r) THEN 'N/A'
                WHEN round(r, 6) >= 0.7 AND round(r, 6) < 1 THEN 'strong positive'
                WHEN round(r, 6) >= 0.3 AND round(r, 6) < 0.7 THEN 'moderate positive'
                WHEN round(r, 6) >= -0.3 AND round(r, 6) < 0.3 THEN 'weak'
                WHEN round(r, 6) >= -0.7 AND round(r, 6) < -0.3 THEN 'moderate negative'
                WHEN round(r, 6) >= -1 AND round(r, 6) < -0.7 THEN 'strong negative'
                ELSE 'weak' END AS band
    FROM daily
    """,
)
def corr_band_by_day(spark, sf_dir):
    daily = _buckets(spark, sf_dir).groupBy(F.to_date("hour_ts").alias("trading_date")).agg(
        r6(pearson(F.col("avg_close_usdt"), F.col("avg_base_fee_gwei"))).alias("r")
    )
    return daily.withColumn("band", corr_band(F.col("r")))


@query(
    "recompute_touched_buckets",
    f"""
    WITH {BLOCK}
    SELECT {b.BUCKET} AS hour_ts, round(avg(CAST(base_fee_per_gas AS DOUBLE)) / 1e9, 6) AS avg_base_fee_gwei
    FROM v_block GROUP BY 1
    """,
)
def recompute_touched_buckets(spark, sf_dir):
    """Every ninth block arrives late; the refreshed table must equal a full recomputation."""
    blocks = b.blocks(spark, sf_dir)
    is_late = F.col("block_number") % 9 == 0
    before = an.fee_by(blocks.where(~is_late), minute_bucket(F.col("ts"), 10), "hour_ts")
    after = an.recompute_touched_buckets(before, blocks, blocks.where(is_late), 10)
    return rounded(after, "avg_base_fee_gwei")
