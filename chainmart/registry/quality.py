"""Validation with counted rejects, and constraint reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import clean_symbol
from ..operators import Rule, constraint_violations, quality_counters, split_valid
from ..plans.staging import candle_rules, listing_price_rule, price_rule
from . import base as b
from .base import CANDLE, query


def _spoiled(spark, sf_dir):
    """Candles as landed text, with values blanked, negated or garbled by event id."""
    c, i = b.candles(spark, sf_dir), F.col("event_id")
    return c.select(
        "event_id",
        F.when(i % 11 == 1, "  ").when(i % 11 == 2, F.lit(None)).otherwise(
            F.concat(F.lit(" "), F.lower("symbol"), F.lit(" "))
        ).alias("symbol"),
        F.when(i % 11 == 3, "").otherwise(F.col("interval")).alias("interval"),
        F.when(i % 11 != 4, F.col("open_time_ms")).alias("open_time_ms"),
        F.when(i % 11 != 5, F.col("close_time_ms")).alias("close_time_ms"),
        F.when(i % 11 == 6, (-F.col("close")).cast("string"))
        .when(i % 11 == 7, "abc")
        .when(i % 11 == 8, F.lit(None))
        .when(i % 11 == 9, "0")
        .otherwise(F.col("close").cast("string"))
        .alias("close"),
        F.when(i % 11 == 10, "1e30").otherwise(F.col("volume").cast("string")).alias("volume"),
        *[
            F.lit(None).cast("string").alias(x)
            for x in ("open", "high", "low", "quote_asset_volume", "taker_buy_base_volume", "taker_buy_quote_volume")
        ],
    )


REASON = """CASE WHEN event_id % 11 IN (1, 2) THEN 'blank_symbol' WHEN event_id % 11 = 3 THEN 'blank_interval'
            WHEN event_id % 11 = 4 THEN 'no_open_time' WHEN event_id % 11 = 5 THEN 'no_close_time'
            WHEN event_id % 11 IN (7, 9) OR (event_id % 11 = 6 AND -close <= 0)
                 OR (event_id % 11 NOT IN (6, 8) AND close <= 0) THEN 'bad_close'
            WHEN event_id % 11 = 10 THEN 'out_of_range_volume' ELSE 'valid' END"""


@query("quality_counters", f"WITH {CANDLE} SELECT {REASON} AS outcome, count(*) AS n_rows FROM v_candle GROUP BY 1")
def counters(spark, sf_dir):
    return quality_counters(_spoiled(spark, sf_dir), candle_rules())


@query(
    "validate_candles",
    f"""
    WITH {CANDLE}
    SELECT event_id, symbol, interval FROM v_candle WHERE {REASON} = 'valid'
    """,
)
def validate_candles(spark, sf_dir):
    valid, _ = split_valid(_spoiled(spark, sf_dir), candle_rules())
    return valid.select("event_id", clean_symbol(F.col("symbol")).alias("symbol"), "interval")


@query("validate_rejects", f"WITH {CANDLE} SELECT event_id, {REASON} AS reject_reason FROM v_candle WHERE {REASON} <> 'valid'")
def validate_rejects(spark, sf_dir):
    _, rejects = split_valid(_spoiled(spark, sf_dir), candle_rules())
    return rejects.select("event_id", "reject_reason")


@query(
    "validate_prices",
    f"""
    WITH {CANDLE}, p AS (
      SELECT event_id, CASE WHEN event_id % 11 IN (7, 8) THEN NULL WHEN event_id % 11 = 6 THEN -close
                            WHEN event_id % 11 = 9 THEN 0 ELSE close END AS price,
             event_id % 11 = 8 AS absent FROM v_candle)
    SELECT event_id, absent OR coalesce(price > 0, false) AS candle_ok, coalesce(price > 0, false) AS listing_ok FROM p
    """,
)
def validate_prices(spark, sf_dir):
    """A missing price passes for a candle and fails for a listed asset."""
    close = F.col("close")
    return _spoiled(spark, sf_dir).select(
        "event_id",
        price_rule(close).ok.alias("candle_ok"),
        F.coalesce(listing_price_rule(close).ok, F.lit(False)).alias("listing_ok"),
    )


@query(
    "constraint_violations",
    """
    SELECT 'unique' AS rule, 'lineitem' AS table_name, l_orderkey || '|' || l_linenumber AS key, count(*) AS n_rows
    FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
    UNION ALL
    SELECT 'foreign_key', 'lineitem', CAST(l_orderkey AS VARCHAR), count(*) FROM lineitem
    WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders) GROUP BY l_orderkey
    UNION ALL
    SELECT 'foreign_key', 'events', CAST(user_id AS VARCHAR), count(*) FROM events
    WHERE user_id NOT IN (SELECT c_custkey FROM customer) GROUP BY user_id
    UNION ALL
    SELECT 'foreign_key', 'purchases', CAST(user_id + 1 AS VARCHAR), count(*) FROM events
    WHERE event_type = 'purchase'
      AND user_id + 1 NOT IN (SELECT c_custkey + 1 FROM customer WHERE c_mktsegment = 'FURNITURE') GROUP BY user_id
    UNION ALL
    SELECT 'not_null', 'snapshots', 'market_cap', count(*) FROM events
    WHERE event_type = 'purchase' AND event_id % 7 = 0 HAVING count(*) > 0
    """,
)
def violations(spark, sf_dir):
    lines, events = b.table(spark, sf_dir, "lineitem"), b.table(spark, sf_dir, "events")
    customer = b.table(spark, sf_dir, "customer")
    snaps, assets = b.snapshots(spark, sf_dir), b.cryptos(spark, sf_dir)
    return constraint_violations(
        unique=[("lineitem", lines, ["l_orderkey", "l_linenumber"])],
        not_null=[("snapshots", snaps, ["crypto_id", "price_usd", "market_cap"])],
        foreign=[
            ("lineitem", lines, "l_orderkey", b.table(spark, sf_dir, "orders"), "o_orderkey"),
            ("events", events, "user_id", customer, "c_custkey"),
            ("purchases", snaps, "crypto_id", assets.where("symbol = 'FURNITURE'"), "crypto_id"),
        ],
    )


@query(
    "filter_required_keys",
    f"""
    WITH {CANDLE}
    SELECT event_id, CASE event_id % 4 WHEN 1 THEN NULL ELSE symbol END AS symbol FROM v_candle WHERE event_id % 4 <> 0
    """,
)
def filter_required_keys(spark, sf_dir):
    """A null symbol is still a present key; a missing one is not."""
    from ..sources.parsers import field, has_field

    c, i = b.candles(spark, sf_dir), F.col("event_id")
    body = F.to_json(F.struct("event_id", "interval", "open_time_ms"))
    tail = F.regexp_replace(body, r"^\{", "")
    text = (
        F.when(i % 4 == 0, body)
        .when(i % 4 == 1, F.concat(F.lit('{"symbol":null,'), tail))
        .otherwise(F.concat(F.lit('{"symbol":"'), F.col("symbol"), F.lit('",'), tail))
    )
    docs = c.select(F.try_parse_json(text).alias("doc"))
    rules = [Rule(k, has_field("doc", k)) for k in ("symbol", "interval", "open_time_ms")]
    valid, _ = split_valid(docs, rules)
    return valid.select(field("doc", "event_id", "bigint").alias("event_id"), field("doc", "symbol").alias("symbol"))
