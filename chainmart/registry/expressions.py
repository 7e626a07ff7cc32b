"""Scalar expressions on text the tables are turned into, junk included."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import functions as fn
from ..operators import coerce_datetime_columns
from . import base as b
from .base import query


def _variant(key: str, *cases):
    """One of several spellings per row, chosen by the row's key."""
    return F.element_at(F.array(*cases), (F.col(key) % len(cases) + 1).cast("int"))


@query(
    "expr_hex_to_long",
    """
    SELECT o_orderkey,
           CASE o_orderkey % 8 WHEN 0 THEN o_orderkey * 7919 WHEN 1 THEN o_orderkey
                WHEN 2 THEN o_orderkey * 4294967296 WHEN 3 THEN -o_orderkey WHEN 4 THEN o_custkey END AS parsed,
           CASE o_orderkey % 8 WHEN 0 THEN o_orderkey * 7919 WHEN 2 THEN o_orderkey * 4294967296
                WHEN 4 THEN o_custkey END AS as_hex
    FROM orders
    """,
)
def expr_hex_to_long(spark, sf_dir):
    n, cust = F.col("o_orderkey"), F.col("o_custkey")
    text = _variant(
        "o_orderkey",
        F.concat(F.lit(" 0x"), F.lower(F.hex(n * 7919)), F.lit(" ")),
        F.concat(F.lit("+"), n.cast("string")),
        F.concat(F.lit("0X"), F.hex(n * F.lit(4294967296))),
        F.concat(F.lit("-"), n.cast("string")),
        F.concat(F.lit("0x"), F.lpad(F.hex(cust), 30, "0")),
        F.concat(F.lit("0xf"), F.lpad(F.hex(n), 16, "0")),
        F.lit("0x"),
        F.concat(n.cast("string"), F.lit("z")),
    )
    # a plain or signed decimal text is no base-16 case here
    as_hex = F.when(n % 8 != 1, fn.base16_to_long(text))
    return b.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        fn.hex_to_long(text).alias("parsed"),
        as_hex.alias("as_hex"),
    )


@query(
    "expr_symbol_split",
    """
    WITH s AS (
      SELECT c_custkey, substr(c_mktsegment, 1, 3) ||
             CASE c_custkey % 11 WHEN 0 THEN 'USDT' WHEN 1 THEN 'USDC' WHEN 2 THEN 'BUSD' WHEN 3 THEN 'USD'
               WHEN 4 THEN 'EUR' WHEN 5 THEN 'BTC' WHEN 6 THEN 'ETH' WHEN 7 THEN 'BNB' WHEN 8 THEN 'TRY'
               WHEN 9 THEN 'XYZ' ELSE '' END AS whole, c_custkey % 11 AS m,
             substr(c_mktsegment, 1, 3) AS head
      FROM customer)
    SELECT c_custkey, CASE WHEN m < 9 THEN head END AS base,
           CASE m WHEN 0 THEN 'USDT' WHEN 1 THEN 'USDC' WHEN 2 THEN 'BUSD' WHEN 3 THEN 'USD'
                  WHEN 4 THEN 'EUR' WHEN 5 THEN 'BTC' WHEN 6 THEN 'ETH' WHEN 7 THEN 'BNB' WHEN 8 THEN 'TRY' END AS quote
    FROM s
    """,
)
def expr_symbol_split(spark, sf_dir):
    tails = [F.lit(q) for q in ("USDT", "USDC", "BUSD", "USD", "EUR", "BTC", "ETH", "BNB", "TRY", "XYZ", "")]
    symbol = F.concat(
        F.lit(" "), F.lower(F.substring("c_mktsegment", 1, 3)), _variant("c_custkey", *tails), F.lit(" ")
    )
    parts = fn.split_symbol(symbol)
    return b.table(spark, sf_dir, "customer").select(
        "c_custkey", parts["base"].alias("base"), parts["quote"].alias("quote")
    )


@query(
    "expr_interval_seconds",
    """
    SELECT p_partkey,
           CAST(CASE p_partkey % 8 WHEN 0 THEN p_size WHEN 1 THEN p_size * 60 WHEN 2 THEN p_size * 3600
                WHEN 3 THEN p_size * 86400 WHEN 4 THEN p_size * 604800 WHEN 5 THEN p_size * 60 END AS INTEGER) AS seconds
    FROM part
    """,
)
def expr_interval_seconds(spark, sf_dir):
    units = [F.lit(u) for u in ("s", "m", "H", "d", "w ", "M", "y", "")]
    text = F.concat(F.col("p_size").cast("string"), _variant("p_partkey", *units))
    return b.table(spark, sf_dir, "part").select("p_partkey", fn.interval_seconds(text).alias("seconds"))


@query(
    "expr_iso_date",
    """
    SELECT o_orderkey,
           CASE WHEN o_orderkey % 6 IN (0, 1, 4, 5) THEN CAST(o_orderdate AS DATE) END AS parsed
    FROM orders
    """,
)
def expr_iso_date(spark, sf_dir):
    d = F.col("o_orderdate")
    # ISO year of a date: the year of the Thursday of its week
    thursday = F.date_add(F.date_sub(F.to_date(d), F.weekday(d)), 3)
    week = lambda sep: F.concat(
        F.date_format(thursday, "yyyy"), F.lit(sep + "W"), F.lpad(F.weekofyear(d).cast("string"), 2, "0"),
        F.lit(sep), (F.weekday(d) + 1).cast("string"),
    )
    text = _variant(
        "o_orderkey",
        F.date_format(d, "yyyy-MM-dd"),
        F.date_format(d, "yyyyMMdd"),
        F.concat(F.date_format(d, "yyyy-MM"), F.lit("-99")),
        F.date_format(d, "yyyy/MM/dd"),
        week("-"),
        week(""),
    )
    return b.table(spark, sf_dir, "orders").select("o_orderkey", fn.iso_date(text).alias("parsed"))


@query(
    "expr_iso_timestamp",
    """
    SELECT event_id, CASE WHEN event_id % 4 <> 3 THEN ts END AS parsed FROM events
    """,
)
def expr_iso_timestamp(spark, sf_dir):
    utc = b.utc("ts")
    shape = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    text = _variant(
        "event_id",
        F.concat(F.date_format(utc, shape), F.lit("Z")),
        F.concat(F.date_format(utc + F.expr("interval 2 hours"), shape), F.lit("+02:00")),
        F.date_format(utc, "yyyy-MM-dd HH:mm:ss.SSSSSS"),
        F.concat(F.lit("at "), F.date_format(utc, shape)),
    )
    return b.table(spark, sf_dir, "events").select(
        "event_id", fn.iso_timestamp(text).cast("timestamp_ntz").alias("parsed")
    )


@query(
    "expr_minute_bucket",
    """
    SELECT event_id,
           date_trunc('minute', ts) - to_minutes(CAST(extract(minute FROM ts) % 10 AS BIGINT)) AS b10,
           date_trunc('minute', ts) - to_minutes(CAST(extract(minute FROM ts) % 7 AS BIGINT)) AS b7,
           date_trunc('hour', ts) AS b90
    FROM events
    """,
)
def expr_minute_bucket(spark, sf_dir):
    ts = F.col("ts")
    return b.table(spark, sf_dir, "events").select(
        "event_id", *[fn.minute_bucket(ts, n).alias(f"b{n}") for n in (10, 7, 90)]
    )


@query(
    "expr_corr_band",
    """
    WITH c AS (
      SELECT event_id, CASE WHEN event_type = 'error' THEN NULL
                            ELSE round((CAST(json_extract(props, '$.k') AS BIGINT) % 21 - 10) / 10.0, 1) END AS r
      FROM events)
    SELECT event_id, CASE WHEN r IS NULL THEN 'N/A' WHEN r = 1 THEN 'weak' WHEN r >= 0.7 THEN 'strong positive'
                WHEN r >= 0.3 THEN 'moderate positive' WHEN r >= -0.3 THEN 'weak'
                WHEN r >= -0.7 THEN 'moderate negative' ELSE 'strong negative' END AS band
    FROM c
    """,
)
def expr_corr_band(spark, sf_dir):
    k = F.get_json_object("props", "$.k").cast("bigint")
    r = F.when(F.col("event_type") != "error", F.round((k % 21 - 10) / 10.0, 1))
    return b.table(spark, sf_dir, "events").select("event_id", fn.corr_band(r).alias("band"))


@query(
    "expr_calendar",
    """
    SELECT DISTINCT o_orderdate AS ts, CAST(o_orderdate AS DATE) AS date, year(o_orderdate) AS year,
           quarter(o_orderdate) AS quarter, month(o_orderdate) AS month, day(o_orderdate) AS day,
           hour(o_orderdate) AS hour, minute(o_orderdate) AS minute, dayofweek(o_orderdate) AS day_of_week,
           weekofyear(o_orderdate) AS week_of_year, dayofweek(o_orderdate) IN (0, 6) AS is_weekend
    FROM orders
    """,
)
def expr_calendar(spark, sf_dir):
    ts = F.col("o_orderdate")
    return b.table(spark, sf_dir, "orders").select(ts).distinct().select(ts.alias("ts"), *fn.calendar_fields(ts))


@query(
    "coerce_datetime_columns",
    "SELECT event_id, ts AS run_ts, event_type AS note_at, value FROM events",
)
def coerce_columns(spark, sf_dir):
    text = b.table(spark, sf_dir, "events").select(
        "event_id",
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("run_ts"),
        F.col("event_type").alias("note_at"),
        "value",
    )
    return coerce_datetime_columns(text)
