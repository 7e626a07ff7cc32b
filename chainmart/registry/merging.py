"""Merge family and de-duplication on ``lineitem``, whose key repeats by nature."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import at
from ..operators import (
    candle_cursors,
    dedupe,
    high_water_mark,
    incremental_scan,
    insert_if_absent,
    known_keys,
    merge_documents,
    merge_upsert,
    missing_minutes,
    missing_numbers,
    to_fetch,
    scalar_key,
)
from ..plans.keyed import KeyedTable
from ..session import shared_dir
from . import base as b
from .base import BLOCK, CANDLE, END, SNAPSHOT, START, query

KEYS = ["l_orderkey", "l_linenumber"]
REST = [
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
]
ORDER = ["l_shipdate", *REST]
CUT = "1998-07-01 00:00:00"
MARK = "1999-01-01 00:00:00"
COLS = ", ".join([*KEYS, "l_shipdate", *REST])
KEY_SQL = ", ".join(KEYS)
LAST = ", ".join(f"{c} DESC NULLS LAST" for c in ORDER)
FIRST = ", ".join(f"{c} ASC NULLS FIRST" for c in ORDER)
# target: one row per key out of the early rows; updates: all later rows
SPLIT = f"""
    early AS (
      SELECT {COLS}, 0 AS batch FROM lineitem WHERE l_shipdate < TIMESTAMP '{CUT}'
      QUALIFY row_number() OVER (PARTITION BY {KEY_SQL} ORDER BY {LAST}) = 1),
    late AS (SELECT {COLS}, 1 AS batch FROM lineitem WHERE l_shipdate >= TIMESTAMP '{CUT}'),
    stacked AS (SELECT * FROM early UNION ALL SELECT * FROM late)"""


def _split(spark, sf_dir):
    lines = b.table(spark, sf_dir, "lineitem")
    early = lines.where(F.col("l_shipdate") < at(CUT))
    return dedupe(early, KEYS, ORDER), lines.where(F.col("l_shipdate") >= at(CUT))


def _with_order(updates):
    """Order columns under names of their own, so that they may also be merged."""
    return updates.withColumns({f"_by_{c}": F.col(c) for c in ORDER}), [f"_by_{c}" for c in ORDER]


@query(
    "dedupe_last_wins",
    f"SELECT {COLS} FROM lineitem QUALIFY row_number() OVER (PARTITION BY {KEY_SQL} ORDER BY {LAST}) = 1",
)
def dedupe_last_wins(spark, sf_dir):
    return dedupe(b.table(spark, sf_dir, "lineitem"), KEYS, ORDER, keep="last")


@query(
    "dedupe_first_wins",
    f"SELECT {COLS} FROM lineitem QUALIFY row_number() OVER (PARTITION BY {KEY_SQL} ORDER BY {FIRST}) = 1",
)
def dedupe_first_wins(spark, sf_dir):
    return dedupe(b.table(spark, sf_dir, "lineitem"), KEYS, ORDER, keep="first")


@query(
    "upsert_replace",
    f"""
    WITH {SPLIT} SELECT {COLS} FROM stacked
    QUALIFY row_number() OVER (PARTITION BY {KEY_SQL} ORDER BY batch DESC, {LAST}) = 1
    """,
)
def upsert_replace(spark, sf_dir):
    target, updates = _split(spark, sf_dir)
    updates, order = _with_order(updates)
    return merge_upsert(target, updates, KEYS, order)


@query(
    "upsert_coalesce",
    f"""
    WITH {SPLIT},
    flagged AS (
      SELECT *, CASE WHEN batch = 0 THEN l_returnflag ELSE nullif(l_returnflag, 'N') END AS flag FROM stacked),
    last AS (
      SELECT {KEY_SQL}, l_extendedprice FROM flagged
      QUALIFY row_number() OVER (PARTITION BY {KEY_SQL} ORDER BY batch DESC, {LAST}) = 1),
    known AS (
      SELECT {KEY_SQL}, flag FROM flagged WHERE flag IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY {KEY_SQL} ORDER BY batch DESC, {LAST}) = 1)
    SELECT {KEY_SQL}, l_extendedprice, flag FROM last LEFT JOIN known USING ({KEY_SQL})
    """,
)
def upsert_coalesce(spark, sf_dir):
    target, updates = _split(spark, sf_dir)
    updates, order = _with_order(updates)
    updates = updates.withColumn("flag", F.nullif("l_returnflag", F.lit("N")))
    target = target.select(*KEYS, "l_extendedprice", F.col("l_returnflag").alias("flag"))
    return merge_upsert(target, updates, KEYS, order, {"flag": "keep_if_null"})


@query(
    "upsert_keyed_table",
    f"""
    WITH {SPLIT},
    flagged AS (
      SELECT *, CASE WHEN batch = 0 THEN l_returnflag ELSE nullif(l_returnflag, 'N') END AS flag FROM stacked),
    last AS (
      SELECT * FROM flagged
      QUALIFY row_number() OVER (PARTITION BY {KEY_SQL} ORDER BY batch DESC, {LAST}) = 1),
    known AS (
      SELECT {KEY_SQL}, flag FROM flagged WHERE flag IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY {KEY_SQL} ORDER BY batch DESC, {LAST}) = 1),
    first AS (
      SELECT {KEY_SQL}, l_shipdate AS born FROM flagged
      QUALIFY row_number() OVER (PARTITION BY {KEY_SQL} ORDER BY batch, {FIRST}) = 1)
    SELECT {KEY_SQL}, last.l_extendedprice, last.l_quantity, known.flag, born
    FROM last JOIN first USING ({KEY_SQL}) LEFT JOIN known USING ({KEY_SQL})
    """,
)
def upsert_keyed_table(spark, sf_dir):
    """Three batches into a table cut by key, the last of them twice: only updates are shuffled."""
    target, updates = _split(spark, sf_dir)
    table = KeyedTable(spark, shared_dir(spark, "keyed"), KEYS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    columns = [*KEYS, "l_extendedprice", "l_quantity", "flag", "born", *[f"_by_{c}" for c in ORDER]]
    policies = {"flag": "keep_if_null", "born": "set_on_insert"}
    middle = F.col("l_shipdate") < at(MARK)
    flag = F.col("l_returnflag")
    parts = [(target, flag)] + [(updates.where(w), F.nullif(flag, F.lit("N"))) for w in (middle, ~middle, ~middle)]
    for rows, known in parts:
        ordered, order = _with_order(rows.withColumns({"flag": known, "born": F.col("l_shipdate")}))
        table.merge(ordered.select(columns), order, policies)
    return table.read()


@query(
    "insert_if_absent",
    f"""
    WITH {SPLIT},
    fresh AS (
      SELECT {COLS} FROM late
      WHERE ({KEY_SQL}) NOT IN (SELECT ({KEY_SQL}) FROM early)
      QUALIFY row_number() OVER (PARTITION BY {KEY_SQL} ORDER BY {FIRST}) = 1)
    SELECT {COLS} FROM early UNION ALL SELECT {COLS} FROM fresh
    """.replace(f"WHERE ({KEY_SQL}) NOT IN (SELECT ({KEY_SQL}) FROM early)",
                "WHERE NOT EXISTS (SELECT 1 FROM early e WHERE e.l_orderkey = late.l_orderkey "
                "AND e.l_linenumber = late.l_linenumber)"),
)
def insert_absent(spark, sf_dir):
    target, updates = _split(spark, sf_dir)
    return insert_if_absent(target, updates, KEYS, ORDER)


@query(
    "upsert_set_on_insert",
    f"""
    WITH {SPLIT},
    carried AS (
      SELECT *, batch = 0 OR l_returnflag <> 'A' AS has_tax,
             CASE WHEN l_returnflag = 'R' AND batch = 1 THEN NULL ELSE l_tax END AS tax FROM stacked),
    last AS (
      SELECT {KEY_SQL}, l_extendedprice FROM carried
      QUALIFY row_number() OVER (PARTITION BY {KEY_SQL} ORDER BY batch DESC, {LAST}) = 1),
    taxed AS (
      SELECT {KEY_SQL}, tax FROM carried WHERE has_tax
      QUALIFY row_number() OVER (PARTITION BY {KEY_SQL} ORDER BY batch DESC, {LAST}) = 1),
    first AS (
      SELECT {KEY_SQL}, l_shipdate AS ingested_at FROM carried
      QUALIFY row_number() OVER (PARTITION BY {KEY_SQL} ORDER BY batch, {FIRST}) = 1)
    SELECT {KEY_SQL}, l_extendedprice, tax, ingested_at
    FROM last JOIN first USING ({KEY_SQL}) LEFT JOIN taxed USING ({KEY_SQL})
    """,
)
def upsert_set_on_insert(spark, sf_dir):
    """Documents flagged A do not carry a tax (the old one stays), R carry an explicit null."""
    target, updates = _split(spark, sf_dir)
    updates, order = _with_order(updates)
    both = F.array(F.lit("l_extendedprice"), F.lit("tax"))
    target = target.select(
        *KEYS,
        "l_extendedprice",
        F.col("l_tax").alias("tax"),
        F.col("l_shipdate").alias("ingested_at"),
        both.alias("fields_present"),
    )
    flag = F.col("l_returnflag")
    updates = updates.withColumns(
        {
            "tax": F.when(flag != "R", F.col("l_tax")),
            "ingested_at": F.col("l_shipdate"),
            "fields_present": F.when(flag == "A", F.array(F.lit("l_extendedprice"))).otherwise(both),
        }
    )
    merged = merge_documents(target, updates, KEYS, order, ["l_extendedprice", "tax"], ["ingested_at"])
    return merged.drop("fields_present")


@query("incremental_scan_by_mark", f"SELECT {COLS} FROM lineitem WHERE l_shipdate > TIMESTAMP '{MARK}'")
def incremental_scan_by_mark(spark, sf_dir):
    return incremental_scan(b.table(spark, sf_dir, "lineitem"), {"l_shipdate": at(MARK)})


@query(
    "incremental_scan_two_marks",
    f"""
    SELECT l_orderkey, l_linenumber, l_shipdate AS updated_at, o_orderdate AS ingested_at
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey
    WHERE l_shipdate > TIMESTAMP '{MARK}' OR o_orderdate > TIMESTAMP '{MARK}'
    """,
)
def incremental_scan_two_marks(spark, sf_dir):
    lines = b.table(spark, sf_dir, "lineitem").select(*KEYS, F.col("l_shipdate").alias("updated_at"))
    orders = b.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderdate").alias("ingested_at")
    )
    docs = lines.join(orders, "l_orderkey")
    return incremental_scan(docs, {"updated_at": at(MARK), "ingested_at": at(MARK)}, any_of=True)


@query(
    "high_water_marks",
    f"""
    SELECT 'staging' AS source, max(l_shipdate) FILTER (l_returnflag <> 'N') AS mark,
           count(*) FILTER (l_returnflag <> 'N') AS n_rows FROM lineitem
    UNION ALL SELECT 'warehouse', max(l_shipdate), count(*) FROM lineitem
    UNION ALL SELECT 'idle', TIMESTAMP '{MARK}', 0
    """,
)
def high_water_marks(spark, sf_dir):
    """Advance on valid rows only, on all rows, and not at all when nothing is new."""
    lines = b.table(spark, sf_dir, "lineitem")
    valid = F.col("l_returnflag") != "N"
    parts = {
        "staging": high_water_mark(lines, "l_shipdate", valid, previous=at(MARK)),
        "warehouse": high_water_mark(lines, "l_shipdate"),
        "idle": high_water_mark(
            incremental_scan(lines, {"l_shipdate": at("2100-01-01 00:00:00")}), "l_shipdate", previous=at(MARK)
        ),
    }
    named = [df.select(F.lit(n).alias("source"), "mark", "n_rows") for n, df in parts.items()]
    return named[0].unionByName(named[1]).unionByName(named[2])


@query(
    "candle_cursors",
    f"""
    WITH {CANDLE}
    SELECT regexp_replace(symbol || '/x', '[^A-Za-z0-9]+', '_', 'g') || '__' || interval AS cursor,
           symbol || '/x' AS symbol, interval, max(close_time_ms) AS last_close_ms,
           max(close_time_ms) + 1 AS next_start_ms
    FROM v_candle WHERE close_time_ms <= epoch_ms(TIMESTAMP '{END}') GROUP BY symbol, interval
    """,
)
def cursors(spark, sf_dir):
    candles = b.candles(spark, sf_dir).withColumn("symbol", F.concat("symbol", F.lit("/x")))
    return candle_cursors(candles, F.unix_millis(b.utc(at(END))))


@query(
    "semi_known_keys",
    """
    SELECT event_id, user_id, event_type FROM events
    WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'FURNITURE')
    """,
)
def semi_known_keys(spark, sf_dir):
    users = b.table(spark, sf_dir, "customer").where("c_mktsegment = 'FURNITURE'").select(
        F.col("c_custkey").alias("user_id")
    )
    events = b.table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    return known_keys(events, users, "user_id")


@query(
    "scalar_key_lookup",
    f"""
    WITH {SNAPSHOT}
    SELECT metric_id, crypto_id, price_usd FROM v_snapshot
    WHERE crypto_id = (SELECT min(c_custkey + 1) FROM customer WHERE c_mktsegment = 'FURNITURE')
    """,
)
def scalar_key_lookup(spark, sf_dir):
    crypto = scalar_key(b.cryptos(spark, sf_dir), F.col("symbol") == "FURNITURE", "crypto_id")
    return b.snapshots(spark, sf_dir).where(F.col("crypto_id") == crypto).select(
        "metric_id", "crypto_id", "price_usd"
    )


@query(
    "missing_minutes",
    f"""
    WITH {SNAPSHOT},
    bounds AS (
      SELECT date_trunc('minute', max(recorded_at)) + INTERVAL 1 MINUTE AS lo FROM v_snapshot
      WHERE recorded_at < TIMESTAMP '{START}'),
    spine AS (
      SELECT unnest(generate_series(lo, least(TIMESTAMP '{END}', lo + INTERVAL 119 MINUTE), INTERVAL 1 MINUTE)) AS minute_ts
      FROM bounds)
    SELECT minute_ts FROM spine
    WHERE minute_ts NOT IN (SELECT date_trunc('minute', recorded_at) FROM v_snapshot)
    """,
)
def missing_minutes_query(spark, sf_dir):
    """From one past the checkpoint (the last snapshot before the window), 120 minutes per run."""
    snaps = b.snapshots(spark, sf_dir)
    checkpoint = snaps.where(F.col("recorded_at") < at(START)).agg(
        F.date_trunc("minute", F.max("recorded_at")).cast("timestamp_ntz") + F.expr("interval 1 minute")
    )
    return missing_minutes(snaps, "recorded_at", checkpoint.scalar(), END, max_minutes=120)


@query(
    "missing_minutes_all",
    f"""
    WITH {SNAPSHOT}
    SELECT m AS minute_ts
    FROM (SELECT unnest(generate_series(TIMESTAMP '{START}', TIMESTAMP '{END}', INTERVAL 1 MINUTE)) AS m)
    WHERE m NOT IN (SELECT date_trunc('minute', recorded_at) FROM v_snapshot)
    """,
)
def missing_minutes_all(spark, sf_dir):
    """A backfill without the catch-up limit."""
    return missing_minutes(b.snapshots(spark, sf_dir), "recorded_at", START, END)


@query(
    "missing_block_numbers",
    f"""
    WITH {BLOCK}
    SELECT n AS block_number
    FROM (SELECT unnest(generate_series(min(block_number), max(block_number))) AS n FROM v_block)
    WHERE n NOT IN (SELECT block_number FROM v_block)
    """,
)
def missing_block_numbers(spark, sf_dir):
    return missing_numbers(b.blocks(spark, sf_dir), "block_number")


@query(
    "missing_blocks_to_head",
    f"""
    WITH {BLOCK},
    head AS (SELECT max(block_number) + 25 AS h FROM v_block),
    runs AS (
      SELECT 'next' AS run, (SELECT max(block_number) FROM v_block WHERE ts < TIMESTAMP '{START}') + 1 AS lo, h FROM head
      UNION ALL SELECT 'first', greatest(0, h - 999), h FROM head)
    SELECT run, n AS block_number FROM (SELECT run, unnest(generate_series(lo, h)) AS n FROM runs)
    WHERE n NOT IN (SELECT block_number FROM v_block)
    """,
)
def missing_blocks_to_head(spark, sf_dir):
    """What is to be fetched up to a head that is ahead of all blocks: after a cursor, and in a first run without one."""
    k = b.blocks(spark, sf_dir)
    head = k.agg(F.max("block_number") + 25).scalar()
    cursor = k.where(F.col("ts") < F.lit(START).cast("timestamp_ntz")).agg(F.max("block_number")).scalar()
    runs = (("next", cursor), ("first", F.lit(None).cast("bigint")))
    parts = []
    for name, done in runs:
        first, last = to_fetch(done, head, 1000)
        found = missing_numbers(k, "block_number", first=first, last=last)
        parts.append(found.select(F.lit(name).alias("run"), "block_number"))
    return parts[0].unionByName(parts[1])
