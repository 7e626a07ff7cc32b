"""Streaming jobs over the tables; each leaves a table that is read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import at
from ..operators import dedupe
from ..session import shared_dir
from ..sources import parse_candles, scan_jsonl
from ..streaming import dedupe_into, dedupe_stream, land_stream, run_once, tumbling_averages, upsert_into
from . import base as b
from .base import BLOCK, NOW, query, r6
from .landing import DS, LINES, SCANNED, candle_lines, written
from .merging import COLS, CUT, KEYS, KEY_SQL, LAST, ORDER, SPLIT

MONTH = "ship_month"
#: rows that arrive for a part of the merged table, some 50 MB, and the least number of parts
PART_ROWS, LEAST_PARTS = 2_000_000, 8
#: bytes of a row group in the files that a stream reads: a file is a batch, and its row groups are read side by side
GROUP_BYTES = 4 << 20


def _batches(spark, rows, times=1):
    """A stream of ``rows``, delivered ``times`` over: a part with even weeks and one with odd weeks, each of many
    days, so most rows of a later batch are days older than the newest row before them."""
    source = shared_dir(spark, "batches")
    odd = F.pmod(F.weekofyear("ts"), F.lit(2)) == 1
    for _ in range(times):
        for part in (rows.where(~odd), rows.where(odd)):
            part.coalesce(2).write.mode("append").parquet(source)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", "2").parquet(source)


@query("stream_land_files", SCANNED)
def stream_land_files(spark, sf_dir):
    """Two runs over the same files: the second finds nothing new."""
    source = written(spark, candle_lines(spark, sf_dir), "stream-candles")
    out, checkpoint = shared_dir(spark, "landed"), shared_dir(spark, "landed-checkpoint")
    for _ in range(2):
        lines = scan_jsonl(spark, source, LINES, stream=True)
        land_stream(parse_candles(lines, DS, at(NOW)), out, checkpoint)
    return spark.read.parquet(out).select(
        "symbol",
        "interval",
        "open_time_ms",
        "trading_day",
        F.col("close").cast("double").alias("close"),
        "reject_reason",
    )


@query(
    "stream_upsert",
    f"""
    WITH {SPLIT} SELECT {COLS} FROM stacked
    QUALIFY row_number() OVER (PARTITION BY {KEY_SQL} ORDER BY batch DESC, {LAST}) = 1
    """,
)
def stream_upsert(spark, sf_dir):
    """Early rows arrive first, later ones then replace them key by key, a batch per file.

    The table's parts follow the rows, and a file has the keys of a part: a batch rewrites that part and no other, so
    what is written grows with the rows and not with the batches times the table.
    """
    lines = b.table(spark, sf_dir, "lineitem")
    parts = max(LEAST_PARTS, -(-lines.count() // PART_ROWS))
    # all versions of a key in one file, so the order within a batch decides
    part = F.pmod(F.xxhash64(*KEYS), F.lit(parts)).cast("int")
    keyed = lines.withColumn("key_part", part)
    early, late = keyed.where(F.col("l_shipdate") < at(CUT)), keyed.where(F.col("l_shipdate") >= at(CUT))
    source = shared_dir(spark, "stream-lines")
    by_part = lambda rows: rows.repartitionById(parts, "key_part")
    # the keys before their part, which is the same for all rows of a task: it would tell the sort nothing
    for rows in (dedupe(by_part(early), [*KEYS, "key_part"], ORDER), by_part(late)):
        rows.write.mode("append").option("parquet.block.size", str(GROUP_BYTES)).parquet(source)
    schema = spark.read.parquet(source).schema
    batches = spark.readStream.schema(schema).option("maxFilesPerTrigger", "1").parquet(source)
    out = shared_dir(spark, "merged")
    merge = upsert_into(out, KEYS, ORDER, "key_part")
    run_once(batches.writeStream.foreachBatch(merge), shared_dir(spark, "merged-checkpoint"))
    return spark.read.parquet(out).drop("key_part")


@query(
    "stream_tumbling_avg",
    f"""
    WITH {BLOCK}
    SELECT {b.BUCKET} AS hour_ts, round(avg(CAST(base_fee_per_gas AS DOUBLE)) / 1e9, 6) AS avg_base_fee_gwei
    FROM v_block GROUP BY 1
    """,
)
def stream_tumbling_avg(spark, sf_dir):
    """Ten-minute fee averages, updated windows merged into their table, late rows included."""
    clicks = _batches(spark, b.table(spark, sf_dir, "events").where("event_type = 'click'"))
    wei = F.round(F.col("value") * 1e9).cast("bigint").cast("double")
    averages = tumbling_averages(clicks, "ts", wei / F.lit(1e9), 10, "avg_base_fee_gwei")
    out = shared_dir(spark, "tumbling")
    daily = averages.withColumn("day", F.to_date("hour_ts"))
    merge = upsert_into(out, ["hour_ts"], ["avg_base_fee_gwei"], "day")
    run_once(daily.writeStream.outputMode("update").foreachBatch(merge), shared_dir(spark, "tumbling-checkpoint"))
    return spark.read.parquet(out).select("hour_ts", r6("avg_base_fee_gwei").alias("avg_base_fee_gwei"))


@query("stream_dedupe", "SELECT event_id, ts, user_id, event_type, value FROM events")
def stream_dedupe(spark, sf_dir):
    """Every event delivered twice, in batches with late rows; one copy comes out."""
    events = b.table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    stream = _batches(spark, events, times=2)
    out = shared_dir(spark, "distinct")
    land_stream(dedupe_stream(stream, ["event_id"]), out, shared_dir(spark, "distinct-checkpoint"))
    return spark.read.parquet(out)


@query("stream_dedupe_stored", "SELECT event_id, ts, user_id, event_type, value FROM events")
def stream_dedupe_stored(spark, sf_dir):
    """Every event delivered twice, in batches with late rows, told apart by the table that is written: no state."""
    events = b.table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    stream = _batches(spark, events, times=2)
    out = shared_dir(spark, "distinct")
    append = dedupe_into(out, ["event_id"], ["ts", "user_id", "event_type", "value"], "events")
    run_once(stream.writeStream.foreachBatch(append), shared_dir(spark, "distinct-checkpoint"))
    return spark.read.parquet(out).drop("source", "batch")
