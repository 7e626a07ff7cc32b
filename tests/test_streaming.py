import datetime as dt
import os
import random
import shutil

from pyspark.sql import functions as F

from chainmart.functions import at
from chainmart.operators import merge_upsert
from chainmart.sources import CANDLE_FIELDS, parse_candles, scan_jsonl
from chainmart.sources.scans import FILE_ORDER
from chainmart.streaming import dedupe_stream, land_stream, run_once, tumbling_averages, upsert_into


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def candle(key, close):
    return f'{{"symbol":"S{key}","interval":"1m","open_time_ms":{key},"close":{close}}}'


def test_files_land_once_and_new_files_are_picked_up(spark, tmp_path, write_lines):
    write_lines("in/a.jsonl", candle(1, 1), "junk")
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    stream = lambda: parse_candles(scan_jsonl(spark, str(tmp_path / "in"), stream=True), "2026-01-01", at("2026-01-01"))
    land_stream(stream(), out, ck)
    land_stream(stream(), out, ck)
    assert spark.read.parquet(out).count() == 2
    write_lines("in/later/b.jsonl", candle(2, 2))
    land_stream(stream(), out, ck)
    landed = spark.read.parquet(out)
    assert rows(landed.select("symbol", "reject_reason")) == [("S1", None), ("S2", None), (None, "not_an_object")]


def test_consumed_files_can_be_removed(spark, tmp_path, write_lines):
    first = write_lines("in/a.jsonl", candle(1, 1))
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    for name in ("b", "c"):
        lines = scan_jsonl(spark, str(tmp_path / "in"), stream=True, cleanSource="delete")
        land_stream(lines.drop("doc"), out, ck)
        write_lines(f"in/{name}.jsonl", candle(2, 2))
    lines = scan_jsonl(spark, str(tmp_path / "in"), stream=True, cleanSource="delete")
    land_stream(lines.drop("doc"), out, ck)
    assert not os.path.exists(first)
    assert spark.read.parquet(out).count() == 3


def test_stream_upsert_equals_batch_and_survives_replay(spark, tmp_path):
    rnd = random.Random(3)
    data = [(rnd.randint(0, 20), i, rnd.choice([None, i])) for i in range(200)]
    schema = "k int, ord int, v int"
    source = str(tmp_path / "src")
    for chunk in (data[:100], data[100:150], data[150:]):
        part = spark.createDataFrame(chunk, schema).withColumn("part", F.col("k") % 3)
        part.coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(schema + ", part int").option("maxFilesPerTrigger", "1").parquet(source)
    out = str(tmp_path / "table")
    merge = upsert_into(out, ["k"], ["ord"], "part", {"v": "keep_if_null"})
    run_once(stream.writeStream.foreachBatch(merge), str(tmp_path / "ck"))
    batch = merge_upsert(None, spark.createDataFrame([(k, o, o, v) for k, o, v in data], "k int, ord int, o int, v int"), ["k"], ["o"], {"v": "keep_if_null"})
    table = lambda: rows(spark.read.parquet(out).select("k", "ord", "v"))
    assert table() == rows(batch.select("k", "ord", "v"))
    # the last batch runs again after a crash, which changes nothing and leaves no copy behind
    again = spark.createDataFrame(data[150:], schema).withColumn("part", F.col("k") % 3)
    before = table()
    merge(again, 2)
    assert table() == before and not os.path.exists(f"{out}_staged")


def test_a_new_checkpoint_merges_its_own_rows(spark, tmp_path):
    out = str(tmp_path / "table")
    for n, part in enumerate(([(1, 0, 10), (2, 0, 20)], [(1, 1, 99), (3, 1, 30)])):
        source = str(tmp_path / f"src{n}")
        df = spark.createDataFrame(part, "k int, ord int, v int").withColumn("part", F.lit(0))
        df.write.parquet(source)
        merge = upsert_into(out, ["k"], ["ord"], "part")
        run_once(spark.readStream.schema(df.schema).parquet(source).writeStream.foreachBatch(merge), str(tmp_path / f"ck{n}"))
    assert rows(spark.read.parquet(out).select("k", "v")) == [(1, 99), (2, 20), (3, 30)]


def test_an_interrupted_replacement_is_published_before_the_next_batch(spark, tmp_path):
    out = str(tmp_path / "table")
    merge = upsert_into(out, ["k"], ["ord"], "part")
    df = lambda *r: spark.createDataFrame(r, "k int, ord int, v int, part int")
    merge(df((1, 0, 10, 0), (2, 0, 20, 0)), 0)
    # the merged rows are complete, the old ones are gone, the new ones not yet there
    spark.read.parquet(out).write.parquet(f"{out}_staged/rows")
    spark.range(1).write.parquet(f"{out}_staged/complete")
    shutil.rmtree(f"{out}/part=0")
    merge(df((2, 1, 21, 0)), 0)
    assert rows(spark.read.parquet(out).select("k", "v")) == [(1, 10), (2, 21)]


def test_landing_stream_keeps_line_order_within_a_batch(spark, tmp_path, write_lines):
    write_lines("in/a.jsonl", *[candle(1, c) for c in range(1, 50)])
    lines = scan_jsonl(spark, str(tmp_path / "in"), stream=True)
    docs = parse_candles(lines, "2026-01-01", at("2026-01-01")).select(*CANDLE_FIELDS, *FILE_ORDER)
    out = str(tmp_path / "table")
    keys = ["symbol", "interval", "open_time_ms"]
    merge = upsert_into(out, keys, FILE_ORDER, "interval")
    run_once(docs.writeStream.foreachBatch(merge), str(tmp_path / "ck"))
    assert rows(spark.read.parquet(out).select("open_time_ms", "close")) == [(1, "49")]


def test_tumbling_averages_correct_themselves_for_late_rows(spark, tmp_path):
    t0 = dt.datetime(2024, 1, 1, 10)
    source = str(tmp_path / "src")
    schema = "ts timestamp_ntz, v double"
    batches = [[(0, 1.0), (12, 5.0)], [(1, 3.0), (25, 7.0)], [(6000, 1.0)], [(2, 5.0)]]
    for b in batches:
        spark.createDataFrame([(t0 + dt.timedelta(minutes=m), v) for m, v in b], schema).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", "1").parquet(source)
    averages = tumbling_averages(stream, "ts", F.col("v"), 10).withColumn("day", F.to_date("hour_ts"))
    out = str(tmp_path / "table")
    merge = upsert_into(out, ["hour_ts"], ["avg_value"], "day")
    run_once(averages.writeStream.outputMode("update").foreachBatch(merge), str(tmp_path / "ck"))
    got = spark.read.parquet(out).where("day = date'2024-01-01'").select(F.minute("hour_ts"), "avg_value")
    assert rows(got) == [(0, 3.0), (10, 5.0), (20, 7.0)]


def test_stream_dedupe_keeps_one_row_per_key(spark, tmp_path):
    t0 = dt.datetime(2024, 1, 1)
    source = str(tmp_path / "src")
    # days apart, newest first
    df = spark.createDataFrame([(i, t0 - dt.timedelta(days=i)) for i in range(50)], "id int, ts timestamp_ntz")
    for part in (df.where("id < 25"), df.where("id >= 25"), df):
        part.coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", "1").parquet(source)
    out = str(tmp_path / "out")
    land_stream(dedupe_stream(stream, ["id"]), out, str(tmp_path / "ck"))
    assert rows(spark.read.parquet(out)) == rows(df)
