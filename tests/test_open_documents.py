"""Fields that no list declares, field by field."""

import json

from pyspark.sql import functions as F

from chainmart.functions import at
from chainmart.operators.merge import merge_payloads
from chainmart.plans import landing
from chainmart.plans import pipeline as pl
from chainmart.sources import scan_jsonl
from tests.test_pipeline import block, candle, listing, put


def test_payloads_by_last_writer(spark):
    schema = "k long, n int, extra map<string,string>"
    target = spark.createDataFrame([(1, 0, {"a": "1", "b": "1"}), (2, 0, {"a": "1"}), (4, 0, {})], schema).drop("n")
    updates = [
        (1, 1, {"b": "2", "c": "2"}),
        (1, 2, {"b": "null"}),
        (1, 3, {}),
        (2, 1, None),
        (3, 2, {"a": "2"}),
        (3, 1, {"a": "1", "z": "1"}),
        (None, 1, {"a": "x"}),
        (None, 2, {"b": "y"}),
        (4, 1, {}),
    ]
    got = merge_payloads(target, spark.createDataFrame(updates, schema), ["k"], ["n"], "extra").collect()
    assert {r.k: r.extra for r in got} == {
        1: {"a": "1", "b": "null", "c": "2"},
        2: {"a": "1"},
        3: {"a": "2", "z": "1"},
        None: {"a": "x", "b": "y"},
    }


def landed(spark, write_lines, state, name, *docs):
    path = write_lines(f"{name}/x.txt", *[json.dumps(d) for d in docs])
    state, _ = landing.land_candles(state, scan_jsonl(spark, path, "*.txt"), "2026-01-01", at("2026-01-01 00:00:00"))
    return state


def test_documents_keep_undeclared_fields(spark, write_lines):
    key = {"symbol": "A", "interval": "1m", "open_time_ms": 1}
    null_key = {"symbol": None, "interval": "1m", "open_time_ms": 2}
    state = landed(spark, write_lines, None, "one", {**key, "close": 1, "venue": "x", "deep": {"a": [1, None]}, "updated_at": "mine"},
                   {**null_key, "venue": "n"}, {**key, "open_time_ms": 3})
    state = landed(spark, write_lines, state, "two", {**key, "venue": None, "new": True}, {**null_key, "new": 1.5})
    got = {r.open_time_ms: r.extra for r in state.collect()}
    assert got == {1: {"venue": "null", "deep": '{"a":[1,null]}', "new": "true"}, 2: {"venue": '"n"', "new": "1.5"}, 3: {}}


def test_undeclared_fields_through_the_landing_job(spark, tmp_path):
    wh, raw = pl.Warehouse(spark, str(tmp_path / "wh")), tmp_path / "raw"
    put(raw, "blocks/2026-01-01/b.jsonl", block(1, 0, 1))
    put(raw, "listings/2026-01-01/l.json", listing(50.0))
    first, again = json.loads(candle(0, 1.0)), json.loads(candle(0, 2.0))
    put(raw, "candles/2026-01-01/a.jsonl", json.dumps({**first, "venue": "x", "note": "a"}))
    pl.land(wh, str(raw), "2026-01-01", "2026-01-01 00:00:00")
    put(raw, "candles/2026-01-01/b.jsonl", json.dumps({**again, "note": None}), candle(1, 1.0))
    pl.land(wh, str(raw), "2026-01-01", "2026-01-01 00:00:00")
    rows = wh.need("landing_candles").orderBy("open_time_ms").select("close", "extra", F.size("extra").alias("n")).collect()
    assert [(float(r.close), r.extra) for r in rows] == [(2.0, {"venue": '"x"', "note": "null"}), (1.0, {})]
