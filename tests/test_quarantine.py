"""Held rows and documents, the change log and the zone map, through the whole path."""

import json

from pyspark.sql import functions as F

from chainmart.operators.quarantine import Lookup, due, ledger_entries, record, resolve
from chainmart.plans import pipeline as pl
from chainmart.plans import star as st
from chainmart.streaming.upsert import compact_changes, merge_into, pruned
from tests.test_pipeline import block, candle, listing, ms, put, run


def test_resolve_loses_nothing(spark):
    rows = spark.createDataFrame([(1, "a", "x"), (2, "a", "y"), (3, "b", "x"), (4, None, "x"), (4, None, "x")], "id long, p string, q string")
    p = spark.createDataFrame([("a", 10)], "p string, pk long")
    q = spark.createDataFrame([("x", 20)], "q string, qk long")
    ready, waiting = resolve(rows, [Lookup("P", p, "p", "pk"), Lookup("Q", q, "q", "qk")])
    assert [tuple(r) for r in ready.select("id", "pk", "qk").collect()] == [(1, 10, 20)]
    got = sorted((r.id, r.waits_for, r.waits_member) for r in waiting.collect())
    assert got == [(2, "Q", "y"), (3, "P", "b"), (4, "P", None), (4, "P", None)]


def test_ledger_of_loads(spark):
    cols = "id long, p string, waits_for string, waits_member string"
    wait = lambda *rows: spark.createDataFrame(rows, cols)
    ledger = record(None, ledger_entries(wait((1, "a", "P", "a"), (2, "b", "P", "b")), None, 1), ["id"])
    p = spark.createDataFrame([("a", 10), ("a2", 11)], "p string, pk long")
    lookups = [Lookup("P", p, "p", "pk")]
    assert due(None, lookups) is None
    freed = due(ledger, lookups)
    assert [r.id for r in freed.collect()] == [1]
    entries = ledger_entries(wait((3, "c", "P", "c")), freed.select("id", "p", "waits_for", "waits_member"), 2)
    ledger = record(ledger, entries, ["id"])
    state = lambda l: sorted((r.id, r.since_run, r.released_run) for r in l.collect())
    assert state(ledger) == [(1, 1, 2), (2, 1, None), (3, 2, None)]
    assert state(record(ledger, entries, ["id"])) == state(ledger)  # a repeated load
    assert due(ledger, lookups).count() == 0


def test_facts_before_their_dimension(spark, tmp_path):
    """An asset loses its description: its snapshots are held, and loaded by the run after it is described again."""
    wh, raw = pl.Warehouse(spark, str(tmp_path / "wh")), tmp_path / "raw"
    two = json.loads(listing(50.0))
    two["data"].append({**two["data"][0], "id": 7, "symbol": "abc", "name": "Abc"})
    put(raw, "candles/2026-01-01/a.jsonl", candle(0, 1.0))
    put(raw, "blocks/2026-01-01/b.jsonl", block(1, 0, 1))
    put(raw, "listings/2026-01-01/l.json", json.dumps(two))
    now = "2026-01-01 00:45:00"
    pl.land(wh, str(raw), now[:10], now)
    pl.stage(wh, now)

    def describe(name):
        row = wh.need("cryptos").where("crypto_id = 7").withColumns({"name": F.lit(name), "_o": F.lit(0)})
        wh.upsert("cryptos", row, "part", ["crypto_id"], ["_o"], 0)

    describe(" ")
    ids = lambda name: sorted(r[0] for r in wh.need(name).select("crypto_id").collect())
    for _ in range(2):
        pl.build_star(wh, now)
        assert ids("fact_snapshot") == [1027]
        held = wh.need("fact_snapshot_pending").collect()
        assert [(r.crypto_id, r.waits_for, r.waits_member, r.released_run) for r in held] == [(7, "crypto", "7", None)]
    describe("Abc")
    for _ in range(2):
        pl.build_star(wh, now)
        assert ids("fact_snapshot") == [7, 1027]
        held = wh.need("fact_snapshot_pending").collect()
        assert len(held) == 1 and held[0].released_run > held[0].since_run


def test_documents_that_do_not_parse(spark, tmp_path):
    wh, raw = pl.Warehouse(spark, str(tmp_path / "wh")), tmp_path / "raw"
    put(raw, "candles/2026-01-01/a.jsonl", candle(0, 1.0))
    put(raw, "blocks/2026-01-01/b.jsonl", block(1, 0, 1))
    put(raw, "listings/2026-01-01/good.json", listing(50.0))
    put(raw, "listings/2026-01-01/cut.json", listing(60.0)[:-1])
    put(raw, "listings/2026-01-01/junk.json", "???")
    now = "2026-01-01 00:45:00"
    pl.land(wh, str(raw), now[:10], now)
    rejects = {r.source_file.rsplit("/", 1)[1]: r for r in wh.need("landing_listings_rejects").collect()}
    assert set(rejects) == {"cut.json", "junk.json"} and rejects["junk.json"].value == "???"
    assert wh.need("landing_listings").count() == 1
    pl.stage(wh, now)
    for _ in range(2):  # mended once; a second retry finds it landed
        pl.retry_listings(wh, lambda text: F.concat(text, F.lit("}")), "2026-01-01 01:00:00")
        assert wh.need("landing_listings").count() == 2
    pl.stage(wh, now)
    assert sorted(float(r.price_usd) for r in wh.need("metrics").collect()) == [50.0, 60.0]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_readers_open_only_new_runs(spark, tmp_path):
    wh, raw = pl.Warehouse(spark, str(tmp_path / "wh")), tmp_path / "raw"
    now = "2026-01-01 00:45:00"
    put(raw, "blocks/2026-01-01/b.jsonl", block(1, 0, 1))
    put(raw, "listings/2026-01-01/l.json", listing(50.0))
    for n in range(4):
        put(raw, f"candles/2026-01-01/{n}.jsonl", candle(n, 1.0 + n), candle(100, 200.0 + n))
        pl.land(wh, str(raw), now[:10], now)
        if n != 1:  # two runs are read together: the last version of a key counts
            pl.stage(wh, now)
        fresh = wh.fresh("landing_candles", "stage_candles", "landed_run", pl.landing.CANDLE_KEYS)
        if n:
            text = plan(fresh)
            mark = wh.mark("stage_candles")
            assert f"> {mark})" in text.split("PartitionFilters: [")[1].split("]")[0]
        minutes = sorted((r.open_time_ms - ms(0)) // 60000 for r in fresh.collect())
        assert minutes == ([1, 100] if n == 1 else [])
    closes = {(r.open_time_ms - ms(0)) // 60000: float(r.close) for r in wh.need("candles").collect()}
    assert closes == {0: 1.0, 1: 2.0, 2: 3.0, 3: 4.0, 100: 203.0}
    log = tmp_path / "wh/landing_candles_changes"
    assert len(list(log.glob("run=*"))) == 4
    wh.compact("landing_candles", "stage_candles", pl.landing.CANDLE_KEYS)
    assert len(list(log.glob("run=*"))) == 1
    left = spark.read.parquet(str(log))
    assert sorted((r.open_time_ms - ms(0)) // 60000 for r in left.collect()) == [0, 1, 2, 3, 100]
    pl.build_star(wh, now)
    assert wh.need("fact_candle").count() == 5


def test_compaction_keeps_what_readers_need(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = lambda run, *ks: spark.createDataFrame([(k, 0, run) for k in ks], "k long, part int, run_no int")
    newest = lambda old, new: st.merge_upsert(old, new.withColumn("_o", F.col("run_no")), ["k", "part"], ["_o"])
    for n, ks in ((1, (1, 2)), (2, (2, 3)), (3, (3, 4))):
        merge_into(path, "part", newest, "run_no", n)(rows(n, *ks), n)
    from chainmart.streaming.upsert import changes

    read = lambda above: sorted((r.k, r.run_no) for r in changes(spark, path, above, ["k"]).collect())
    before = {a: read(a) for a in range(4)}
    assert before[0] == [(1, 1), (2, 2), (3, 3), (4, 3)] and before[2] == [(3, 3), (4, 3)] and before[3] == []
    compact_changes(spark, path, 2, ["k"])
    assert {a: read(a) for a in (0, 2, 3)} == {a: before[a] for a in (0, 2, 3)}
    compact_changes(spark, path, 2, ["k"])
    assert read(0) == before[0]


def test_window_reaches_the_folders(spark, tmp_path):
    """Blocks cut by number, candles by day: only the folders of the window are opened, and the results stay."""
    wh, raw = pl.Warehouse(spark, str(tmp_path / "wh")), tmp_path / "raw"
    day = 24 * 60
    blocks = [block(1 + i * 50_000, i * day, 1 + i) for i in range(6)] + [block(2 + 4 * 50_000, 7 * day, 9)]
    put(raw, "blocks/2026-01-01/b.jsonl", *blocks)
    put(raw, "candles/2026-01-01/a.jsonl", *[candle(i * day, 1.0 + i) for i in range(6)])
    put(raw, "listings/2026-01-01/l.json", listing(50.0))
    run(wh, raw, "2026-01-08 00:00:00")
    zones = {r.slice: (r.least, r.greatest, r.n_rows) for r in wh.need("fact_block_zones").collect()}
    assert zones[4] == (ms(4 * day) * 1000, ms(7 * day) * 1000, 2) and len(zones) == 6
    window = "2026-01-03 00:00:00", "2026-01-04 12:00:00"
    star, whole = pl.load_star(wh, *window), pl.load_star(wh)
    for fact in (star.fact_block, star.fact_candle):
        assert "slice" in plan(fact).split("PartitionFilters: [")[1].split("]")[0]
        assert len({f.split("slice=")[1].split("/")[0] for f in fact.inputFiles()}) >= 1
    assert sorted(r.block_number for r in star.fact_block.collect()) == [100_001, 150_001]
    assert star.fact_candle.count() == 2
    for s in (star, whole):
        got = pl.an.bucket_price_fee(s, pl.an.Selection(), *window).orderBy("hour_ts").collect()
        assert [round(r.avg_base_fee_gwei) for r in got] == [3, 4]
    late = pl.load_star(wh, "2026-01-07 12:00:00", "2026-01-09 00:00:00").fact_block
    assert sorted(r.block_number for r in late.collect()) == [200_001, 200_002]
    none = pruned(wh.need("fact_block"), wh.need("fact_block_zones"), "slice", 0, 1)
    assert none.count() == 0
