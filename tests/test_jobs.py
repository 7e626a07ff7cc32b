"""Sources, landing, staging, star schema and analysis on hand-made rows."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from chainmart import sources as src
from chainmart.functions import at
from chainmart.operators import quality_counters
from chainmart.plans import analytics as an
from chainmart.plans import landing, reads, staging
from chainmart.plans import star as st
from chainmart.registry import base as b
from chainmart.sources.parsers import CANDLE_FIELDS



def now():
    return at("2026-01-02 00:00:00")


GOOD = {
    "symbol": "ethusdt ",
    "interval": "1m",
    "open_time_ms": 1767225600000,
    "open": 2970.1,
    "high": 2971.0,
    "low": 2969.5,
    "close": 2970.4,
    "volume": 12.5,
    "close_time_ms": 1767225659999,
    "quote_asset_volume": 37130.0,
    "number_of_trades": 210,
    "taker_buy_base_volume": 6.1,
    "taker_buy_quote_volume": 18119.4,
    "trading_day": "2026-01-01",
    "ingested_at": "2026-01-01T00:01:05Z",
}


def line(**change):
    doc = {**GOOD, **change}
    return json.dumps({k: v for k, v in doc.items() if v != "ABSENT"})


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# ---- candles


def test_candle_scan_counts_and_reasons(spark, tmp_path, write_lines):
    write_lines("in/2026-01-01/a.jsonl", line(), "", "   ", "not json", "[1,2]", line(symbol="ABSENT"), line(symbol=None))
    parsed = src.parse_candles(src.scan_jsonl(spark, str(tmp_path / "in")), "2026-01-01", now())
    reasons = [r[0] for r in parsed.orderBy("row_id").select("reject_reason").collect()]
    assert reasons == [None, "not_an_object", "not_an_object", "missing_symbol", None]
    first = parsed.orderBy("row_id").first()
    assert first["source_file"] == "a.jsonl" and first["source_ingested_at"] == GOOD["ingested_at"]
    assert set(first["fields_present"]) == {*CANDLE_FIELDS, "source_ingested_at"}


def test_landing_merges_field_by_field_in_path_order(spark, tmp_path, write_lines):
    # the folder written first sorts last
    write_lines("in/b.jsonl", line(close=3.0, volume="ABSENT", high=None))
    write_lines("in/a.jsonl", line(close=1.0, volume=1.0), line(close=2.0, volume=2.0, trading_day="ABSENT"))
    lines = src.scan_jsonl(spark, str(tmp_path / "in"))
    state, rejects = landing.land_candles(None, lines, "2026-01-01", now())
    row = state.first()
    assert state.count() == 1 and rejects.count() == 0
    assert (row["close"], row["volume"], row["high"], row["trading_day"]) == ("3", "2", None, "2026-01-01")
    assert row["source_file"] == "a.jsonl"  # set by the first document only
    # landing the same files again later keeps the first stamps
    later = at("2026-01-05 00:00:00")
    again, _ = landing.land_candles(state, lines, "2026-01-05", later)
    stamps = again.select("ingestion_ds", "ingested_at", "updated_at", "close", "volume").first()
    assert tuple(stamps) == ("2026-01-01", dt.datetime(2026, 1, 2), dt.datetime(2026, 1, 5), "3", "2")


def landed(spark, tmp_path, write_lines, *lines):
    write_lines("in/x.jsonl", *lines)
    return landing.land_candles(None, src.scan_jsonl(spark, str(tmp_path / "in")), "2026-01-01", now())[0]


def test_staging_rules_for_candles(spark, tmp_path, write_lines):
    changes = [
        {},
        {"symbol": None},
        {"symbol": "  "},
        {"interval": ""},
        {"close_time_ms": None},
        {"close": 0},
        {"close": -1},
        {"close": "abc"},
        {"close": None},
        {"close": "12.5"},
        {"volume": 1e30},
        {"trading_day": "20260101"},
        {"trading_day": "2026-1-1"},
        {"trading_day": "junk"},
    ]
    lines = [line(open_time_ms=i, **c) for i, c in enumerate(changes)]
    state = landed(spark, tmp_path, write_lines, *lines)
    staged, rejects = staging.stage_candles(None, state, now())
    why = {r["open_time_ms"]: r["reject_reason"] for r in rejects.collect()}
    assert why == {
        1: "blank_symbol",
        2: "blank_symbol",
        3: "blank_interval",
        4: "no_close_time",
        5: "bad_close",
        6: "bad_close",
        7: "bad_close",
        10: "out_of_range_volume",
    }
    days = {r["open_time_ms"]: r["trading_day"] for r in staged.collect()}
    day = dt.date(2026, 1, 1)
    assert days == {0: day, 8: day, 9: day, 11: day, 12: None, 13: None}
    assert {r["symbol"] for r in staged.collect()} == {"ETHUSDT"}
    assert dict(rows(quality_counters(state, staging.candle_rules())))["valid"] == 6


def test_staging_keeps_a_known_trading_day(spark, tmp_path, write_lines):
    state = landed(spark, tmp_path, write_lines, line())
    first, _ = staging.stage_candles(None, state, now())
    changed = state.withColumns({"trading_day": F.lit("junk"), "close": F.lit("5")})
    second, _ = staging.stage_candles(first, changed, at("2026-01-03 00:00:00"))
    row = second.first()
    assert (row["trading_day"], float(row["close"]), row["staged_at"]) == (dt.date(2026, 1, 1), 5.0, dt.datetime(2026, 1, 3))


def test_klines(spark):
    kline = [1, "1", "2", "0.5", "1.5", "10", 60, "15", 3, "4", "6", "ignored"]
    payload = json.dumps([kline, kline[:6], kline[:7], [*kline[:6], 99999]])
    df = spark.createDataFrame([("E", "1m", payload)], "symbol string, interval string, payload string")
    got = src.parse_klines(df, "payload", F.lit(1000)).select("close", "close_time_ms", "quote_asset_volume", "number_of_trades")
    assert rows(got) == [(1.5, 60, 15.0, 3), (1.5, 60, None, None)]


# ---- blocks

BLOCK = {
    "hash": "0xaa01",
    "number": "0x16e3600",
    "timestamp": "0x6955b900",
    "miner": "0x9522",
    "gasUsed": "0xe4e1c0",
    "gasLimit": "0x39386fd",
    "size": "0x1a2b",
    "baseFeePerGas": "0x1dcd6500",
    "transactions": ["0x1", {"hash": "0x2"}],
}


def block(**change):
    return json.dumps({k: v for k, v in {**BLOCK, **change}.items() if v != "ABSENT"})


def test_blocks_from_file_to_staging(spark, tmp_path, write_lines):
    write_lines(
        "in/b.jsonl",
        block(),
        block(hash=""),
        block(hash="0x2", number="ABSENT"),
        block(hash="0x3", number="zz"),
        block(hash="0x4", number=5),
        block(hash="0x5", timestamp="ABSENT"),
        block(hash="0x6", timestamp="zz"),
        block(hash="0x7", transactions=None, baseFeePerGas="500"),
        block(hash="0x8", baseFeePerGas="0x", gasUsed="0xf0000000000000000"),
        block(hash="0x9", number="16e3600"),
        block(size="0x1"),  # same hash again: wins
        "[]",
    )
    lines = src.scan_jsonl(spark, str(tmp_path / "in"))
    state, rejects = landing.land_blocks(None, lines, "2026-01-01", now())
    assert rows(rejects.select("reject_reason")) == sorted(
        [(r,) for r in ["not_an_object", "missing_hash", "missing_number", "bad_number", "bad_number", "bad_timestamp"]]
    )
    assert {r["hash"]: r["number"] for r in state.collect()}["0x9"] == 24000000
    staged, late = staging.stage_blocks(None, state, now())
    assert rows(late.select("hash", "reject_reason")) == [("0x5", "no_timestamp")]
    got = {r["block_hash"]: r for r in staged.collect()}
    assert set(got) == {"0xaa01", "0x7", "0x8", "0x9"}
    top = got["0xaa01"]
    assert (top["block_number"], top["tx_count"], top["size_bytes"], top["miner"]) == (24000000, 2, 1, "0x9522")
    assert top["base_fee_per_gas"] == 500_000_000 and top["ingestion_ds"] == dt.date(2026, 1, 1)
    assert (got["0x7"]["tx_count"], got["0x7"]["base_fee_per_gas"]) == (0, 500)
    assert (got["0x8"]["base_fee_per_gas"], got["0x8"]["gas_used"]) == (None, None)


def test_block_facts_latest_hash_per_number_wins(spark):
    k = {
        "block_hash": "string",
        "block_number": "bigint",
        "timestamp_unix": "bigint",
        "ingestion_ds": "date",
        "staged_at": "timestamp",
    }
    base = [("0xa", 5, 100, dt.date(2026, 1, 1), dt.datetime(2026, 1, 1)), ("0xb", 5, 101, None, dt.datetime(2026, 1, 2))]
    df = spark.createDataFrame(base, ", ".join(f"{n} {t}" for n, t in k.items()))
    for c in st.BLOCK_MEASURES:
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("int"))
    fact = st.load_fact_block(None, df, ["staged_at"]).first()
    assert (fact["block_hash"], fact["block_time_key"], fact["ingestion_ds"]) == ("0xb", 101_000_000, dt.date(2026, 1, 1))


# ---- listings


def asset(**change):
    doc = {
        "id": 1027,
        "symbol": "eth ",
        "name": " Ethereum",
        "slug": "ethereum",
        "last_updated": "2026-01-01T00:00:00.000Z",
        "quote": {"USD": {"price": 2970.4, "volume_24h": 1.9e10, "market_cap": 3.58e11, "percent_change_24h": -1.2}},
    }
    doc.update(change)
    return {k: v for k, v in doc.items() if v != "ABSENT"}


def usd(price):
    return {"USD": {"price": price}}


def test_listings_from_file_to_staging(spark, tmp_path):
    folder = tmp_path / "in" / "2026-01-01"
    folder.mkdir(parents=True)
    assets = [
        asset(),
        asset(slug="ABSENT", id=2),
        asset(slug=None, id=3),
        asset(id=0),
        asset(id=4, quote=usd(0)),
        asset(id=5, quote=usd(None)),
        asset(id=6, quote=usd("7.5")),
        asset(id=7, quote={}),
        asset(id=8, name=None),
        asset(id=9, quote="ABSENT"),
        asset(name="Second", quote=usd(1)),
        asset(id=10, symbol="x" * 21),
    ]
    (folder / "listings_20260101T0000.json").write_text(json.dumps({"data": assets}, indent=2))
    (folder / "listings_20260101T0001.json").write_text(json.dumps({"data": []}, indent=2))
    (folder / "listings_20260101T0002.json").write_text('{"data": [')
    docs = src.scan_documents(spark, str(tmp_path / "in"))
    assert rows(src.parse_listings(docs).select("parsed", "n_assets")) == [(False, None), (True, 0), (True, 12)]
    path = str(tmp_path / "raw")
    src.append_documents(docs, path, received_at=now())
    raw = spark.read.parquet(path)
    assert raw.count() == 2 and {r[0] for r in raw.select("status_code").collect()} == {200}
    listings, rejects = staging.clean_listings(raw, "api_response", "ingestion_timestamp")
    assert [r[0] for r in rejects.orderBy("pos").select("reject_reason").collect()] == [
        "incomplete",
        "no_id",
        "bad_price",
        "bad_price",
        "bad_price",
        "incomplete",
        "blank_name",
        "incomplete",
        "symbol_too_long",
    ]
    cryptos = staging.stage_cryptos(None, listings, ["ingestion_timestamp", "pos"], now())
    assert rows(cryptos.select("crypto_id", "symbol", "name", "slug")) == [
        (1027, "ETH", "Second", "ethereum"),
        (3, "ETH", "Ethereum", None),
    ]
    metrics = staging.stage_metrics(None, listings, ["pos"], "ingestion_timestamp")
    assert {r["crypto_id"]: float(r["price_usd"]) for r in metrics.collect()} == {1027: 2970.4, 3: 2970.4}
    assert staging.stage_metrics(metrics, listings, ["pos"], "ingestion_timestamp").count() == 2


# ---- sinks


def test_jsonl_round_trip_and_partition_fallback(spark, tmp_path):
    df = spark.createDataFrame(
        [("2026-01-01", "ETH", "1m", 1), ("2026-01-02", "ETH", "1m", 2), ("2026-01-02", "BTC", "5m", 3)],
        "ds string, symbol string, interval string, open_time_ms bigint",
    )
    path = str(tmp_path / "out")
    src.write_jsonl(df.where("open_time_ms < 3"), path)
    src.write_jsonl(df.where("open_time_ms = 3"), path)
    back = spark.read.schema(df.schema).json(path).select(df.columns)
    assert rows(back) == rows(df)
    assert rows(src.scan_partition(back, "2026-01-02", only_ds=True)) == rows(df.where("ds = '2026-01-02'"))
    assert src.scan_partition(back, "2026-01-02", only_ds=False).count() == 3
    assert src.scan_partition(back, "1999-01-01", only_ds=True).count() == 3
    plan = src.scan_partition(back, "2026-01-02", only_ds=True)._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(ds" in plan


def test_csv_export(spark, tmp_path):
    times = [dt.datetime(2026, 1, 1), dt.datetime(2026, 1, 1, 0, 0, 0, 250), None]
    df = spark.createDataFrame([(t, 1.5) for t in times], "hour_ts timestamp_ntz, v double")
    path = str(tmp_path / "csv")
    src.write_csv(df.coalesce(1), path)
    text = spark.read.text(path)
    assert text.first()[0] == "hour_ts,v" and text.count() == 4
    back = spark.read.schema(df.schema).option("header", "true").option("enforceSchema", "false").csv(path)
    assert rows(back) == rows(df)


def test_run_history_is_appended(spark, tmp_path):
    path = str(tmp_path / "runs")
    for n in (1, 2):
        src.append_rows(spark.createDataFrame([(n,)], "n int"), path)
    src.append_rows(spark.createDataFrame([], "n int"), path)
    assert rows(spark.read.parquet(path)) == [(1,), (2,)]


def test_write_merged_replaces_only_touched_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    src.write_merged(spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, v string, day string"), path, "day")
    src.write_merged(spark.createDataFrame([(1, "new", "x")], "k int, v string, day string"), path, "day")
    assert rows(spark.read.parquet(path)) == [(1, "new", "x"), (2, "b", "y")]


# ---- dimensions and analysis


def test_dim_asset_never_erases_known_parts(spark):
    old = spark.createDataFrame([(1, "FOO", "F", "OO")], "asset_key bigint, symbol string, base_asset string, quote_asset string")
    seen = spark.createDataFrame([(" foo ",), ("ethusdt",), (None,), ("",)], "symbol string")
    got = st.build_dim_asset(old, seen).select("symbol", "base_asset", "quote_asset")
    assert rows(got) == [("ETHUSDT", "ETH", "USDT"), ("FOO", "F", "OO")]


def fake_star(spark, candles=(), blocks=(), snapshots=(), cryptos=((7, "ETH", "Ether"), (9, "ETH", "Other"))):
    us = lambda t: int(t.replace(tzinfo=dt.timezone.utc).timestamp() * 1_000_000)
    candle = spark.createDataFrame(
        [(us(t), c, v) for t, c, v in candles], "open_time_key bigint, close double, quote_asset_volume double"
    )
    assets = spark.createDataFrame([("ETHUSDT",)], "symbol string")
    dim_asset = st.build_dim_asset(None, assets)
    dim_interval = st.build_dim_interval(None, spark.createDataFrame([("1m",)], "interval string"))
    return st.Star(
        dim_exchange=st.seed_exchanges(spark),
        dim_asset=dim_asset,
        dim_interval=dim_interval,
        dim_chain=st.seed_chains(spark),
        dim_crypto=spark.createDataFrame(list(cryptos), "crypto_id bigint, symbol string, name string"),
        fact_candle=candle.selectExpr(
            "*", "xxhash64('Binance') as exchange_key", "xxhash64('ETHUSDT') as asset_key", "xxhash64('1m') as interval_key"
        ),
        fact_block=spark.createDataFrame(
            [(us(t), f) for t, f in blocks], "block_time_key bigint, base_fee_per_gas bigint"
        ).selectExpr("*", "xxhash64('Ethereum') as chain_key"),
        fact_snapshot=spark.createDataFrame(
            [(c, us(t), i, p, 1.0, m, 0.0) for i, (c, t, p, m) in enumerate(snapshots)],
            "crypto_id bigint, time_key bigint, staged_metric_id bigint, price_usd double, volume_24h double, "
            "market_cap double, percent_change_24h double",
        ),
    )


T = dt.datetime(2026, 1, 1, 10, 0)
M = lambda m, s=0: T + dt.timedelta(minutes=m, seconds=s)
START, END = "2026-01-01 10:05:00", "2026-01-01 11:00:00"


def test_integrated_buckets_edges(spark):
    star = fake_star(
        spark,
        # the first candle lies in the window, its bucket starts before it
        candles=[(M(6), 1.0, 1.0), (M(12), 2.0, None), (M(13), 4.0, 6.0), (M(14), None, 9.0), (M(60), 9.0, 9.0)],
        blocks=[(M(21), 3_000_000_000), (M(22), None), (M(25), 1_000_000_000)],
        snapshots=[(7, M(-600), 50.0, 500.0), (7, M(20), None, 700.0), (7, M(20, 1), 60.0, 600.0), (9, M(9), 1.0, 1.0)],
    )
    got = an.integrated_buckets(star, an.Selection(), START, END)
    assert rows(got.drop("base_symbol")) == [
        (M(10), 50.0, 500.0, 3.0, 6.0, None),
        (M(20), None, 700.0, None, None, 2.0),  # the snapshot at the start counts, one second later does not
    ]
    assert {r[0] for r in got.select("base_symbol").collect()} == {"ETH"}


def test_bucket_price_fee_needs_both_sides(spark):
    star = fake_star(spark, candles=[(M(12), 2.0, 1.0), (M(32), 2.0, 1.0)], blocks=[(M(33), 5_000_000_000)])
    assert rows(an.bucket_price_fee(star, an.Selection(asset=" ethusdt "), START, END)) == [(M(30), 2.0, 1.0, 5.0)]
    assert an.bucket_price_fee(star, an.Selection(exchange="Nowhere"), START, END).count() == 0


def test_run_summary_needs_three_buckets_and_tolerates_constants(spark):
    sel = an.Selection()
    table = lambda n: spark.createDataFrame(
        [(M(10 * i), 5.0, float(i), float(i)) for i in range(n)],
        "hour_ts timestamp_ntz, avg_close_usdt double, avg_volume_usdt double, avg_base_fee_gwei double",
    )
    assert an.corr_run_summary(table(2), sel, T, END, END).count() == 0
    row = an.corr_run_summary(table(4), sel, T, END, END).first()
    assert (row["n_hours"], row["corr_price_vs_base_fee_gwei"]) == (4, None)
    assert row["corr_volume_vs_base_fee_gwei"] == pytest.approx(1.0)
    stats = reads.summary_stats(table(4), T, END).first()
    assert (stats["n_hours"], stats["span_hours"], stats["corr_price_vs_base_fee"]) == (4, 0.5, None)


def test_integrated_daily_full_outer(spark):
    star = fake_star(
        spark,
        candles=[(T, 2.0, 4.0)],
        blocks=[(T + dt.timedelta(days=1), 7_000_000_000)],
        snapshots=[(7, T + dt.timedelta(days=2), 1.0, 2.0), (7, T + dt.timedelta(days=2, hours=1), None, 3.0)],
    )
    got = an.integrated_daily(star, an.Selection(), "2026-01-01 00:00:00", "2026-02-01 00:00:00")
    assert rows(got.drop("base_symbol")) == [
        (dt.date(2026, 1, 1), None, None, 2.0, 4.0, None),
        (dt.date(2026, 1, 2), None, None, None, None, 7.0),
        (dt.date(2026, 1, 3), None, 3.0, None, None, None),
    ]


def test_top_assets_nulls_last_and_kept_rows(spark):
    names = [(i, f"S{i}", f"N{i}") for i in range(1, 6)]
    star = fake_star(
        spark,
        snapshots=[(1, M(0), 1.0, 10.0), (1, M(1), 1.0, None), (2, M(0), 1.0, 30.0), (3, M(0), 1.0, 20.0), (99, M(0), 1.0, 999.0)],
        cryptos=names,
    )
    top = an.top_assets(star, 0)  # at least one
    assert rows(top.select("rank", "crypto_id")) == [(1, 2)]
    top = an.top_assets(star, 10)
    assert [tuple(r) for r in top.orderBy("rank").select("rank", "crypto_id", "market_cap").collect()] == [
        (1, 2, 30.0),
        (2, 3, 20.0),
        (3, 1, None),
    ]
    table = an.upsert_top_assets(None, top, now())
    table = an.upsert_top_assets(table, an.top_assets(star, 1), now())
    assert table.count() == 3


def test_daily_upsert_is_keyed_by_date_alone(spark):
    day = lambda s: spark.createDataFrame([(dt.date(2026, 1, 1), s, 1.0)], "trading_date date, base_symbol string, p double")
    table = an.upsert_daily(an.upsert_daily(None, day("ETH"), now()), day("BTC"), now())
    assert rows(table.select("base_symbol")) == [("BTC",)]


def test_reads(spark):
    days = spark.createDataFrame(
        [(dt.date(2026, 1, d), None if d < 3 else "ETH") for d in range(1, 6)], "trading_date date, base_symbol string"
    )
    closed = reads.rows_in_window(days, "2026-01-02 00:00:00", "2026-01-04 00:00:00").first()[0]
    half_open = reads.read_daily_range(days, "2026-01-02 00:00:00", "2026-01-04 00:00:00").collect()
    assert closed == 3 and [r["trading_date"].day for r in half_open] == [2, 3]
    assert {r["shown_symbol"] for r in half_open} == {"ETH"}
    snaps = spark.createDataFrame([(M(0),), (M(1),), (M(1),)], "snapshot_ts timestamp_ntz")
    assert reads.latest_snapshot_ts(snaps, T, M(1)).first()[0] == M(0)
    assert reads.latest_snapshot_ts(snaps, M(100), M(200)).first()[0] == M(1)
    assert reads.latest_snapshot_ts(snaps.limit(0), T, M(1)).first()[0] is None
    assert reads.latest_snapshot_count(snaps).first() == (M(1), 2)
    runs = spark.createDataFrame([(M(i), i) for i in range(5)], "run_ts timestamp_ntz, n int")
    assert [r["n"] for r in reads.latest_runs(runs, 2).collect()] == [3, 4]


def test_selection_and_lookback():
    sel = an.Selection(asset=" btcusdt ", base_symbol="eth ", exchange=" Binance")
    assert (sel.asset, sel.base_symbol, sel.exchange) == ("BTCUSDT", "ETH", "Binance")
    now = dt.datetime(2026, 1, 31)
    assert an.lookback(now, 30) == (dt.datetime(2026, 1, 1), now)
    assert an.lookback(now, 0)[0] == dt.datetime(2026, 1, 30)


def test_late_rows_recompute_only_their_buckets(spark):
    schema = "ts timestamp_ntz, base_fee_per_gas bigint"
    blocks = spark.createDataFrame([(M(1), 10**9), (M(2), 3 * 10**9), (M(31), 5 * 10**9)], schema)
    late = blocks.where(F.col("ts") == at(M(2)))
    # the value of the untouched bucket is deliberately off: it must not be recomputed
    target = spark.createDataFrame([(M(0), 1.0), (M(30), 77.0)], "hour_ts timestamp_ntz, avg_base_fee_gwei double")
    got = an.recompute_touched_buckets(target, blocks, late, 10)
    assert rows(got) == [(M(0), 2.0), (M(30), 77.0)]


def test_event_shapes_have_the_columns_of_a_star():
    for name in st.Star.__dataclass_fields__:
        assert hasattr(b.EventStar, name)
