"""Raw files through all four jobs, twice."""

import datetime as dt
import json

import pytest

from chainmart.plans import pipeline as pl
from chainmart.plans import reads
from chainmart.plans.analytics import Selection, integrated_buckets

T0 = dt.datetime(2026, 1, 1, tzinfo=dt.timezone.utc)


def ms(minute):
    return int((T0 + dt.timedelta(minutes=minute)).timestamp() * 1000)


def candle(minute, close):
    return json.dumps(
        {
            "symbol": "ethusdt ",
            "interval": "1m",
            "open_time_ms": ms(minute),
            "close_time_ms": ms(minute) + 59999,
            "close": close,
            "quote_asset_volume": close * 10,
            "trading_day": "2026-01-01",
        }
    )


def block(number, minute, fee):
    stamp = hex(ms(minute) // 1000)
    return json.dumps({"hash": f"0xh{number}", "number": hex(number), "timestamp": stamp, "baseFeePerGas": hex(fee * 10**9)})


def listing(price):
    usd = {"price": price, "volume_24h": 5.0, "market_cap": price * 100}
    return json.dumps({"data": [{"id": 1027, "symbol": "eth", "name": "Ether", "slug": "e", "last_updated": None, "quote": {"USD": usd}}]}, indent=1)


def put(raw, name, *lines):
    path = raw / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines))


def run(wh, raw, now):
    pl.land(wh, str(raw), now[:10], now)
    pl.stage(wh, now)
    pl.build_star(wh, now)
    pl.analyse(wh, now)


def counts(wh):
    names = "landing_candles candles candles_rejects blocks cryptos metrics fact_candle fact_block fact_snapshot"
    names += " dim_asset dim_interval dim_exchange dim_chain dim_crypto bucket_price_fee integrated_daily"
    return {n: wh.need(n).count() for n in names.split()}


def test_two_runs(spark, tmp_path):
    wh, raw = pl.Warehouse(spark, str(tmp_path / "wh")), tmp_path / "raw"
    with pytest.raises(LookupError):
        pl.load_star(wh)
    put(raw, "candles/2026-01-01/a.jsonl", *[candle(m, 100.0 + m) for m in range(0, 40, 5)], candle(41, -1), "junk")
    put(raw, "blocks/2026-01-01/b.jsonl", *[block(i, i * 8, 10 + i * i) for i in range(5)])
    put(raw, "listings/2026-01-01/l1.json", listing(50.0))
    run(wh, raw, "2026-01-01 00:45:00")
    first = counts(wh)
    assert first == {
        "landing_candles": 9,
        "candles": 8,
        "candles_rejects": 1,
        "blocks": 5,
        "cryptos": 1,
        "metrics": 1,
        "fact_candle": 8,
        "fact_block": 5,
        "fact_snapshot": 1,
        "dim_asset": 1,
        "dim_interval": 1,
        "dim_exchange": 1,
        "dim_chain": 1,
        "dim_crypto": 1,
        "bucket_price_fee": 4,
        "integrated_daily": 1,
    }
    history = wh.need("corr_runs").collect()
    assert [r["n_hours"] for r in history] == [4] and history[0]["corr_price_vs_base_fee_gwei"] is not None

    # one candle is corrected, one added, a second listing arrives; everything else stays
    put(raw, "candles/2026-01-01/c.jsonl", candle(0, 500.0), candle(50, 200.0))
    put(raw, "blocks/2026-01-01/d.jsonl", block(4, 60 * 24, 26).replace("0xh4", "0xh4b"))  # re-organised, a day later
    put(raw, "listings/2026-01-01/l2.json", listing(60.0))
    run(wh, raw, "2026-01-01 01:00:00")
    second = counts(wh)
    changed = {"blocks": 6, "landing_candles": 10, "candles": 9, "metrics": 2, "fact_candle": 9, "fact_snapshot": 2}
    assert second == {**first, **changed}
    facts = {r["open_time_key"]: float(r["close"]) for r in wh.need("fact_candle").collect()}
    assert facts[ms(0) * 1000] == 500.0 and facts[ms(5) * 1000] == 105.0
    number4 = wh.need("fact_block").where("block_number = 4").collect()
    assert [r["block_hash"] for r in number4] == ["0xh4b"]
    top = wh.need("top_assets").orderBy("snapshot_ts").collect()
    assert [(float(r["price_usd"]), r["rank"]) for r in top] == [(50.0, 1), (60.0, 1)]
    buckets = reads.read_bucket_range(wh.need("bucket_price_fee"), "2026-01-01 00:00:00", "2026-01-02 00:00:00").collect()
    assert buckets[0]["avg_close_usdt"] == pytest.approx((500.0 + 105.0) / 2)
    assert wh.need("corr_runs").count() == 2

    # loading again without new files changes nothing
    third = "2026-01-01 01:15:00"
    pl.land(wh, str(raw), third[:10], third)
    pl.stage(wh, third)
    pl.build_star(wh, third)
    assert counts(wh) == second
    live = integrated_buckets(pl.load_star(wh), Selection(), "2026-01-01 00:00:00", "2026-01-02 00:00:00")
    last = live.orderBy("bucket_ts").collect()[-1]
    assert (last["bucket_ts"].minute, last["cmc_price_usd"]) == (50, 50.0)


def test_nothing_is_lost_between_jobs_and_rejects_come_once(spark, tmp_path):
    """One ``now`` for every run, then an earlier one; each file is staged and each bad row rejected once."""
    wh, raw = pl.Warehouse(spark, str(tmp_path / "wh")), tmp_path / "raw"
    put(raw, "blocks/2026-01-01/b.jsonl", block(1, 0, 1))
    put(raw, "listings/2026-01-01/l.json", listing(50.0))
    now, earlier = "2026-01-01 00:45:00", "2025-12-31 00:00:00"
    files = [("a", now, [candle(0, 1.0), candle(1, -1), "junk"]), ("b", now, [candle(2, 1.0)]), ("c", earlier, [candle(3, 1.0)])]
    for name, at_time, lines in files:
        put(raw, f"candles/2026-01-01/{name}.jsonl", *lines)
        pl.land(wh, str(raw), at_time[:10], at_time)
        pl.stage(wh, at_time)
        pl.stage(wh, at_time)
        pl.build_star(wh, at_time)
    minutes = lambda name, c, unit: sorted((r[0] - ms(0) * unit) // (60000 * unit) for r in wh.need(name).select(c).collect())
    assert minutes("candles", "open_time_ms", 1) == [0, 2, 3]
    assert minutes("fact_candle", "open_time_key", 1000) == [0, 2, 3]
    assert wh.need("candles_rejects").count() == 1
    assert wh.need("landing_candles_rejects").count() == 1
