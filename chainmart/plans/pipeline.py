"""The whole path as four jobs over one warehouse folder: land, stage, build the star, analyse.

Each job reads what is new, merges it into Parquet tables cut into slices (days, or ranges
of block numbers) that follow from the key, and can be run again: files are remembered by the stream checkpoint, rows by
the number of the run that wrote them. Run numbers only grow, whatever clock the caller passes as ``now``, and a reader's mark
moves over every row it has read, valid or not, so no row is passed over and no reject is reported twice.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import at, from_epoch_ms, from_epoch_s
from ..operators.marks import high_water_mark
from ..operators.merge import insert_if_absent, merge_documents, merge_upsert
from ..operators.quarantine import Lookup, due, ledger_entries, record
from ..sources.parsers import parse_blocks, parse_candles
from ..sources.scans import FILE_ORDER, scan_documents, scan_jsonl
from ..sources.sinks import append_rows, raw_documents, rejected_documents, write_merged
from ..streaming.jobs import run_once
from ..streaming.upsert import changes, compact_changes, merge_into, pruned, read_or_none
from . import analytics as an
from . import landing, staging
from . import star as st


def day_of(ts: Column) -> Column:
    """Partition value: days since the epoch, -1 where the time is unknown."""
    return F.coalesce(F.unix_date(F.to_date(ts)), F.lit(-1)).alias("slice")


def range_of(number: str) -> Column:
    """Partition value of block tables: 50,000 numbers each. A block re-organised to another
    hash may change its time, even its day, but never its number."""
    return F.floor(F.col(number) / 50_000).cast("int").alias("slice")


def part_of(key: str) -> Column:
    """Partition value of a table without a time: one of eight parts."""
    return F.pmod(F.xxhash64(key), F.lit(8)).cast("int").alias("part")


@dataclass(frozen=True)
class Warehouse:
    """Tables below one root folder, which every executor must reach."""

    spark: SparkSession
    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def read(self, name: str) -> DataFrame | None:
        return read_or_none(self.spark, self.path(name))

    def need(self, name: str) -> DataFrame:
        """The table, or an error saying which earlier job has to run first."""
        df = self.read(name)
        if df is None:
            raise LookupError(f"table {name} does not exist yet")
        return df

    def begin(self, job: str) -> int:
        """Number of a new run, above all earlier ones. One job at a time writes to a warehouse."""
        runs = self.read("runs")
        run = 1 + ((None if runs is None else runs.agg(F.max("run")).first()[0]) or 0)
        append_rows(self.spark.range(1).select(F.lit(run).alias("run"), F.lit(job).alias("job")), self.path("runs"))
        return run

    def merge(self, name: str, rows: DataFrame, partition: str, fn: Callable, run: int, written_by=None, zone=None) -> None:
        merge_into(self.path(name), partition, fn, written_by, run, zone)(rows, run)

    def upsert(
        self, name: str, rows: DataFrame, partition: str, keys: Sequence[str], order, run, policies=None, written_by=None, zone=None
    ) -> None:
        """Merge rows whose ``order`` columns are dropped afterwards."""

        def fn(target, batch):
            return merge_upsert(target, batch, [*keys, partition], order, policies)

        self.merge(name, rows, partition, fn, run, written_by, zone)

    def mark(self, source: str) -> int:
        """Number of the last run whose rows ``source`` has read; 0 before its first run."""
        marks = self.read("marks")
        found = None if marks is None else marks.where(F.col("source") == source).agg(F.max("mark")).first()[0]
        return found or 0

    def fresh(self, name: str, source: str, written_by: str, keys: Sequence[str] = ()) -> DataFrame:
        """Rows of a table written by runs above the mark of ``source``.

        Tables with keys have a change log, of which only the folders of these runs are opened; others are cut by
        ``written_by`` themselves. A source that has no mark yet reads the table.
        """
        table, mark = self.need(name), self.mark(source)
        new = changes(self.spark, self.path(name), mark, keys) if keys and mark else None
        return table.where(F.col(written_by) > mark) if new is None else new.select(*table.columns)

    def compact(self, name: str, source: str, keys: Sequence[str]) -> None:
        """Put the change log's runs that ``source``, the log's reader, has read into one folder."""
        compact_changes(self.spark, self.path(name), self.mark(source), keys)

    def reject(self, name: str, source: str, rows: DataFrame) -> None:
        """Rejects beside table ``name``, under the mark they were read above: a run that is repeated before its mark
        has moved reads the same rows again, and replaces them."""
        keyed = rows.withColumn("above", F.lit(self.mark(source)))
        write_merged(keyed, self.path(f"{name}_rejects"), "above")

    def advance(self, source: str, rows: DataFrame, written_by: str) -> None:
        """Record how far ``rows`` reach, the last step of a run; nothing is recorded where there are none."""
        new = high_water_mark(rows, written_by).where("n_rows > 0")
        append_rows(new.select(F.lit(source).alias("source"), "mark"), self.path("marks"))


def land(wh: Warehouse, raw: str, ds: str, now: str) -> None:
    """New files below ``raw/{candles,blocks,listings}`` into the landing tables."""
    stamp, run = at(now), wh.begin("land")

    def land_lines(parsed: DataFrame, name: str, cut: Column, merge: Callable) -> None:
        into = merge_into(wh.path(name), "slice", merge, "landed_run", run)

        def each(batch: DataFrame, batch_id: int) -> None:
            batch = batch.withColumns({"row_id": F.monotonically_increasing_id(), "landed_run": F.lit(run)}).persist()
            ok = F.col("reject_reason").isNull()
            into(batch.where(ok).drop("reject_reason").withColumn("slice", cut), batch_id)
            # a batch that is repeated replaces its rejects; a new checkpoint reads under another query id
            query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
            rejects = batch.where(~ok).select(
                "source_file", "reject_reason", "updated_at", F.lit(f"{query}-{batch_id}").alias("batch")
            )
            write_merged(rejects, wh.path(f"{name}_rejects"), "batch")
            batch.unpersist()

        run_once(parsed.writeStream.foreachBatch(each), wh.path(f"checkpoints/{name}"))

    def merge_candles(target: DataFrame | None, batch: DataFrame) -> DataFrame:
        carried = batch.withColumn("fields_present", F.concat("fields_present", F.array(F.lit("updated_at"), F.lit("landed_run"))))
        fields = [f for f in (*landing.CANDLE_FIELDS, "source_ingested_at") if f not in landing.CANDLE_KEYS]
        return merge_documents(
            target,
            carried,
            [*landing.CANDLE_KEYS, "slice"],
            FILE_ORDER,
            [*fields, "updated_at", "landed_run"],
            landing.LANDING_STAMPS,
            payload="extra",
        )

    def merge_blocks(target: DataFrame | None, batch: DataFrame) -> DataFrame:
        first = {c: "set_on_insert" for c in landing.LANDING_STAMPS}
        return merge_upsert(target, batch, ["hash", "slice"], FILE_ORDER, first)

    candles = scan_jsonl(wh.spark, f"{raw}/candles", stream=True)
    land_lines(
        parse_candles(candles, ds, stamp), "landing_candles", day_of(from_epoch_ms(F.col("open_time_ms"))), merge_candles
    )
    blocks = scan_jsonl(wh.spark, f"{raw}/blocks", stream=True)
    land_lines(
        parse_blocks(blocks, ds, stamp), "landing_blocks", range_of("number"), merge_blocks
    )
    def land_documents(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        _land_documents(wh, batch, stamp, run, f"{query}-{batch_id}")
        batch.unpersist()

    listings = scan_documents(wh.spark, f"{raw}/listings", stream=True)
    run_once(listings.writeStream.foreachBatch(land_documents), wh.path("checkpoints/listings"))


def _land_documents(wh: Warehouse, docs: DataFrame, stamp: Column, run: int, batch: str) -> None:
    """Documents into their table, files that do not parse beside it; a repeated batch replaces what it wrote."""
    rows = raw_documents(docs, received_at=stamp).withColumns({"landed_run": F.lit(run), "batch": F.lit(batch)})
    write_merged(rows, wh.path("landing_listings"), "landed_run", "batch")
    rejects = rejected_documents(docs, stamp).withColumns({"landed_run": F.lit(run), "batch": F.lit(batch)})
    write_merged(rejects, wh.path("landing_listings_rejects"), "landed_run", "batch")


def retry_listings(wh: Warehouse, mend: Callable[[Column], Column], now: str) -> None:
    """Parse the rejected listing files again, after ``mend`` has been applied to their texts.

    What parses now is landed by this run and staged by the next one. A file that is rejected again stays as it is; one
    that has landed since it was rejected is passed over, so the retry can be repeated.
    """
    rejects, landed = wh.read("landing_listings_rejects"), wh.read("landing_listings")
    if rejects is None:
        return
    if landed is not None:
        rejects = rejects.join(landed.select("source_file"), "source_file", "left_anti")
    docs = rejects.select(F.col("source_file").alias("file_path"), F.try_parse_json(mend(F.col("value"))).alias("doc"))
    run = wh.begin("retry_listings")
    rows = raw_documents(docs, received_at=at(now)).withColumns({"landed_run": F.lit(run), "batch": F.lit(f"retry-{run}")})
    write_merged(rows, wh.path("landing_listings"), "landed_run", "batch")


def stage(wh: Warehouse, now: str) -> None:
    """Landing rows above the marks into the staging tables; rejects are kept beside them."""
    stamp, run = at(now), wh.begin("stage")

    docs = wh.fresh("landing_candles", "stage_candles", "landed_run", landing.CANDLE_KEYS).persist()
    typed, rejects = staging.clean_candles(docs)
    rows = typed.select(
        *staging.CANDLE_COLUMNS,
        stamp.alias("staged_at"),
        F.lit(run).alias("staged_run"),
        "landed_run",
        "updated_at",
        "raw_key",
        day_of(from_epoch_ms(F.col("open_time_ms"))),
    )
    keys = ["symbol", "interval", "open_time_ms"]
    order = ["landed_run", "updated_at", "raw_key"]
    wh.upsert("candles", rows, "slice", keys, order, run, {"trading_day": "keep_if_null"}, "staged_run")
    wh.reject("candles", "stage_candles", rejects.select(*keys, "reject_reason", "updated_at"))
    wh.advance("stage_candles", docs, "landed_run")
    docs.unpersist()

    docs = wh.fresh("landing_blocks", "stage_blocks", "landed_run", ["hash"]).persist()
    typed, rejects = staging.clean_blocks(docs)
    rows = typed.withColumns({"staged_at": stamp, "staged_run": F.lit(run), "slice": range_of("block_number")})
    wh.upsert("blocks", rows, "slice", ["block_hash"], ["updated_at"], run, {"ingestion_ds": "keep_if_null"}, "staged_run")
    wh.reject("blocks", "stage_blocks", rejects.select("hash", "reject_reason", "updated_at"))
    wh.advance("stage_blocks", docs, "landed_run")
    docs.unpersist()

    raw = wh.fresh("landing_listings", "stage_listings", "landed_run")
    listed, rejects = staging.clean_listings(raw, "api_response", "ingestion_timestamp", "source_file")
    order = ["recorded_at", "source_file", "pos"]
    listed = listed.withColumnRenamed("ingestion_timestamp", "recorded_at")
    master = listed.select("crypto_id", "symbol", "name", "slug", "last_updated", part_of("crypto_id"), *order)
    wh.upsert("cryptos", master.withColumn("processed_at", stamp), "part", ["crypto_id"], order, run)
    metric_keys = ["crypto_id", "recorded_at"]
    metrics = listed.drop("symbol", "name", "slug", "last_updated").withColumns(
        {"metric_id": F.xxhash64(*metric_keys), "staged_at": stamp, "staged_run": F.lit(run), "slice": day_of(F.col("recorded_at"))}
    )

    def first_stays(target: DataFrame | None, batch: DataFrame) -> DataFrame:
        if target is None:
            return insert_if_absent(None, batch, metric_keys, order).drop("source_file", "pos")
        return insert_if_absent(target, batch, metric_keys, order)

    wh.merge("metrics", metrics, "slice", first_stays, run, "staged_run")
    wh.reject("listings", "stage_listings", rejects.select("source_file", "pos", "reject_reason"))
    wh.advance("stage_listings", raw, "landed_run")


def build_star(wh: Warehouse, now: str) -> None:
    """Staging rows above the marks into dimensions and facts."""
    spark, run = wh.spark, wh.begin("build_star")

    def dim(name: str, rows: DataFrame, natural: str, policies=None) -> None:
        rows = rows.withColumns({"part": part_of(natural), "_o": F.lit(0)})
        wh.upsert(name, rows, "part", [natural], ["_o"], run, policies)

    def fact(name: str, rows: DataFrame, cut: Column, loaded_keys: Sequence[str], policies=None, zone=None) -> None:
        rows = rows.withColumns({"slice": cut, "_o": F.lit(0)})
        wh.upsert(name, rows, "slice", loaded_keys, ["_o"], run, policies, zone=zone)

    def quarantined(name: str, source: str, new: DataFrame, lookups: Sequence[Lookup], split: Callable, keys: Sequence[str]):
        """Rows that can be loaded now, held ones whose member has come among them; and what to do once they are."""
        ledger = wh.read(f"{name}_pending")
        freed = due(ledger, lookups)
        freed = None if freed is None else freed.select(*new.columns).persist()
        ready, waiting, rejects = split(new if freed is None else new.unionByName(freed))
        wh.reject(name, source, rejects.select(*keys, "reject_reason"))

        def settle() -> None:
            # after the load: an interrupted run finds the rows still held, and loads them again
            entries = ledger_entries(waiting, None, run)
            if freed is not None:
                done = freed.withColumns({c: F.lit(None).cast("string") for c in ("waits_for", "waits_member")})
                still = waiting.select(*keys)
                entries = ledger_entries(waiting, done.join(still, list(keys), "left_anti"), run)
            entries = entries.withColumn("part", F.pmod(F.xxhash64(*keys), F.lit(8)).cast("int"))
            wh.merge(f"{name}_pending", entries, "part", lambda old, rows: record(old, rows, [*keys, "part"]), run)
            if freed is not None:
                freed.unpersist()

        return ready, settle

    dim("dim_exchange", st.seed_exchanges(spark), "exchange_name")
    dim("dim_chain", st.seed_chains(spark), "chain_name")

    candle_keys = ["symbol", "interval", "open_time_ms"]
    candles = wh.fresh("candles", "star_candles", "staged_run", candle_keys).persist()
    assets, intervals = st.build_dim_asset(None, candles), st.build_dim_interval(None, candles)
    dim("dim_asset", assets, "symbol", {"base_asset": "keep_if_null", "quote_asset": "keep_if_null"})
    dim("dim_interval", intervals, "interval", {"interval_seconds": "keep_if_null"})
    dims = wh.need("dim_asset"), wh.need("dim_interval")
    ready, settle = quarantined(
        "fact_candle", "star_candles", candles, st.candle_lookups(*dims), lambda rows: st.split_candles(rows, *dims), candle_keys
    )
    loaded = st.load_fact_candle(None, ready, *dims, ["staged_run"])
    fact("fact_candle", loaded, day_of(F.timestamp_micros("open_time_key")), st.CANDLE_FACT_KEYS, {"trading_day": "keep_if_null"})
    settle()

    blocks = wh.fresh("blocks", "star_blocks", "staged_run", ["block_hash"]).persist()
    loaded = st.load_fact_block(None, blocks, ["staged_run", "block_hash"])
    by_number = range_of("block_number")
    kept = {"ingestion_ds": "keep_if_null"}
    # blocks are cut by number: a zone map says which slices a span of time needs
    fact("fact_block", loaded, by_number, ["chain_key", "block_number"], kept, "block_time_key")

    metric_keys = ["crypto_id", "recorded_at"]
    metrics = wh.fresh("metrics", "star_metrics", "staged_run", metric_keys).persist()
    cryptos = wh.need("cryptos")
    dim("dim_crypto", st.build_dim_crypto(None, cryptos, ["processed_at"]), "crypto_id")
    ready, settle = quarantined(
        "fact_snapshot", "star_metrics", metrics, st.snapshot_lookups(cryptos), lambda rows: st.split_snapshots(rows, cryptos), metric_keys
    )
    loaded = st.load_fact_snapshot(None, ready, cryptos)
    fact("fact_snapshot", loaded, day_of(F.timestamp_micros("time_key")), ["crypto_id", "time_key"])
    settle()

    times = st.build_dim_time(
        None,
        (candles, from_epoch_ms(F.col("open_time_ms"))),
        (candles, from_epoch_ms(F.col("close_time_ms"))),
        (blocks, from_epoch_s(F.col("timestamp_unix"))),
        (metrics, F.col("recorded_at")),
    )
    wh.merge(
        "dim_time",
        times.withColumn("slice", day_of(F.col("ts_utc"))),
        "slice",
        lambda target, batch: insert_if_absent(target, batch, ["time_key"], ["time_key"]),
        run,
    )
    for source, rows in (("star_candles", candles), ("star_blocks", blocks), ("star_metrics", metrics)):
        wh.advance(source, rows, "staged_run")
        rows.unpersist()


def load_star(wh: Warehouse, start: str | None = None, end: str | None = None) -> st.Star:
    """The star schema as stored; with a window, without the folders of candles and blocks that lie outside it.

    Candles are cut by day. Blocks are cut by number, and their zone map gives the numbers of the window. Snapshots stay
    whole: the last one before a window counts in it.
    """
    tables = {name: wh.need(name) for name in st.Star.__dataclass_fields__}
    if start is not None and end is not None:
        first, last = (dt.datetime.fromisoformat(t).replace(tzinfo=dt.timezone.utc) for t in (start, end))
        days = [(t - dt.datetime.fromtimestamp(0, dt.timezone.utc)).days for t in (first, last)]
        tables["fact_candle"] = tables["fact_candle"].where(F.col("slice").between(*days))
        zones = wh.read("fact_block_zones")
        if zones is not None:
            micros = [(t - dt.datetime.fromtimestamp(0, dt.timezone.utc)) // dt.timedelta(microseconds=1) for t in (first, last)]
            tables["fact_block"] = pruned(tables["fact_block"], zones, "slice", *micros)
    return st.Star(**tables)


def analyse(wh: Warehouse, now: str, sel: an.Selection | None = None, days: int = 30, top: int = 10) -> None:
    """The four analysis tables of a run; the run history only grows when enough buckets overlap."""
    sel = sel or an.Selection()
    start, end = an.lookback(dt.datetime.fromisoformat(now), days)
    star = load_star(wh, str(start), str(end))
    run = wh.begin("analyse")

    def store(name: str, rows: DataFrame, ts: Column, keys: Sequence[str]) -> None:
        rows = rows.withColumns({"computed_at": at(now), "slice": day_of(ts), "_o": F.lit(0)})
        wh.upsert(name, rows, "slice", keys, ["_o"], run)

    store("bucket_price_fee", an.bucket_price_fee(star, sel, start, end), F.col("hour_ts"), ["hour_ts"])
    store("top_assets", an.top_assets(star, top), F.col("snapshot_ts"), ["snapshot_ts", "crypto_id"])
    store("integrated_daily", an.integrated_daily(star, sel, start, end), F.col("trading_date"), ["trading_date"])
    buckets = wh.read("bucket_price_fee")
    if buckets is not None:
        append_rows(an.corr_run_summary(buckets, sel, start, end, now), wh.path("corr_runs"))
