"""Facts that come before their dimension members, and documents that do not parse."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import at
from ..operators.merge import merge_upsert
from ..operators.quarantine import due, ledger_entries, record
from ..plans import star as st
from ..session import shared_dir
from ..sources.sinks import raw_documents, rejected_documents
from ..streaming.upsert import merge_into, read_or_none
from . import base as b
from .base import CRYPTO, NOW, SNAPSHOT, query

FACT_KEYS = ["crypto_id", "time_key"]


def _loads(spark, sf_dir):
    """Snapshots in three loads, of which the first knows no asset, the second those of customers with a positive
    balance, the third all: folders of the facts and of the ledger."""
    facts, ledger = shared_dir(spark, "quarantine-facts"), shared_dir(spark, "quarantine-ledger")
    snapshots, known = b.snapshots(spark, sf_dir), b.cryptos(spark, sf_dir)
    balance = b.table(spark, sf_dir, "customer").select((F.col("c_custkey") + 1).alias("crypto_id"), "c_acctbal")
    solvent = known.join(balance.where("c_acctbal > 0"), "crypto_id", "left_semi")
    part = lambda c: F.pmod(F.xxhash64(c), F.lit(4)).cast("int").alias("part")

    def newest(old, new):
        rows = new if old is None else old.unionByName(new.select(*old.columns))
        return merge_upsert(None, rows.withColumn("_o", F.col("staged_metric_id")), [*FACT_KEYS, "part"], ["_o"])

    for run, cryptos in enumerate((known.limit(0), solvent, known), 1):
        new = snapshots.where(F.col("metric_id") % 3 == run - 1)
        before = read_or_none(spark, ledger)
        freed = due(before, st.snapshot_lookups(cryptos))
        rows = new if freed is None else new.unionByName(freed.select(*new.columns))
        ready, waiting, _ = st.split_snapshots(rows, cryptos)
        loaded = st.load_fact_snapshot(None, ready, cryptos).withColumn("part", part("crypto_id"))
        merge_into(facts, "part", newest)(loaded, run)
        if freed is not None:
            done = freed.select(*new.columns).withColumns({c: F.lit(None).cast("string") for c in ("waits_for", "waits_member")})
            freed = done.join(waiting.select("metric_id"), "metric_id", "left_anti")
        entries = ledger_entries(waiting, freed, run).withColumn("part", part("metric_id"))
        merge_into(ledger, "part", lambda old, new: record(old, new, ["metric_id", "part"]))(entries, run)
    return facts, ledger


@query(
    "quarantine_replay",
    f"""
    WITH {SNAPSHOT}, {CRYPTO}
    SELECT crypto_id, epoch_us(recorded_at) AS time_key, metric_id AS staged_metric_id, price_usd
    FROM v_snapshot JOIN v_crypto USING (crypto_id)
    QUALIFY row_number() OVER (PARTITION BY crypto_id, recorded_at ORDER BY metric_id DESC) = 1
    """,
)
def quarantine_replay(spark, sf_dir):
    """Facts loaded before their assets are known: all are there once the assets have come, as if loaded at once."""
    facts, _ = _loads(spark, sf_dir)
    return spark.read.parquet(facts).select("crypto_id", "time_key", "staged_metric_id", "price_usd")


@query(
    "quarantine_ledger",
    f"""
    WITH {SNAPSHOT}, known AS (
      SELECT c_custkey + 1 AS crypto_id, CASE WHEN c_acctbal > 0 THEN 2 ELSE 3 END AS since FROM customer),
    rows AS (
      SELECT metric_id, v_snapshot.crypto_id, metric_id % 3 + 1 AS run, since
      FROM v_snapshot LEFT JOIN known ON known.crypto_id = v_snapshot.crypto_id)
    SELECT metric_id, CASE WHEN since IS NULL THEN 'crypto' END AS waits_for,
           CASE WHEN since IS NULL THEN CAST(crypto_id AS VARCHAR) END AS waits_member,
           run AS since_run, since AS released_run
    FROM rows WHERE since IS NULL OR since > run
    """,
)
def quarantine_ledger(spark, sf_dir):
    """Every row that has waited: since which run, and which run loaded it; the rest wait still."""
    _, ledger = _loads(spark, sf_dir)
    ledger = spark.read.parquet(ledger)
    return ledger.select(
        "metric_id", "waits_for", "waits_member", F.col("since_run").cast("long"), F.col("released_run").cast("long")
    )


@query(
    "fact_rejects",
    """
    SELECT event_id, CASE event_id % 7 WHEN 1 THEN 'blank_symbol' WHEN 2 THEN 'blank_interval' WHEN 3 THEN 'no_open_time'
                     WHEN 4 THEN 'no_close_time' END AS reject_reason
    FROM events WHERE event_type = 'view' AND event_id % 7 BETWEEN 1 AND 4
    """,
)
def fact_rejects(spark, sf_dir):
    """Candles without a usable key are reported with the reason."""
    c, i = b.candles(spark, sf_dir), F.col("event_id") % 7
    spoiled = c.withColumns(
        {
            "symbol": F.when(i == 1, " ").otherwise(F.col("symbol")),
            "interval": F.when(i != 2, F.col("interval")),
            "open_time_ms": F.when(i != 3, F.col("open_time_ms")),
            "close_time_ms": F.when(i != 4, F.col("close_time_ms")),
        }
    )
    _, _, rejects = st.split_candles(spoiled, st.build_dim_asset(None, c), st.build_dim_interval(None, c))
    return rejects.select("event_id", "reject_reason")


@query(
    "document_rejects",
    """
    SELECT 'f' || event_id AS source_file, event_id % 4 IN (1, 2) AS landed_at_once,
           event_id % 4 IN (1, 2, 3) AS landed_in_the_end FROM events WHERE event_type = 'error'
    """,
)
def document_rejects(spark, sf_dir):
    """Documents that do not parse are held whole and land once their texts have been mended (here: a byte order mark
    and a missing brace); one that is still broken stays."""
    i = F.col("event_id")
    good = F.concat(F.lit('{"data":['), i.cast("string"), F.lit("]}"))
    value = F.when(i % 4 == 3, F.concat(F.lit("﻿"), F.rtrim(good, F.lit("}")))).when(i % 4 == 0, "{{").otherwise(good)
    files = b.table(spark, sf_dir, "events").where("event_type = 'error'")
    docs = files.select(F.concat(F.lit("f"), i.cast("string")).alias("file_path"), value.alias("value"))
    docs = docs.withColumn("doc", F.try_parse_json("value"))
    landed, rejects = raw_documents(docs, received_at=at(NOW)), rejected_documents(docs, at(NOW))
    mended = F.concat(F.ltrim(F.col("value"), F.lit("﻿")), F.lit("}"))
    again = rejects.select(F.col("source_file").alias("file_path"), F.try_parse_json(mended).alias("doc"))
    late = raw_documents(again, received_at=at(NOW))
    seen = landed.select("source_file", F.lit(1).alias("at")).unionByName(late.select("source_file", F.lit(2).alias("at")))
    every = docs.select(F.col("file_path").alias("source_file")).join(seen.groupBy("source_file").agg(F.min("at").alias("at")), "source_file", "left")
    return every.select(
        "source_file",
        F.coalesce(F.col("at") == 1, F.lit(False)).alias("landed_at_once"),
        F.col("at").isNotNull().alias("landed_in_the_end"),
    )
