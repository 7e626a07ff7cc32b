"""Raw files to landing tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.merge import dedupe, merge_documents, merge_upsert
from ..sources.parsers import CANDLE_FIELDS, CANDLE_KEYS, parse_blocks, parse_candles
from ..sources.scans import FILE_ORDER

LANDING_STAMPS = ("ingested_at", "ingestion_ds", "source_file")


def land_candles(
    target: DataFrame | None, lines: DataFrame, ingestion_ds: str | Column, now: Column
) -> tuple[DataFrame, DataFrame]:
    """``(new landing state, rejects)``; documents merge field by field per candle key."""
    parsed = parse_candles(lines, ingestion_ds, now)
    fields = [f for f in (*CANDLE_FIELDS, "source_ingested_at") if f not in CANDLE_KEYS]
    accepted = parsed.where(F.col("reject_reason").isNull()).withColumn(
        # the stamp is written with every document, so it counts as carried
        "fields_present",
        F.array_append("fields_present", F.lit("updated_at")),
    )
    state = merge_documents(
        target, accepted, CANDLE_KEYS, FILE_ORDER, [*fields, "updated_at"], LANDING_STAMPS, payload="extra"
    )
    return state, parsed.where(F.col("reject_reason").isNotNull())


def land_blocks(
    target: DataFrame | None, lines: DataFrame, ingestion_ds: str | Column, now: Column
) -> tuple[DataFrame, DataFrame]:
    """``(new landing state, rejects)``; the last document per hash wins, first stamps stay."""
    parsed = parse_blocks(lines, ingestion_ds, now)
    accepted = parsed.where(F.col("reject_reason").isNull()).drop("reject_reason")
    state = merge_upsert(
        target,
        accepted,
        ["hash"],
        FILE_ORDER,
        {stamp: "set_on_insert" for stamp in LANDING_STAMPS},
    )
    return state, parsed.where(F.col("reject_reason").isNotNull())


def last_documents(parsed: DataFrame, keys: tuple[str, ...] = CANDLE_KEYS) -> DataFrame:
    """Whole documents, the last one per key in order of arrival."""
    return dedupe(parsed, keys, FILE_ORDER, keep="last")
