"""High-water marks, cursors and scans above them."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import cursor_key


def incremental_scan(df: DataFrame, marks: Mapping[str, Any], any_of: bool = False) -> DataFrame:
    """Rows above the mark of every column (or of any column).

    A mark of None means nothing was read yet. Plain comparisons, so they reach
    the Parquet scan; no sort, since later steps order by key.
    """
    tests: list[Column] = [F.col(c) > F.lit(m) for c, m in marks.items() if m is not None]
    if not tests or (any_of and len(tests) < len(marks)):
        return df
    return df.where(reduce(Column.__or__ if any_of else Column.__and__, tests))


def high_water_mark(df: DataFrame, mark: str, valid: Column | None = None, previous: Any = None) -> DataFrame:
    """New mark as one row ``(mark, n_rows)``; the previous mark stands when nothing counted.

    With ``valid`` only rows meeting it advance the mark.
    """
    counted = F.lit(True) if valid is None else F.coalesce(valid, F.lit(False))
    best = F.max(F.when(counted, F.col(mark)))
    if previous is not None:
        # greatest skips NULLs: the mark never moves backwards and survives an empty batch
        best = F.greatest(best, F.lit(previous))
    return df.agg(best.alias("mark"), F.count_if(counted).alias("n_rows"))


def candle_cursors(candles: DataFrame, closed_before_ms: Column | None = None) -> DataFrame:
    """Per (symbol, interval): cursor name, last close and the next start (one past it)."""
    if closed_before_ms is not None:
        candles = candles.where(F.col("close_time_ms") <= closed_before_ms)
    return (
        candles.groupBy("symbol", "interval")
        .agg(F.max("close_time_ms").alias("last_close_ms"))
        .select(
            cursor_key(F.col("symbol"), F.col("interval")).alias("cursor"),
            "symbol",
            "interval",
            "last_close_ms",
            (F.col("last_close_ms") + 1).alias("next_start_ms"),
        )
    )
