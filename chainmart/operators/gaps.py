"""Reports of what is missing: minutes on a time line, numbers in a sequence."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import at


def missing_minutes(
    df: DataFrame,
    ts: str,
    start: Column | dt.datetime | str,
    end: Column | dt.datetime | str,
    max_minutes: int | None = None,
) -> DataFrame:
    """Whole minutes of ``[start, end]`` without a row, as ``minute_ts``.

    ``max_minutes`` is the catch-up limit per run: only that many minutes from
    ``start`` on are expected at all. ``start`` and ``end`` may be scalar
    subqueries, for instance one minute after the last checkpoint.
    """
    first = F.date_trunc("minute", at(start)).cast("timestamp_ntz")
    last = F.date_trunc("minute", at(end)).cast("timestamp_ntz")
    if max_minutes is not None:
        last = F.least(last, first + F.make_dt_interval(mins=F.lit(max_minutes - 1)))
    minute, hour = F.expr("interval 1 minute"), F.expr("interval 1 hour")
    bounds = df.sparkSession.range(1).select(first.alias("_first"), last.alias("_last"))
    # hours first, minutes second: no single row ever holds the whole spine
    # (greatest: an empty range must not reach sequence, which is folded before the filter runs)
    hours = bounds.where("_first <= _last").select(
        "_last", F.explode(F.sequence("_first", F.greatest("_first", "_last"), hour)).alias("_hour")
    )
    hour_end = F.greatest("_hour", F.least("_last", F.col("_hour") + F.expr("interval 59 minutes")))
    spine = hours.select(F.explode(F.sequence("_hour", hour_end, minute)).alias("minute_ts"))
    # compared on the bare column, so the range reaches the scan
    present = df.where((F.col(ts) >= first) & (F.col(ts) < last + minute)).select(
        F.date_trunc("minute", ts).cast("timestamp_ntz").alias("minute_ts")
    )
    return spine.join(present.distinct(), "minute_ts", "left_anti")


#: each level of ranges is so many times wider than the one below; from the last width on, one range holds what is left
LEVEL, WIDEST = 1 << 20, 1 << 59


def number_gaps(
    df: DataFrame, col: str, width: int, first: Column | int | None = None, last: Column | int | None = None
) -> DataFrame:
    """Gaps between consecutive numbers as ``(gap_start, gap_end)``; with bounds, all that ``[first, last]`` lacks.

    Numbers are cut into ranges of ``width``. A range finds the gaps inside it and hands up its least and greatest
    number alone; ranges are merged level by level. So however sparse the numbers are, a step orders ``width`` numbers
    or ``LEVEL`` ranges at most, the last one what is left of all 64 bits, 2**24 ranges at most for the default width.
    ``first`` and ``last`` (both or none) may be scalar subqueries; where first is above last nothing is missing.
    """
    n = F.col("_n")
    present = df.select(F.col(col).cast("bigint").alias("_n")).where(n.isNotNull())
    if first is not None:
        first, last = (F.lit(v).cast("bigint") if isinstance(v, int) else v.cast("bigint") for v in (first, last))
        # one number before and one behind the bounds: what lacks at either end is a gap like any other
        ends = df.sparkSession.range(1).select(first.alias("_first"), last.alias("_last")).where("_first <= _last")
        ends = ends.select(F.explode(F.array(F.col("_first") - 1, F.col("_last") + 1)).alias("_n"))
        present = present.where((n >= first) & (n <= last)).unionByName(ends)
    edges = present.distinct().select(n.alias("_lo"), n.alias("_hi"))
    gaps = []
    while True:
        final = width >= WIDEST
        place = F.lit(0) if final else F.expr(f"(_lo - pmod(_lo, {width}L)) div {width}L")
        ranged = edges.withColumn("_range", place)
        following = F.lead("_lo").over(Window.partitionBy("_range").orderBy("_lo"))
        gaps.append(ranged.select(F.col("_hi").alias("_prev"), following.alias("_next")))
        if final:
            break
        edges = ranged.groupBy("_range").agg(F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi")).drop("_range")
        width *= LEVEL
    return (
        reduce(DataFrame.unionByName, gaps)
        .where("_next > _prev + 1")
        .select((F.col("_prev") + 1).alias("gap_start"), (F.col("_next") - 1).alias("gap_end"))
    )


def to_fetch(cursor: Column, head: Column, first_run: int) -> tuple[Column, Column]:
    """Bounds of the numbers to fetch: from one past the cursor to the head; without a cursor the last ``first_run``."""
    head = head.cast("bigint")
    start = F.greatest(F.lit(0).cast("bigint"), head - (first_run - 1))
    return F.coalesce(cursor.cast("bigint") + 1, start), head


def missing_numbers(
    df: DataFrame, col: str, width: int = 1_000_000, first: Column | int | None = None, last: Column | int | None = None
) -> DataFrame:
    """Every number absent between the smallest and the largest one, or of ``[first, last]``, as ``col``."""
    lo, hi = F.col("gap_start"), F.col("gap_end")
    chunk = 10_000
    pieces = number_gaps(df, col, width, first, last).select(
        hi.alias("_hi"), F.explode(F.sequence(lo, hi, F.lit(chunk).cast("bigint"))).alias("_lo")
    )
    return pieces.select(
        F.explode(
            F.sequence("_lo", F.least("_hi", F.col("_lo") + (chunk - 1)), F.lit(1).cast("bigint"))
        ).alias(col)
    )
