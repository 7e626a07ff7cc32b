"""Backward as-of join without a nested loop and without one task per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def asof_join(
    left: DataFrame,
    right: DataFrame,
    ts: str,
    right_ts: str,
    payload: Sequence[str],
    by: Sequence[str] = (),
    tie: str | None = None,
    slot: str = "hour",
    left_is_unique: bool = False,
) -> DataFrame:
    """Attach to each left row the ``payload`` of the latest right row at or before ``ts``.

    The payload travels as a struct, so a NULL inside the latest right row stays
    NULL instead of falling back to an older one; without a match all are NULL.
    Right rows at one instant are settled by the highest ``tie``.

    How the work is spread: right rows are first reduced to one per ``(by, right_ts)``
    with a map-side combine, and so is a left side that may repeat ``(by, ts)``.
    Time is cut into ``slot`` pieces (any ``date_trunc`` unit) and each ``(by, slot)``
    is filled on its own; what it inherits from earlier slots comes from a second
    pass over one row per slot. A key holding a third of the data still spreads over
    all its slots, and the largest group ordered as a whole is one key's slots, which
    time bounds. With ``left_is_unique`` (no repeated ``(by, ts)``) left rows ride
    along, which saves joining them back.
    """
    by = list(by)
    rest = [c for c in left.columns if c not in (*by, ts)]
    t, slot_of = F.col("_t"), F.date_trunc(slot, F.col("_t")).alias("_slot")
    points = left.select(*by, F.col(ts).alias("_t"), *(rest if left_is_unique else []))
    if not left_is_unique:
        points = points.where(t.isNotNull()).distinct()
    value = F.struct(*[F.col(c) for c in payload])
    quotes = (
        right.dropna(subset=[*by, right_ts])
        .groupBy(*by, F.col(right_ts).alias("_t"))
        .agg((F.max_by(value, F.col(tie)) if tie else F.max(value)).alias("_quote"))
    )
    row = F.struct(*rest) if left_is_unique and rest else F.struct(F.lit(True).alias("_"))
    asked = points.select(*by, "_t", F.lit(1).alias("_side"), row.alias("_row"))
    known = quotes.select(*by, "_t", F.lit(0).alias("_side"), "_quote")
    both = known.unionByName(asked, allowMissingColumns=True).select("*", slot_of)

    in_slot = Window.partitionBy(*by, "_slot").orderBy("_t", "_side")
    filled = both.withColumn(
        "_found",
        F.last("_quote", ignorenulls=True).over(
            in_slot.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        ),
    )
    # Counting _row keeps the columns of both branches alike, so the inputs are
    # read and shuffled once and the second branch reuses that exchange.
    closing = filled.groupBy(*by, "_slot").agg(
        F.max_by("_found", F.struct("_t", "_side")).alias("_closing"), F.count("_row").alias("_n")
    )
    earlier = Window.partitionBy(*by).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    carried = closing.select(
        *by, "_slot", F.last("_closing", ignorenulls=True).over(earlier).alias("_carry"), "_n"
    ).where("_n > 0 and _carry is not null")
    answers = (
        filled.where("_side = 1")
        .join(carried.drop("_n"), [*by, "_slot"], "left")
        .select(*by, t.alias(ts), "_row", F.coalesce("_found", "_carry").alias("_quote"))
    )
    if left_is_unique:
        joined = answers.select(*by, ts, "_quote", *[F.col(f"_row.{c}").alias(c) for c in rest])
    else:
        joined = left.join(answers, [*by, ts], "left")
    return joined.select(*left.columns, *[F.col(f"_quote.{c}").alias(c) for c in payload])
