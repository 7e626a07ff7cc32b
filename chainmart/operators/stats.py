"""Summary statistics that stay distributed."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

QUARTILES = (0.25, 0.5, 0.75)


#: buckets of a histogram; each pass narrows a searched interval by this factor at least
BUCKETS = 4096


@dataclass(frozen=True)
class _Interval:
    """Values of one measure among which some wanted ranks lie; ``before`` values of the measure are smaller."""

    measure: str
    lo: float
    hi: float
    before: int
    ranks: tuple[int, ...]

    def bucket(self, v: Column) -> Column:
        """Place of ``v`` in the interval, never falling as ``v`` grows: ``lo`` in the first bucket, ``hi`` in the last."""
        half = 0.5 if math.isinf(self.hi - self.lo) else 1.0
        lo, hi = self.lo * half, self.hi * half
        place = F.floor((v * F.lit(half) - F.lit(lo)) / F.lit(hi - lo) * F.lit(float(BUCKETS)))
        return F.least(place, F.lit(BUCKETS - 1)).cast("int")


def _narrowed(df: DataFrame, intervals: Sequence[_Interval]) -> list[_Interval]:
    """One pass: of every interval, the buckets that hold its ranks, with the least and greatest value found in them."""
    inside = [F.col(i.measure).between(i.lo, i.hi) for i in intervals]
    hits = [
        F.when(ok, F.struct(F.lit(at).alias("at"), i.bucket(F.col(i.measure)).alias("bucket"), F.col(i.measure).alias("v")))
        for at, (i, ok) in enumerate(zip(intervals, inside))
    ]
    # most rows lie in no interval after the first pass; the condition reaches the scan
    histogram = (
        df.where(reduce(Column.__or__, inside))
        .select(F.inline(F.array_compact(F.array(*hits))))
        .groupBy("at", "bucket")
        .agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    )
    # a window over at most BUCKETS rows, whatever the data
    running = Window.partitionBy("at").orderBy("bucket")
    upto = F.sum("n").over(running)
    wanted = F.create_map(*[x for at, i in enumerate(intervals) for x in (F.lit(at), F.lit([r - i.before for r in i.ranks]))])
    found = (
        histogram.withColumn("before", upto - F.col("n"))
        .withColumn("ranks", F.filter(wanted[F.col("at")], lambda r: (r >= F.col("before")) & (r < F.col("before") + F.col("n"))))
        .where(F.size("ranks") > 0)
    )
    return [
        _Interval(i.measure, r.lo, r.hi, i.before + r.before, tuple(i.before + x for x in r.ranks))
        for r in found.select("at", "before", "lo", "hi", "ranks").collect()
        for i in [intervals[r["at"]]]
    ]


def exact_quantiles(
    df: DataFrame,
    cols: Sequence[str],
    probs: Sequence[float] = QUARTILES,
    beside: Mapping[str, Callable[[Column], Column]] | None = None,
) -> DataFrame:
    """Exact linearly interpolated quantiles as ``(measure, p, n, value)``; runs its passes over ``df`` at once.

    ``beside`` names further aggregates of a column to carry along; they cost no pass of their own. A column without
    values has no rows. NaN is greater than everything, infinities are values like others.

    Histograms refined around the wanted ranks: the values between the least and the greatest are counted in equal
    buckets, combined on the map side; a bucket that holds a wanted rank becomes the next interval, from its least to
    its greatest value, until that is one value. An interval's ends never share a bucket, so every pass narrows it,
    and rows that are equal in any number end it. Evenly spread values take log(rows) / log(BUCKETS) passes. Nothing
    but buckets is shuffled and nothing but the intervals of the ranks comes to the driver. (``percentile`` would
    gather every distinct value of a column in one task instead.) Store ``df`` first if it is dear to compute.
    """
    df = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    finite = lambda c: F.when(~F.isnan(c) & (F.abs(c) < float("inf")), F.col(c))
    summary = df.agg(
        *[
            F.struct(
                F.count(c).alias("n"),
                F.count_if(F.col(c) == float("-inf")).alias("below"),
                F.count_if(F.col(c) == float("inf")).alias("above"),
                F.count(finite(c)).alias("finite"),
                F.min(finite(c)).alias("lo"),
                F.max(finite(c)).alias("hi"),
                F.struct(F.lit(0).alias("_"), *[agg(c).alias(name) for name, agg in (beside or {}).items()]).alias("more"),
            ).alias(c)
            for c in cols
        ]
    )
    total = summary.first()
    value_at: dict[tuple[str, int], float] = {}
    open_intervals = []
    for c in cols:
        t = total[c]
        places = [(t.n - 1) * float(p) for p in probs] if t.n else []
        ranks = sorted({r for place in places for r in (math.floor(place), math.ceil(place))})
        for r in ranks:
            if r < t.below:
                value_at[c, r] = float("-inf")
            elif r >= t.below + t.finite:
                value_at[c, r] = float("inf") if r < t.below + t.finite + t.above else float("nan")
        rest = tuple(r for r in ranks if (c, r) not in value_at)
        if rest:
            open_intervals.append(_Interval(c, t.lo, t.hi, t.below, rest))
    while open_intervals:
        for i in open_intervals:
            if i.lo == i.hi:
                value_at.update({(i.measure, r): i.lo for r in i.ranks})
        open_intervals = [i for i in open_intervals if i.lo != i.hi]
        if open_intervals:
            open_intervals = _narrowed(df, open_intervals)
    rows = []
    for c in cols:
        t = total[c]
        for p in probs if t.n else ():
            place = (t.n - 1) * float(p)
            low, high = value_at[c, math.floor(place)], value_at[c, math.ceil(place)]
            share = place - math.floor(place)
            value = low if share == 0 or low == high else low + (high - low) * share
            rows.append((c, float(p), t.n, value, *[t.more[name] for name in beside or {}]))
    types = summary.schema[cols[0]].dataType["more"].dataType
    more = [StructField(name, types[name].dataType) for name in beside or {}]
    fields = [StructField("measure", StringType()), StructField("p", DoubleType()), StructField("n", LongType())]
    return df.sparkSession.createDataFrame(rows, StructType([*fields, StructField("value", DoubleType()), *more]))


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles, one row per measure with values.

    Runs the passes of ``exact_quantiles`` at once.
    """
    plain = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    name = {p: f"p{round(p * 100)}" for p in QUARTILES}
    return (
        exact_quantiles(df, cols, QUARTILES, beside=plain)
        .groupBy("measure", F.col("n").alias("count"), *plain)
        .agg(*[F.max(F.when(F.col("p") == p, F.col("value"))).alias(name[p]) for p in QUARTILES])
        .select("measure", "count", "mean", "std", "min", *name.values(), "max")
    )


def regression_line(df: DataFrame, x: str, y: str, points: int = 100) -> DataFrame:
    """Least-squares line of ``y`` on ``x`` at evenly spaced x: ``(point, x, y, slope, intercept, n)``.

    Only pairs with both sides finite count; fewer than two give no rows, a
    constant ``x`` gives NULL for slope, intercept and y.
    """
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    xs, ys = F.col(x).cast("double"), F.col(y).cast("double")
    fit = (
        df.select(xs.alias("_x"), ys.alias("_y"))
        .where(finite(F.col("_x")) & finite(F.col("_y")))
        .agg(
            F.regr_slope("_y", "_x").alias("slope"),
            F.regr_intercept("_y", "_x").alias("intercept"),
            F.count("*").alias("n"),
            F.min("_x").alias("_lo"),
            F.max("_x").alias("_hi"),
        )
        .where("n >= 2")
    )
    at_point = F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("point") / F.lit(points - 1)
    return (
        fit.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
        .withColumn("x", at_point)
        .select(
            "point",
            "x",
            (F.col("slope") * F.col("x") + F.col("intercept")).alias("y"),
            "slope",
            "intercept",
            "n",
        )
    )
