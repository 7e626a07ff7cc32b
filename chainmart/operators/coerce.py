"""Best-effort typing of text columns that hold points in time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Column names (or endings) that announce a point in time.
TIME_SUFFIXES = ("_ts", "_at")
TIME_NAMES = ("hour_ts", "run_ts", "window_start", "window_end", "snapshot_ts", "trading_date")


def coerce_datetime_columns(df: DataFrame) -> DataFrame:
    """Turn time-named text columns into timestamps where at least one value parses.

    Values that do not parse become NULL; a column without any parsable value
    stays text. The schema depends on the data, so this runs one aggregate (a
    single row comes back) before returning.
    """
    candidates = [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, StringType)
        and (f.name in TIME_NAMES or f.name.endswith(TIME_SUFFIXES))
    ]
    if not candidates:
        return df
    parsed = {c: F.col(c).try_cast("timestamp_ntz") for c in candidates}
    hits = df.agg(*[F.count(parsed[c]).alias(c) for c in candidates]).first()
    return df.withColumns({c: parsed[c] for c in candidates if hits[c] > 0})
