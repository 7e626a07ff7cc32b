"""Streams over files. The checkpoint remembers what was read, so no mark is kept by hand."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery


def run_once(writer: DataStreamWriter, checkpoint: str, **start: str) -> StreamingQuery:
    """Process everything available in as many batches as the source limits ask for, then stop."""
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start(**start)
    query.awaitTermination()
    return query


def land_stream(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append the rows of a file stream to Parquet; each file lands exactly once."""
    return run_once(rows.writeStream.format("parquet").outputMode("append"), checkpoint, path=path)


def tumbling_averages(
    rows: DataFrame, ts: str, value: Column, minutes: int, name: str = "avg_value"
) -> DataFrame:
    """Averages per tumbling window, ``(hour_ts, name)``. Write it in update mode and upsert by
    ``hour_ts``: a late row, however late, corrects its window.

    No watermark, which would drop rows without a trace: the state is one sum and count per window, so it grows with
    the time covered and not with the rows. ``minutes`` must divide 60, since stream windows are aligned to the epoch.
    """
    if 60 % minutes:
        raise ValueError("stream windows need a length that divides the hour")
    return (
        rows.withColumn("_ts", F.col(ts).cast("timestamp"))
        .groupBy(F.window("_ts", f"{minutes} minutes"))
        .agg(F.avg(value).alias(name))
        .select(F.col("window.start").cast("timestamp_ntz").alias("hour_ts"), name)
    )


def dedupe_stream(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The first row per key, however late it or its repetition arrives.

    No watermark, so no row is dropped for its age. The state holds every key seen: for many keys set
    ``spark.sql.streaming.stateStore.providerClass`` to the RocksDB provider, which keeps them on disk. ``dedupe_into`` keeps
    no state and compares with the table that it writes.
    """
    return rows.dropDuplicates(list(keys))
