"""Clean-up of input files that were consumed."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans.cleanup import FileManifest
from ..session import shared_dir
from . import base as b
from .base import query


@query(
    "cleanup_input_files",
    """
    WITH days AS (SELECT count(DISTINCT CAST(ts AS DATE)) AS n, count(*) AS n_rows FROM events WHERE event_type = 'click')
    SELECT 'kept' AS step, CAST(n AS BIGINT) AS attempted, 0 AS deleted, n_rows, CAST(n AS BIGINT) AS n_left FROM days
    UNION ALL SELECT 'deleted', n, n, n_rows, 0 FROM days
    UNION ALL SELECT 'again', 0, 0, n_rows, 0 FROM days
    """,
)
def cleanup_input_files(spark, sf_dir):
    """A file for each day is read and recorded; clean-up is off at first, then on, then finds nothing more."""
    source = shared_dir(spark, "consumed-input")
    clicks = b.table(spark, sf_dir, "events").where("event_type = 'click'")
    lines = clicks.select(F.to_json(F.struct("event_id", "value")).alias("value"), F.to_date("ts").alias("day"))
    lines.repartition("day").write.partitionBy("day").text(source)
    manifest = FileManifest(spark, shared_dir(spark, "manifest"))
    manifest.record(spark.read.text(source).select(F.col("_metadata.file_path").alias("file_path")), 1)
    steps = []
    for run, (step, delete) in enumerate((("kept", False), ("deleted", True), ("again", True)), 1):
        done = manifest.clean_up(run, delete)
        rows = F.lit(manifest.consumed().agg(F.sum("n_rows")).first()[0])
        left = F.lit(manifest.pending().count())
        steps.append(
            done.select(F.lit(step).alias("step"), "attempted", "deleted", rows.cast("bigint").alias("n_rows"), left.cast("bigint").alias("n_left"))
        )
    return steps[0].unionByName(steps[1]).unionByName(steps[2])
