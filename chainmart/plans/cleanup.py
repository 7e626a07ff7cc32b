"""Clean-up of consumed input: a manifest of the files that were read, and their removal once it names them."""

from __future__ import annotations

from itertools import islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.sinks import append_rows
from ..streaming.upsert import read_or_none

#: file names held by the driver at a time
AT_ONCE = 1000
OUTCOMES = "file_path string, run int, deleted boolean"


class FileManifest:
    """Below ``path``: the files each run has consumed, and what became of each attempt to delete them.

    A file is deleted only after a run that read it has been recorded, so record a run when its rows are published. An
    interrupted clean-up goes on with the files that have no successful deletion yet. One writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def record(self, rows: DataFrame, run: int, column: str = "file_path") -> None:
        """Note the files that ``rows`` came from, with their number of rows; rows without a file are not counted."""
        files = rows.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("file_path")).agg(F.count("*").alias("n_rows"))
        append_rows(files.withColumn("run", F.lit(run)), f"{self.path}/consumed")

    def consumed(self) -> DataFrame | None:
        """``file_path, n_rows, run``."""
        return read_or_none(self.spark, f"{self.path}/consumed")

    def pending(self) -> DataFrame:
        """Consumed files that are not deleted yet, each once."""
        consumed, outcomes = self.consumed(), read_or_none(self.spark, f"{self.path}/outcomes")
        if consumed is None:
            return self.spark.createDataFrame([], "file_path string")
        files = consumed.select("file_path").distinct()
        return files if outcomes is None else files.join(outcomes.where("deleted"), "file_path", "left_anti")

    def clean_up(self, run: int, delete: bool = False) -> DataFrame:
        """Delete pending files if asked to: one row ``run, attempted, deleted``; runs at once.

        Without ``delete`` all are counted as attempted and none as deleted. A file that is gone already counts as
        deleted; one that cannot be deleted stays pending and does not stop the others.
        """
        pending = self.pending()
        counts = {"attempted": 0, "deleted": 0}
        if not delete:
            counts["attempted"] = pending.count()
        else:
            files = (row["file_path"] for row in pending.toLocalIterator())
            while some := list(islice(files, AT_ONCE)):
                outcomes = [(f, run, self._delete(f)) for f in some]
                append_rows(self.spark.createDataFrame(outcomes, OUTCOMES), f"{self.path}/outcomes")
                counts["attempted"] += len(some)
                counts["deleted"] += sum(deleted for _, _, deleted in outcomes)
        return self.spark.range(1).select(
            F.lit(run).alias("run"), *[F.lit(n).cast("bigint").alias(name) for name, n in counts.items()]
        )

    def _delete(self, file: str) -> bool:
        """Whether the file is gone. Paths come from file scans, which write them as encoded URIs."""
        jvm = self.spark._jvm
        try:
            target = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
            system = target.getFileSystem(self.spark._jsc.hadoopConfiguration())
            return bool(system.delete(target, False)) or not system.exists(target)
        except Exception:  # a folder, no permission, an unknown file system: reported as not deleted
            return False
