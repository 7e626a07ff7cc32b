"""Merging a batch into a partitioned Parquet table, from a stream or from a job."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField

from ..operators.merge import dedupe, merge_upsert
from ..sources.sinks import write_merged

#: partitions whose folders are listed by themselves; more are found by listing the table
FEW = 32

Merge = Callable[[DataFrame | None, DataFrame], DataFrame]


def read_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """The Parquet table, or None while it does not exist."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _touched_or_none(spark: SparkSession, path: str, partition: StructField, values: Sequence[str]) -> DataFrame | None:
    """The table, of which a few partitions are to be read, or None while it does not exist.

    Only the folders of these are listed (of one other, for the columns, while there are none), so that a merge into a
    table of many partitions costs no more than into one of few. Where they alone do not tell the type that the batch
    has for their column, all folders are listed.
    """
    if len(values) <= FEW and _exists(spark, path):
        name = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
        folders = [f"{path}/{name(partition.name, v)}" for v in values]
        folders = [f for f in folders if _exists(spark, f)] or _any_partition(spark, path)
        if folders:
            rows = spark.read.option("basePath", path).parquet(*folders)
            if rows.schema[partition.name].dataType == partition.dataType:
                return rows
    return read_or_none(spark, path)


def _any_partition(spark: SparkSession, path: str) -> list[str]:
    """One folder of a partition, if there is any."""
    table = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = table.getFileSystem(spark._jsc.hadoopConfiguration()).listStatusIterator(table)
    while found.hasNext():
        folder = found.next()
        if folder.isDirectory() and "=" in folder.getPath().getName():
            return [folder.getPath().toString()]
    return []


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system holds it; nothing happens if there is none."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def _exists(spark: SparkSession, path: str) -> bool:
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()).exists(found)


def _mark(spark: SparkSession, path: str) -> None:
    """An empty file, there or not at any moment."""
    mark = spark._jvm.org.apache.hadoop.fs.Path(path)
    mark.getFileSystem(spark._jsc.hadoopConfiguration()).create(mark, True).close()


def _move_partitions(spark: SparkSession, staged: str, path: str) -> bool:
    """Replace the partitions of ``path`` whose folders lie below ``staged`` by these; False if there is no folder.

    Old files go first, then each new one is moved by itself. Files of one write share the id in their names, so a
    replacement that was interrupted is taken up where it stopped: what has been moved is not taken for old.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(staged).getFileSystem(spark._jsc.hadoopConfiguration())
    folders = [f for f in fs.listStatus(hadoop.Path(staged)) if f.isDirectory() and "=" in f.getPath().getName()]
    for folder in folders:
        new = [f.getPath() for f in fs.listStatus(folder.getPath())]
        written = {_write_id(f.getName()) for f in new}
        into = hadoop.Path(path, folder.getPath().getName())
        fs.mkdirs(into)
        if new:
            for old in fs.listStatus(into):
                if _write_id(old.getPath().getName()) not in written:
                    fs.delete(old.getPath(), True)
        for file in new:
            place = hadoop.Path(into, file.getName())
            # a copy that was cut off, on a file system that moves by copying
            fs.delete(place, False)
            if not fs.rename(file, place):
                raise OSError(f"{file} could not be moved to {place}")
    return bool(folders)


def _write_id(name: str) -> str:
    """What a file's name says of the write that made it: ``part-<task>-<id>``, the id having 36 characters."""
    return name.split("-", 2)[-1][:36]


def _tasks_follow_rows(spark: SparkSession) -> bool:
    """Whether Spark puts small tasks together; it does not in the session of a stateful stream."""
    needed = ("spark.sql.adaptive.enabled", "spark.sql.adaptive.coalescePartitions.enabled")
    return all(spark.conf.get(c).lower() == "true" for c in needed)


def _out_of_files(batch: DataFrame) -> bool:
    """Whether a batch of a stream comes out of its files row by row, without a shuffle, a state or Python on the way."""
    plan = batch._jdf.queryExecution()
    if plan.analyzed().nodeName() != "LogicalRDD":
        return False
    steps = set(re.findall(r"\w+RDD", plan.toRdd().toDebugString()))
    return "FileScanRDD" in steps and steps <= {"FileScanRDD", "MapPartitionsRDD", "SQLExecutionRDD"}


def log_path(path: str) -> str:
    """Folder of a table's change log."""
    return f"{path.rstrip('/')}_changes"


def merge_into(
    path: str, partition_by: str, merge: Merge, written_by: str | None = None, run: int | None = None, zone: str | None = None
) -> Callable[[DataFrame, int | str], None]:
    """A ``foreachBatch`` function replacing the partitions a batch touches by ``merge(target, batch)``.

    The partition must follow from the key and not be NULL. Only touched partitions are read
    and rewritten. The merged rows are first written aside, in folders of their partitions, and marked complete, then
    their files are moved into the table, then the mark is removed: a replacement that was interrupted is published
    before anything else is merged, so it never loses a partition. Batch ids play no part, so a new checkpoint may begin
    at 0 again. A batch repeated after a failure is merged once more, which must change nothing:
    ``merge`` has to give the same table for the same batch applied twice. One writer per table.

    With ``written_by``, the column that holds the number of the run that wrote a row, the rows that this ``run`` wrote
    are kept in the change log as well, in a folder of the run (see ``changes``). With ``zone``, the least and the
    greatest value of that column are kept for each partition (see ``zones``).
    """
    aside = f"{path.rstrip('/')}_staged"

    def publish(spark: SparkSession) -> None:
        if zone is not None and (rows := read_or_none(spark, f"{aside}/rows")) is not None:
            # before the files go; an interrupted run finds the spans of those that have gone in place
            spans = rows.groupBy(partition_by).agg(
                F.min(zone).alias("least"), F.max(zone).alias("greatest"), F.count("*").alias("n_rows")
            )
            write_merged(spans, f"{path.rstrip('/')}_zones", partition_by)
        if not _move_partitions(spark, f"{aside}/rows", path):
            # rows that were written aside without folders
            rows = read_or_none(spark, f"{aside}/rows")
            if rows is not None:
                write_merged(rows, path, partition_by)
        # the mark goes first: rows without it are never published
        remove(spark, f"{aside}/complete")
        remove(spark, aside)

    def merge_batch(batch: DataFrame, batch_id: int | str) -> None:
        spark = batch.sparkSession
        if _exists(spark, f"{aside}/complete"):
            publish(spark)
        # used twice below, and the batch may come out of a stateful plan; out of files it is sooner read again than kept
        kept = not _out_of_files(batch)
        if kept:
            batch = batch.persist()
        # values of the partition column, and as they stand in the names of folders
        touched = batch.select(partition_by, F.col(partition_by).cast("string").alias("_name")).distinct().collect()
        if not touched:
            if kept:
                batch.unpersist()
            return
        target = _touched_or_none(spark, path, batch.schema[partition_by], [r[1] for r in touched])
        if target is not None:
            # values of the partition column only, so the scan prunes by them
            target = target.where(F.col(partition_by).isin([r[0] for r in touched]))
        merged = merge(target, batch)
        # a single partition has a file for each task of its merge, where the number of tasks follows the rows
        ready = merged if len(touched) == 1 and _tasks_follow_rows(spark) else merged.hint("rebalance", partition_by)
        # all that an interrupted merge left there goes, whatever the session says of partitions
        whole = ready.write.mode("overwrite").option("partitionOverwriteMode", "static")
        whole.partitionBy(partition_by).parquet(f"{aside}/rows")
        if kept:
            batch.unpersist()
        if written_by is not None:
            # before the mark, so that no published row lacks in the log; a repeated batch replaces its folder
            new = spark.read.schema(merged.schema).parquet(f"{aside}/rows").where(F.col(written_by) == run)
            new.write.mode("overwrite").parquet(f"{log_path(path)}/run={run}/batch={batch_id}")
        _mark(spark, f"{aside}/complete")
        publish(spark)

    return merge_batch


def changes(spark: SparkSession, path: str, above: int, keys: Sequence[str]) -> DataFrame | None:
    """Rows of a table that runs ``above`` a mark wrote, the last version of each key; None without a log.

    Folders of runs at or below the mark are not opened.
    """
    log = read_or_none(spark, log_path(path))
    if log is None:
        return None
    return dedupe(log.where(F.col("run") > above), keys, ["run", "batch"]).drop("run", "batch")


def compact_changes(spark: SparkSession, path: str, upto: int, keys: Sequence[str]) -> None:
    """Put the log's runs up to ``upto`` into one folder, the last version of each key.

    Interrupted, it leaves rows in two folders, of which readers take one. A reader below ``upto`` reads the compacted
    rows whole, so compact up to the least mark.
    """
    log = read_or_none(spark, log_path(path))
    old = [] if log is None else [r[0] for r in log.select("run").where(F.col("run") <= upto).distinct().collect()]
    if len(old) < 2:
        return
    into = f"{log_path(path)}/run={max(old)}"
    aside = f"{path.rstrip('/')}_compacted"
    rows = dedupe(log.where(F.col("run") <= upto), keys, ["run", "batch"]).drop("run", "batch")
    rows.write.mode("overwrite").parquet(aside)
    batches = [r[0] for r in log.where(F.col("run") == max(old)).select("batch").distinct().collect()]
    compacted = max(batches) + 1
    spark.read.schema(rows.schema).parquet(aside).write.mode("overwrite").parquet(f"{into}/batch={compacted}")
    for b in batches:
        remove(spark, f"{into}/batch={b}")
    for r in old:
        if r != max(old):
            remove(spark, f"{log_path(path)}/run={r}")
    remove(spark, aside)


def pruned(table: DataFrame, zones: DataFrame, partition_by: str, start, end) -> DataFrame:
    """``table`` without the partitions whose zone misses ``[start, end)``.

    The zone map has one row for each partition; neighbouring partitions become one range, so the condition stays
    short, and it reaches the scan as a filter of partitions.
    """
    hit = zones.where((F.col("greatest") >= F.lit(start)) & (F.col("least") < F.lit(end))).select(partition_by)
    ranges: list[list[int]] = []
    for (p,) in sorted(hit.collect()):
        if ranges and p <= ranges[-1][1] + 1:
            ranges[-1][1] = p
        else:
            ranges.append([p, p])
    inside = [F.col(partition_by).between(a, b) for a, b in ranges]
    return table.where(reduce(Column.__or__, inside) if inside else F.lit(False))


def upsert_into(
    path: str,
    keys: Sequence[str],
    order: Sequence[str],
    partition_by: str,
    policies: Mapping[str, str] | None = None,
) -> Callable[[DataFrame, int | str], None]:
    """``merge_into`` with ``merge_upsert``; columns of ``order`` are kept in the table."""

    def merge(target: DataFrame | None, batch: DataFrame) -> DataFrame:
        if "row_id" in order:
            batch = batch.withColumn("row_id", F.monotonically_increasing_id())
        # columns of an empty table are all merged, those of the order as well
        target = batch.limit(0) if target is None else target.select([c for c in batch.columns if c in target.columns])
        kept = dict.fromkeys([*target.columns, *order])
        # the partition follows from the key: it changes no order, and tells that all columns may take part in it
        by = [*dict.fromkeys([*order, partition_by])]
        return merge_upsert(target, batch.select(*kept), keys, by, policies)

    return merge_into(path, partition_by, merge)


def dedupe_into(
    path: str, keys: Sequence[str], order: Sequence[str], source: str
) -> Callable[[DataFrame, int | str], None]:
    """A ``foreachBatch`` function that appends the rows whose key no earlier batch brought, the first of each key in ``order``.

    What was seen is the table itself, so a stream keeps no state, however long it runs. A batch is reduced to one row
    per key; the stored keys are narrowed to those of the batch, by a broadcast where the batch is small and else with
    a Bloom filter before they are shuffled; only key columns are read. Null keys are equal to each other, as in
    ``dedupe_stream``. ``order`` has to be total.

    Every batch has a folder of its own below ``source``, the name of the stream: a batch that is repeated after a
    failure replaces its folder and is not compared with it. A stream with a new checkpoint needs a new name. One
    writer per table.
    """
    label = {"source", "batch"}

    def append_new(batch: DataFrame, batch_id: int | str) -> None:
        if label & set(batch.columns):
            raise ValueError(f"columns may not be named {sorted(label)}")
        spark = batch.sparkSession
        # read twice below, and the batch may come out of a stateful plan
        batch = batch.persist()
        try:
            new = dedupe(batch, keys, order, keep="first")
            stored = read_or_none(spark, path)
            if stored is not None:
                own = (F.col("source").cast("string") == source) & (F.col("batch") == F.lit(batch_id).cast("bigint"))
                renamed = {k: f"_seen_{at}" for at, k in enumerate(keys)}
                same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(renamed[k])) for k in keys])
                known = stored.where(~own).select(*[F.col(k).alias(renamed[k]) for k in keys])
                seen = known.join(batch.select(*keys).distinct(), same, "left_semi")
                new = new.join(seen, same, "left_anti")
            new.write.mode("overwrite").parquet(f"{path.rstrip('/')}/source={source}/batch={batch_id}")
        finally:
            batch.unpersist()

    return append_new
