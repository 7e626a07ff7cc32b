"""File scans, batch or streaming. Lines keep what a total order over all files needs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Order of arrival: sorted path, then position in the file. Split files need the block
# start; the running id orders lines only within one block.
FILE_ORDER = ("file_path", "file_block_start", "row_id")
# Between the documents of one file: a control character, which JSON text never has bare.
RECORD_SEPARATOR = "\x1e"


def _reader(spark: SparkSession, glob: str, stream: bool, **options: str):
    reader = spark.readStream if stream else spark.read
    reader = reader.option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
    for name, value in options.items():
        reader = reader.option(name, value)
    return reader


def scan_jsonl(
    spark: SparkSession, path: str, glob: str = "*.jsonl", stream: bool = False, **options: str
) -> DataFrame:
    """Non-blank lines with their parsed document.

    Columns: ``value`` (trimmed line), ``doc`` (VARIANT, NULL unless the line is a JSON
    object), ``file_path``, ``file_name``, ``file_block_start``, ``row_id``. Streaming sources
    take ``cleanSource`` (archive or delete) and ``maxFilesPerTrigger`` as options; their
    ``row_id`` is set per batch, by ``streaming.upsert_into``.
    """
    lines = _reader(spark, glob, stream, **options).text(path)
    value = F.trim(F.regexp_replace("value", r"^\s+|\s+$", ""))
    path_col = F.col("_metadata.file_path")
    return lines.select(
        value.alias("value"),
        path_col.alias("file_path"),
        F.element_at(F.split(path_col, "/"), -1).alias("file_name"),
        F.col("_metadata.file_block_start").alias("file_block_start"),
        (F.lit(None).cast("bigint") if stream else F.monotonically_increasing_id()).alias("row_id"),
    ).where("value <> ''").withColumn(
        "doc", F.when(F.startswith("value", F.lit("{")), F.try_parse_json("value"))
    )


def scan_documents(
    spark: SparkSession,
    path: str,
    glob: str = "*.json",
    stream: bool = False,
    separator: str | None = None,
    **options: str,
) -> DataFrame:
    """One row per document, of one line or many; ``doc`` is NULL for a bad one, the others are not touched by it.

    A file is one document, or, with ``separator``, as many as it parts. Where documents are many and small, files
    of many cost less: opening a file takes longer than reading a document, and each file is listed on the driver.
    """
    reader = _reader(spark, glob, stream, **options)
    files = reader.text(path, wholetext=True) if separator is None else reader.text(path, lineSep=separator)
    path_col = F.col("_metadata.file_path")
    return files.select(
        F.col("value"),
        F.try_parse_json("value").alias("doc"),
        path_col.alias("file_path"),
        F.element_at(F.split(path_col, "/"), -1).alias("file_name"),
    )


def scan_partition(df: DataFrame, ds: str, only_ds: bool, column: str = "ds") -> DataFrame:
    """The ``ds`` partition when asked for and present, otherwise everything.

    Looks for a single row of the partition first (that reads one partition at most),
    so the returned plan prunes to the partition at scan time.
    """
    part = df.where(F.col(column) == F.lit(ds))
    return part if only_ds and not part.select(column).isEmpty() else df
