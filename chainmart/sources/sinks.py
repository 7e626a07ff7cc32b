"""Writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_jsonl(df: DataFrame, path: str, partition_by: Sequence[str] = ("ds", "symbol", "interval")) -> None:
    """Append dated JSON lines below ``path``, one folder per partition value.

    Rebalanced by folder: small folders get one file, a folder holding most rows several.
    """
    df.hint("rebalance", *partition_by).write.partitionBy(*partition_by).mode("append").json(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header and no index column."""
    df.write.option("header", "true").option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss[.SSSSSS]").csv(path)


def append_documents(docs: DataFrame, path: str, status: int = 200, received_at: Column | None = None) -> None:
    """Append parsed documents to the raw table; files that did not parse are left out."""
    raw_documents(docs, status, received_at).write.mode("append").parquet(path)


def append_rows(df: DataFrame, path: str) -> None:
    """Append rows to a history table; an empty result leaves no trace in it."""
    df.write.mode("append").parquet(path)


def raw_documents(docs: DataFrame, status: int = 200, received_at: Column | None = None) -> DataFrame:
    """Rows of the raw table: the document, its status and where it came from."""
    return docs.where(F.col("doc").isNotNull()).select(
        (received_at if received_at is not None else F.current_timestamp()).alias("ingestion_timestamp"),
        F.col("doc").alias("api_response"),
        F.lit(status).alias("status_code"),
        F.lit(None).cast("variant").alias("request_params"),
        F.col("file_path").alias("source_file"),
    )


def rejected_documents(docs: DataFrame, received_at: Column) -> DataFrame:
    """Files that did not parse, whole, so that they can be read again once what is wrong with them is known."""
    return docs.where(F.col("doc").isNull()).select(
        F.col("file_path").alias("source_file"), "value", F.lit("not_json").alias("reject_reason"), received_at.alias("updated_at")
    )


def write_merged(merged: DataFrame, path: str, *partition_by: str) -> None:
    """Replace exactly the partitions that occur in ``merged``; all others stay untouched."""
    (
        merged.hint("rebalance", *partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )
