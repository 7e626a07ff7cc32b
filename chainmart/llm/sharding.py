"""Contiguous shards of near-equal size from global prefix sums. DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .common import read_table, stored

#: bytes that a row takes besides its text
ROW_BYTES = 16


def row_bytes(text: str = "text") -> Column:
    """UTF-8 bytes of the text (none for a null) and a fixed share."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + F.lit(ROW_BYTES)


def balanced_shards(df: DataFrame, key: str, size: str, n_shards: int, order: list[str] = ()) -> DataFrame:
    """Add ``shard`` and ``slot`` to rows laid end to end in the order of ``key`` (then ``order``, nulls first).

    Rows are dealt to ranges of the key; each range's bytes and rows are summed, the totals' running sum gives every
    range its place in the whole, and a row's place adds the sum of the rows before it in its range. The line of bytes
    is cut into ``n_shards`` equal targets and a row goes where its middle lies, so a shard misses its target by less
    than one row. ``slot`` counts the rows of a shard from 0. Rows that are equal in all columns may change places.
    An empty table gives no rows. Sizes have to be positive. Only the columns of ``df`` are moved: pass no texts.
    Columns of ``df`` may have any names but those of the two that are added.
    """
    if n_shards < 1:
        raise ValueError("at least one shard")
    names = list(dict.fromkeys([key, *order, size]))
    columns, df = df.columns, df.select(
        F.struct(*df.columns).alias("_own"), F.col(size).alias("_size"), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(names)]
    )
    size = "_size"
    order = [F.col(f"_o{i}").asc_nulls_first() for i in range(len(names))]
    dealt = df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    dealt = stored(dealt, "shard-ranges")  # ranges are sampled: fix them before they are read twice
    totals = dealt.groupBy("_range").agg(F.sum(size).alias("_bytes"), F.count("*").alias("_rows"))
    # one row for each range, however many rows the table has
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    totals = totals.select(
        "_range",
        F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_bytes_before"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows_before"),
        F.sum("_bytes").over(everything).alias("_all"),
    )
    within = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        dealt.withColumns(
            {
                "_start": F.coalesce(F.sum(size).over(within), F.lit(0)),
                "_nth": F.row_number().over(Window.partitionBy("_range").orderBy(*order)) - 1,
            }
        )
        .join(totals, "_range")
        .withColumns({"_start": F.col("_start") + F.col("_bytes_before"), "_nth": F.col("_nth") + F.col("_rows_before")})
        # the middle in halves of a byte, as decimal: no overflow however long the line
        .withColumn("_mid", (F.col("_start") * 2 + F.col(size)).cast("decimal(28,0)"))
        # whole numbers throughout: a quotient of decimals would be rounded up just below a cut
        .withColumn("shard", F.expr(f"int((_mid * {int(n_shards)}) div (cast(_all AS decimal(28,0)) * 2))"))
    )
    placed = stored(placed.select("_own", "shard", "_nth"), "shard-places")
    first = placed.groupBy("shard").agg(F.min("_nth").alias("_first"))
    out = placed.join(first, "shard").withColumn("slot", F.col("_nth") - F.col("_first"))
    return out.select(*[F.col("_own")[c].alias(c) for c in columns], "shard", "slot")


def shard_documents(docs: DataFrame, n_shards: int = 40, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Return ``key, size, text_crc32, law, shard, slot, grown_shard`` of every document.

    A null text is empty (size 16, checksum 0); null keys come first; repeated rows keep their number.
    """
    narrow = docs.select(
        F.col(key).alias(key),
        row_bytes(text).alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
    )
    return balanced_shards(narrow, key, "size", n_shards, ["text_crc32"]).select(
        key,
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 contiguous shards of near-equal bytes."""
    return shard_documents(read_table(spark, sf_dir, "documents"))


#: checksums by table lookup over the bytes; the 256 table entries follow from the polynomial
ORACLE = """
WITH poly AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i::BIGINT, range(8)), lambda c, k:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
sized AS (
  SELECT doc_id, coalesce(strlen(text), 0)::BIGINT + 16 AS size,
         xor(list_reduce(list_prepend(4294967295::BIGINT,
               list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::BIGINT)),
             lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS text_crc32
  FROM documents, poly),
placed AS (
  SELECT *, coalesce(sum(size) OVER (ORDER BY doc_id NULLS FIRST, text_crc32, size
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s, sum(size) OVER () AS total,
         row_number() OVER (ORDER BY doc_id NULLS FIRST, text_crc32, size) AS n
  FROM sized),
cut AS (SELECT *, (((s * 2 + size) * 40) // (total * 2))::INTEGER AS shard FROM placed)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
       n - min(n) OVER (PARTITION BY shard) AS slot, NULL::INTEGER AS grown_shard
FROM cut"""
