"""Small helpers of the text operators."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from chainmart.session import shared_dir

#: A-Z to a-z, every other byte as it is
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given Parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(df: DataFrame) -> DataFrame:
    """``df``; from now on its session sends texts to Python in batches that are bounded in bytes, however long they are."""
    conf = df.sparkSession.conf
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))
    return df


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to a fresh folder that all executors share, and read back.

    Cuts the lineage: a lost executor repeats only what comes after, and each later use sees the same rows.
    """
    path = shared_dir(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_in_buckets(df: DataFrame, label: str, key: str) -> DataFrame:
    """``stored``, in as many buckets of ``key`` as the session has shuffle partitions.

    What is grouped or joined by ``key`` comes to these rows, and they are not shuffled. The table's name leaves the
    catalog at once; its files stay, as those of ``stored`` do.
    """
    spark = df.sparkSession
    path = shared_dir(spark, label)
    name = "bucketed_" + path.rsplit("-", 1)[1]
    write = df.write.option("compression", "zstd").option("path", path)
    write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), key).saveAsTable(name, format="parquet")
    rows = spark.table(name)
    rows.schema  # resolved here, while the name is known
    spark.sql(f"DROP TABLE {name}")
    return rows


def numbered_rows(df: DataFrame) -> DataFrame:
    """``row, own``: a number for each row beside the row itself, whose columns may have any names.

    The number follows the way in which ``df`` is read: store it before it is used twice.
    """
    return df.select(F.monotonically_increasing_id().alias("row"), F.struct(*df.columns).alias("own"))


def own_columns(rows: DataFrame, df: DataFrame) -> DataFrame:
    """The columns of ``df`` out of ``own``."""
    return rows.select(*[F.col("own")[c].alias(c) for c in df.columns])


def utf8(column: pa.Array) -> list[bytes]:
    """The texts of an Arrow column as UTF-8 bytes; a null counts as empty."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def strings(values: list[bytes]) -> pa.Array:
    """UTF-8 bytes as an Arrow string column."""
    return pa.array(values, pa.binary()).cast(pa.string())


def tokenizer_json(path: str, most: int = 64 << 20) -> str:
    """A tokenizer file's content, read on the driver; its size bounds what is sent to the tasks."""
    with open(path, encoding="utf-8") as f:
        content = f.read(most + 1)
    if len(content) > most:
        raise ValueError(f"{path} has more than {most} characters")
    return content


def kept_by_worker(name: str, make):
    """What ``make`` returns, kept by the Python worker for its next tasks."""
    import sys
    import types

    kept = sys.modules.setdefault("_kept_by_worker", types.ModuleType("_kept_by_worker")).__dict__
    if name not in kept:
        kept[name] = make()
    return kept[name]


def load_tokenizer(content: str):
    """The tokenizer of a file's content, kept by the Python worker for its next tasks."""
    import zlib

    from tokenizers import Tokenizer

    def make():
        tokenizer = Tokenizer.from_str(content)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        return tokenizer

    return kept_by_worker(f"tokenizer-{zlib.crc32(content.encode())}-{len(content)}", make)


class Remembered(dict):
    """key -> ``make(key)``, at most twice ``most`` of them kept: the present ones and those before.

    When the present ones are full they take the place of those before. A key that comes again moves to the present, so
    what is common outlives what came once, however many keys there are.
    """

    def __init__(self, most: int):
        super().__init__()
        self.most, self.before = most, {}

    def make(self, key):
        raise NotImplementedError

    def __missing__(self, key):
        value = self.before.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.most:
            self.before = dict(self)
            self.clear()
        self[key] = value
        return value
