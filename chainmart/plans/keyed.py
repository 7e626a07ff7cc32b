"""Tables stored in buckets of their key: a merge shuffles its updates and never the table."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.merge import REPLACE, SET_ON_INSERT, policy_columns, reduce_updates
from ..sources.sinks import append_rows
from ..streaming.upsert import read_or_none, remove


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


class KeyedTable:
    """A Parquet table below ``path``, at most one row per key, its files cut into ``buckets`` by a hash of the key.

    Each merge writes a new version beside the old one and then adds one row to the table's history, which is what
    readers go by: an interrupted merge leaves the former version in force, and its files are not looked at again. The
    number of buckets is fixed when the table is made; take about one for each 128 MB that the table will hold. One
    writer at a time. Keys must not be null: a null key raises an error when it is written.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], buckets: int):
        self.spark, self.path, self.keys, self.buckets = spark, path.rstrip("/"), list(keys), buckets

    def _history(self) -> DataFrame | None:
        return read_or_none(self.spark, f"{self.path}/history")

    def _latest(self):
        history = self._history()
        return None if history is None else history.orderBy(F.col("version").desc()).first()

    def _temporary_name(self) -> str:
        return f"keyed_{uuid.uuid4().hex}"

    def read(self) -> DataFrame | None:
        """The latest version, known to Spark as cut by key; None before the first merge."""
        latest = self._latest()
        if latest is None:
            return None
        if latest["buckets"] != self.buckets:
            raise ValueError(f"{self.path} has {latest['buckets']} buckets, not {self.buckets}")
        name, by = self._temporary_name(), ", ".join(map(_quoted, self.keys))
        self.spark.sql(
            f"CREATE TABLE {name} ({latest['columns']}) USING parquet CLUSTERED BY ({by}) INTO {self.buckets} BUCKETS "
            f"LOCATION '{self.path}/{latest['folder']}'"
        )
        try:
            # resolved while the name is known; the files are not the catalog's and outlive it
            rows = self.spark.table(name)
            rows.schema
            return rows
        finally:
            self.spark.sql(f"DROP TABLE {name}")

    def _publish(self, rows: DataFrame) -> None:
        latest = self._latest()
        version = 1 + (latest["version"] if latest else 0)
        folder, name = f"version-{version}-{uuid.uuid4().hex}", self._temporary_name()
        write = rows.write.option("path", f"{self.path}/{folder}").bucketBy(self.buckets, *self.keys)
        write.saveAsTable(name, format="parquet")
        self.spark.sql(f"DROP TABLE {name}")
        # an empty version has no file that tells its columns
        columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in rows.schema.fields)
        values = {"version": version, "folder": folder, "buckets": self.buckets, "columns": columns}
        row = self.spark.range(1).select(*[F.lit(v).alias(c) for c, v in values.items()])
        append_rows(row, f"{self.path}/history")
        self._remove_before(version - 1)

    def _remove_before(self, version: int) -> None:
        """Files of versions below ``version``; the last one but one stays for whoever is reading it."""
        old = self._history().where((F.col("version") < version) & (F.col("version") >= version - 1))
        for (folder,) in old.select("folder").collect():
            remove(self.spark, f"{self.path}/{folder}")

    def merge(self, updates: DataFrame, order: Sequence[str], policies: Mapping[str, str] | None = None) -> None:
        """Apply ``updates`` one after another in ``order``, as ``merge_upsert`` does, and publish the result.

        Several updates of a key are reduced to one row before they meet the table (combined on the map side, so a hot
        key leaves each task as one row). Columns of ``order`` are not kept. Merging one batch twice changes nothing.
        """
        self._publish(self.merged(updates, order, policies))

    def merged(self, updates: DataFrame, order: Sequence[str], policies: Mapping[str, str] | None = None) -> DataFrame:
        """What ``merge`` writes: the table is scanned by bucket and joined where it is, only updates are shuffled."""
        target = self.read()
        cols = [c for c in updates.columns if c not in order] if target is None else target.columns
        keyed = updates.withColumns(
            {k: F.coalesce(F.col(k), F.raise_error(F.lit("null merge key")).cast(updates.schema[k].dataType)) for k in self.keys}
        )
        by_policy = policy_columns(cols, self.keys, policies)
        new = reduce_updates(keyed, self.keys, order, by_policy)
        from_update = {
            **{c: F.col(f"_replaced.{c}") for c in by_policy[REPLACE]},
            **{c: F.col(f"_inserted.{c}") for c in by_policy[SET_ON_INSERT]},
        }
        if target is None:
            return new.select(*[from_update.get(c, F.col(c)).alias(c) for c in cols])
        names = {c: f"_old_{at}" for at, c in enumerate(cols)}
        old = target.select(*[F.col(c).alias(names[c]) for c in cols], F.lit(True).alias("_stored"))
        new = new.withColumn("_changed", F.lit(True))
        same = [F.col(k) == F.col(names[k]) for k in self.keys]
        both = old.join(new, same, "full_outer")

        def value(c: str):
            was, stored, changed = F.col(names[c]), F.col("_stored").isNotNull(), F.col("_changed").isNotNull()
            if c in self.keys:
                return F.coalesce(was, F.col(c))
            if c in by_policy[REPLACE]:
                return F.when(changed, from_update[c]).otherwise(was)
            if c in by_policy[SET_ON_INSERT]:
                return F.when(stored, was).otherwise(from_update[c])
            return F.coalesce(F.col(c), was)

        return both.select(*[value(c).alias(c) for c in cols])
