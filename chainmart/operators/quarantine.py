"""Rows that cannot be loaded yet are held, not lost: a ledger of what each one waits for, and its replay.

A row whose dimension member is unknown is written to the ledger with the name of the dimension and the member. A
later load takes the held rows whose member has arrived along with its own; these are marked as released, so the ledger
says of every row when it began to wait and which run loaded it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .merge import merge_upsert

#: what the ledger adds to a row
LEDGER = ("waits_for", "waits_member", "since_run", "released_run")


@dataclass(frozen=True)
class Lookup:
    """A dimension with the natural column that rows carry and the key that they need."""

    name: str
    dim: DataFrame
    natural: str
    key: str


def _members(lookups: Sequence[Lookup]) -> DataFrame:
    parts = [
        l.dim.select(F.lit(l.name).alias("waits_for"), F.col(l.natural).cast("string").alias("waits_member"))
        for l in lookups
    ]
    return reduce(DataFrame.unionByName, parts)


def resolve(rows: DataFrame, lookups: Sequence[Lookup]) -> tuple[DataFrame, DataFrame]:
    """``(ready, waiting)``: rows with all keys, and rows as they came with the first member that they lack.

    Members have to be unique. A null natural value waits for a null member, which never arrives: reject such rows
    before. Both sides come out of the same joins; nothing is dropped.
    """
    out = rows
    for l in lookups:
        out = out.join(l.dim.select(l.natural, F.col(l.key).alias(f"_key_{l.name}")), l.natural, "left")
    lacks = F.coalesce(
        *[
            F.when(
                F.col(f"_key_{l.name}").isNull(),
                F.struct(F.lit(l.name).alias("waits_for"), F.col(l.natural).cast("string").alias("waits_member")),
            )
            for l in lookups
        ]
    )
    out = out.withColumn("_lacks", lacks)
    ready = out.where(F.col("_lacks").isNull()).select(
        *rows.columns, *[F.col(f"_key_{l.name}").alias(l.key) for l in lookups if l.key not in rows.columns]
    )
    return ready, out.where(F.col("_lacks").isNotNull()).select(*rows.columns, "_lacks.*")


def held(ledger: DataFrame | None) -> DataFrame | None:
    """Rows of the ledger that still wait."""
    return None if ledger is None else ledger.where("released_run IS NULL")


def due(ledger: DataFrame | None, lookups: Sequence[Lookup]) -> DataFrame | None:
    """Held rows whose member has arrived; the others are not driven through the load again."""
    rows = held(ledger)
    return None if rows is None else rows.join(_members(lookups).distinct(), ["waits_for", "waits_member"], "left_semi")


def ledger_entries(waiting: DataFrame, released: DataFrame | None, run: int | Column) -> DataFrame:
    """Entries of one load: rows that wait from now on (or for another member), and rows that it has loaded."""
    run = F.lit(run).cast("long") if isinstance(run, int) else run
    entries = waiting.withColumns({"since_run": run, "released_run": F.lit(None).cast("long")})
    if released is None:
        return entries
    return entries.unionByName(released.withColumns({"since_run": run, "released_run": run}).select(*entries.columns))


def record(ledger: DataFrame | None, entries: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The ledger after a load: one row for each key, with the run since which it waits; a repeated load changes nothing.

    A key that is released and comes again as waiting, as when a run is repeated, waits again.
    """
    order = F.coalesce("released_run", "since_run")
    entries = entries.withColumns({"_run": order, "_done": F.col("released_run").isNotNull()})
    return merge_upsert(ledger, entries, list(keys), ["_run", "_done"], {"since_run": "set_on_insert"})
