"""Row validation with every rejected row kept, and reports of broken table constraints."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REASON = "reject_reason"


@dataclass(frozen=True)
class Rule:
    """A named condition a row must meet; an unknown (NULL) outcome counts as a failure."""

    name: str
    ok: Column


def tag_rejects(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add ``reject_reason``: the first failing rule, NULL for a valid row."""
    reasons = [F.when(~F.coalesce(r.ok, F.lit(False)), F.lit(r.name)) for r in rules]
    return df.withColumn(REASON, F.coalesce(*reasons))


def split_valid(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """``(valid, rejects)``; the rejects carry their reason."""
    tagged = tag_rejects(df, rules)
    return tagged.where(F.col(REASON).isNull()).drop(REASON), tagged.where(F.col(REASON).isNotNull())


def quality_counters(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows per outcome (``valid`` or the failing rule), combined before the shuffle."""
    outcome = F.coalesce(F.col(REASON), F.lit("valid")).alias("outcome")
    return tag_rejects(df, rules).groupBy(outcome).agg(F.count("*").alias("n_rows"))


def _key_text(keys: Sequence[str]) -> Column:
    return F.concat_ws("|", *[F.col(k).cast("string") for k in keys])


def constraint_violations(
    unique: Sequence[tuple[str, DataFrame, Sequence[str]]] = (),
    not_null: Sequence[tuple[str, DataFrame, Sequence[str]]] = (),
    foreign: Sequence[tuple[str, DataFrame, str, DataFrame, str]] = (),
) -> DataFrame:
    """Violations as rows ``(rule, table_name, key, n_rows)``.

    Every check counts per key first, so a key that holds most of a table
    reaches the shuffle (and the anti-join) as one row per task. Rows whose
    unique key has a NULL part are exempt, as in SQL.
    """
    reports = []
    for table, df, keys in unique:
        reports.append(
            df.dropna(subset=list(keys))
            .groupBy(*keys)
            .agg(F.count("*").alias("n_rows"))
            .where("n_rows > 1")
            .select(
                F.lit("unique").alias("rule"),
                F.lit(table).alias("table_name"),
                _key_text(keys).alias("key"),
                "n_rows",
            )
        )
    for table, df, cols in not_null:
        counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
        reports.append(
            counts.unpivot([], list(cols), "key", "n_rows")
            .where("n_rows > 0")
            .select(F.lit("not_null").alias("rule"), F.lit(table).alias("table_name"), "key", "n_rows")
        )
    for table, child, child_key, parent, parent_key in foreign:
        used = (
            child.where(F.col(child_key).isNotNull())
            .groupBy(F.col(child_key).alias("fk"))
            .agg(F.count("*").alias("n_rows"))
        )
        known = parent.select(F.col(parent_key).alias("fk"))
        reports.append(
            used.join(known, "fk", "left_anti").select(
                F.lit("foreign_key").alias("rule"),
                F.lit(table).alias("table_name"),
                F.col("fk").cast("string").alias("key"),
                "n_rows",
            )
        )
    return reduce(DataFrame.unionByName, reports)
