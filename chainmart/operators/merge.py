"""De-duplication and the merge (upsert) family, as grouped aggregates.

Everything is phrased as "reduce target and updates by key", as an aggregate
or as the first of a ranking, which combines on the map side: a key that holds
a third of all rows leaves each task as one row. Order keys must be total, so
results do not depend on task scheduling.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

REPLACE = "replace"  # the last write wins, NULL included
KEEP_IF_NULL = "keep_if_null"  # the last non-null write wins
SET_ON_INSERT = "set_on_insert"  # the first write wins
_POLICIES = (REPLACE, KEEP_IF_NULL, SET_ON_INSERT)


def dedupe(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], keep: str = "last"
) -> DataFrame:
    """One whole row per key: the last (or first) in ``order``.

    ``row_number() = 1`` lets Spark prune to one row per key and task before the shuffle.
    """
    cols = [F.col(o) if isinstance(o, str) else o for o in order]
    ranking = [c.desc_nulls_last() if keep == "last" else c.asc_nulls_first() for c in cols]
    w = Window.partitionBy(*keys).orderBy(*ranking)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def _stack(target: DataFrame | None, updates: DataFrame, order: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Target rows (rank 0, one per key) below the updates in their own order."""
    types = {f.name: f.dataType for f in updates.schema.fields}
    old_order = F.struct(
        F.lit(0).alias("batch"), *[F.lit(None).cast(types[o]).alias(o) for o in order]
    )
    new_order = F.struct(F.lit(1).alias("batch"), *[F.col(o).alias(o) for o in order])
    new = updates.select(*cols, new_order.alias("_ord"))
    if target is None:
        return new
    old = target.select(*cols, old_order.alias("_ord"))
    return old.unionByName(new)


def merge_upsert(
    target: DataFrame | None,
    updates: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    policies: Mapping[str, str] | None = None,
) -> DataFrame:
    """New state of ``target`` after applying ``updates`` one after another in ``order``.

    ``policies`` names the columns that are not plainly replaced. Several
    updates of one key in one batch resolve column by column, exactly as if
    the statements had run in sequence. A missing target counts as empty.

    Where all columns are replaced and all take part in ``order``, a key's last row is its result, whatever ties there
    are, so rows are ranked: each goes through the shuffle without a copy of the columns that order it.
    """
    cols = [c for c in updates.columns if c not in order] if target is None else target.columns
    by_policy = policy_columns(cols, keys, policies)
    if set(by_policy[REPLACE]) == {c for c in cols if c not in keys} <= set(order) and by_policy[REPLACE]:
        return _last_rows(target, updates, keys, order, cols)
    merged = _reduced(_stack(target, updates, order, cols), keys, by_policy)
    place = {c: F.col(f"_replaced.{c}") for c in by_policy[REPLACE]}
    place.update({c: F.col(f"_inserted.{c}") for c in by_policy[SET_ON_INSERT]})
    return merged.select(*[place.get(c, F.col(c)).alias(c) for c in cols])


def _last_rows(
    target: DataFrame | None, updates: DataFrame, keys: Sequence[str], order: Sequence[str], cols: Sequence[str]
) -> DataFrame:
    """The last row of each key: of the updates in ``order``, or of the target where none came."""
    apart = [o for o in order if o not in cols]
    rows = updates.select(*cols, *apart, F.lit(1).alias("_batch"))
    if target is not None:
        none = [F.lit(None).cast(updates.schema[o].dataType).alias(o) for o in apart]
        rows = target.select(*cols, *none, F.lit(0).alias("_batch")).unionByName(rows)
    return dedupe(rows, keys, ["_batch", *order]).select(*cols)


def policy_columns(
    cols: Sequence[str], keys: Sequence[str], policies: Mapping[str, str] | None
) -> dict[str, list[str]]:
    """The columns that are merged by each policy; those not named are replaced."""
    policies = dict(policies or {})
    unknown = set(policies.values()) - set(_POLICIES)
    if unknown:
        raise ValueError(f"unknown merge policies: {sorted(unknown)}")
    measures = [c for c in cols if c not in keys]
    return {p: [c for c in measures if policies.get(c, REPLACE) == p] for p in _POLICIES}


def _reduced(stacked: DataFrame, keys: Sequence[str], by_policy: Mapping[str, Sequence[str]]) -> DataFrame:
    """One row per key: ``_replaced`` and ``_inserted`` hold the columns of these policies, the others are plain."""
    aggs: list[Column] = []
    if by_policy[REPLACE]:
        aggs.append(F.max_by(F.struct(*by_policy[REPLACE]), "_ord").alias("_replaced"))
    if by_policy[SET_ON_INSERT]:
        aggs.append(F.min_by(F.struct(*by_policy[SET_ON_INSERT]), "_ord").alias("_inserted"))
    for c in by_policy[KEEP_IF_NULL]:
        # ordering by NULL excludes the row, which leaves the last non-null value
        aggs.append(F.max_by(c, F.when(F.col(c).isNotNull(), F.col("_ord"))).alias(c))
    return stacked.groupBy(*keys).agg(*aggs) if aggs else stacked.select(*keys).distinct()


def reduce_updates(
    updates: DataFrame, keys: Sequence[str], order: Sequence[str], by_policy: Mapping[str, Sequence[str]]
) -> DataFrame:
    """What the updates of each key come to in ``order``, without the rows that they are to change."""
    cols = [*keys, *[c for some in by_policy.values() for c in some]]
    return _reduced(_stack(None, updates, order, cols), keys, by_policy)


def insert_if_absent(
    target: DataFrame | None, updates: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Existing rows stay; of several new rows with one key the first is inserted."""
    fresh = dedupe(updates, keys, order, keep="first")
    if target is None:
        return fresh
    fresh = fresh.join(target.select(*keys), list(keys), "left_anti")
    return target.unionByName(fresh.select(*target.columns))


def merge_documents(
    target: DataFrame | None,
    updates: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    fields: Sequence[str],
    set_on_insert: Sequence[str],
    present: str = "fields_present",
    payload: str | None = None,
) -> DataFrame:
    """Field-level document merge.

    Of ``fields``, those a document does not carry keep their old value, while
    an explicit NULL overwrites; ``set_on_insert`` columns are written by the
    first document only. ``present`` lists the fields each document carried
    and becomes their union. ``payload`` names a map of fields that are not declared, which
    merge by the same rules (see ``merge_payloads``).
    """
    cols = [*keys, *fields, *set_on_insert, present]
    stacked = _stack(target, updates, order, cols)
    has = lambda f: F.array_contains(F.col(present), f)
    merged = stacked.groupBy(*keys).agg(
        *[F.max_by(f, F.when(has(f), F.col("_ord"))).alias(f) for f in fields],
        F.min_by(F.struct(*set_on_insert), "_ord").alias("_inserted"),
        *[F.bool_or(has(f)).alias(f"_has_{f}") for f in fields],
    )
    carried = F.filter(
        F.array(*[F.when(F.col(f"_has_{f}"), F.lit(f)) for f in fields]), lambda x: x.isNotNull()
    )
    merged = merged.select(
        *keys,
        *fields,
        *[F.col(f"_inserted.{c}").alias(c) for c in set_on_insert],
        carried.alias(present),
    )
    if payload is None:
        return merged
    open_fields = merge_payloads(target, updates, keys, order, payload)
    # keys may be null, as documents may carry a null key
    open_fields = open_fields.withColumnsRenamed({k: f"_open_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_open_{k}")) for k in keys]
    none = F.create_map().cast("map<string,string>")
    return merged.join(open_fields, same, "left").select(
        *merged.columns, F.coalesce(F.col(payload), none).alias(payload)
    )


def merge_payloads(
    target: DataFrame | None, updates: DataFrame, keys: Sequence[str], order: Sequence[str], payload: str
) -> DataFrame:
    """``keys`` and the merged ``payload`` of open documents: a map from field to JSON text.

    Each field takes its last writer in ``order``, so a field that a document does not carry stays and a JSON null
    clears what was there (the field stays, as null). Fields are merged as rows of their own, combined before the
    shuffle, and put together again for each key; a key without any field has no row.
    """
    entries = _stack(target, updates, order, [*keys, payload]).select(
        *keys, "_ord", F.explode(payload).alias("_field", "_value")
    )
    latest = entries.groupBy(*keys, "_field").agg(F.max_by("_value", "_ord").alias("_value"))
    pairs = F.sort_array(F.collect_list(F.struct("_field", "_value")))
    return latest.groupBy(*keys).agg(F.map_from_entries(pairs).alias(payload))
