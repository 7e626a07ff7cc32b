"""Equi-joins of facts with dimensions.

No side is forced into a broadcast: Spark broadcasts a dimension when its
measured size is below ``spark.sql.autoBroadcastJoinThreshold`` and otherwise
shuffles both sides, splitting skewed partitions at run time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lookup_keys(
    fact: DataFrame, dims: Sequence[tuple[DataFrame, str, str]], how: str = "inner"
) -> DataFrame:
    """Natural to surrogate keys: ``dims`` are ``(dim, natural_column, key_column)``.

    An inner lookup drops the rows that miss; ``left`` keeps them with a NULL key.
    """
    for dim, natural, key in dims:
        fact = fact.join(dim.select(natural, key), natural, how)
    return fact


def star_join(fact: DataFrame, dims: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """Inner joins of a fact with ``(dim, key)`` pairs.

    Filter a dimension before passing it: the filter then prunes the fact
    through Spark's run-time filters.
    """
    for dim, key in dims:
        fact = fact.join(dim, key)
    return fact


def known_keys(df: DataFrame, keys: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows whose key occurs in ``keys`` (semi-join; duplicates in ``keys`` do not multiply)."""
    on = [on] if isinstance(on, str) else list(on)
    return df.join(keys.select(*on), on, "left_semi")


def scalar_key(dim: DataFrame, condition: Column, key: str, required: bool = False) -> Column:
    """Key of the one dimension row meeting ``condition`` as a scalar subquery, NULL if none, or an error if ``required``.

    Where several rows qualify the smallest key is taken, so the choice is stable.
    """
    found = F.min(key)
    if required:
        found = F.coalesce(found, F.raise_error(F.lit(f"no member of the dimension for {key}")).cast(dim.schema[key].dataType))
    return dim.where(condition).agg(found).scalar()
