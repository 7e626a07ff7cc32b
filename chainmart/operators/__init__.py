"""DataFrame -> DataFrame operators; none of them triggers a job unless its docstring says so."""

from .asof import asof_join
from .coerce import coerce_datetime_columns
from .gaps import missing_minutes, missing_numbers, to_fetch
from .joins import known_keys, lookup_keys, scalar_key, star_join
from .marks import candle_cursors, high_water_mark, incremental_scan
from .merge import dedupe, insert_if_absent, merge_documents, merge_upsert
from .quality import Rule, constraint_violations, quality_counters, split_valid, tag_rejects
from .stats import describe, exact_quantiles, regression_line

__all__ = [
    "Rule",
    "asof_join",
    "candle_cursors",
    "coerce_datetime_columns",
    "constraint_violations",
    "dedupe",
    "describe",
    "exact_quantiles",
    "high_water_mark",
    "incremental_scan",
    "insert_if_absent",
    "known_keys",
    "lookup_keys",
    "merge_documents",
    "merge_upsert",
    "missing_minutes",
    "missing_numbers",
    "quality_counters",
    "regression_line",
    "scalar_key",
    "split_valid",
    "star_join",
    "to_fetch",
    "tag_rejects",
]
