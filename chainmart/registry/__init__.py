"""Registered queries over the given tables, each with the SQL it is checked against."""

from .base import ORACLES, QUERIES
from . import analysis, cleanup, expressions, merging, landing, quality, quarantine, schema, streams  # noqa: F401, E402

__all__ = ["ORACLES", "QUERIES"]
