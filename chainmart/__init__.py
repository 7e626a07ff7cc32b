"""Market and chain analytics written as Spark DataFrame operators."""

from .session import get_spark, shared_dir

__all__ = ["get_spark", "shared_dir"]
