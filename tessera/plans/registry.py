"""Registry of named queries over the driver tables and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name`` (+ optional oracle SQL)."""
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return deco


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every float column for cross-engine comparison."""
    return df.select([F.round(F.col(f"`{f.name}`"), digits).alias(f.name)
                      if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f"`{f.name}`")
                      for f in df.schema.fields])
