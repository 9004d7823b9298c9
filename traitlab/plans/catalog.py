"""Registered queries: name -> Spark callable (spark, sf_dir) -> DataFrame,
and name -> DuckDB oracle SQL.  ``__spark_entry__`` only re-exports these.

Float outputs are rounded to 6 digits on both sides (4 after iterative
algorithms); counts are BIGINT on both sides."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, Callable[[], str]] = {}


def register(name: str, sql: Callable[[], str] | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return deco


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column (both sides of the oracle do the same)."""
    return df.select(
        *[F.round(F.col(f"`{f.name}`"), digits).alias(f.name) if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f"`{f.name}`") for f in df.schema.fields]
    )


def load_all() -> None:
    """Import the modules that register queries."""
    from traitlab.plans import q_classify, q_cluster, q_enrich, q_features, q_grid, q_profile, q_sample, q_scoring, q_search, q_survey  # noqa: F401
