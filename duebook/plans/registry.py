"""Where each query meets the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Render dates as ISO strings so that every engine compares them alike."""
    return df.select(
        *[
            F.col(f"`{f.name}`").cast("string").alias(f.name)
            if isinstance(f.dataType, T.DateType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def query(name: str, sql: str | None = None):
    """Register a query, and its SQL twin where SQL can state it."""

    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = lambda spark, sf_dir: plain(fn(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register
