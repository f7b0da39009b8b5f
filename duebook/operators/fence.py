"""Evaluate columns once.

Catalyst pushes a filter below the projections that compute what it tests, copying
the whole computation into the filter, and again for every column built on it. For
chains of regular expressions over texts that multiplies the work, until the
generated code no longer compiles. A filter cannot pass a generator, so a stage of
columns is emitted through the explode of a one-element array: each is computed
once per row, and later filters read the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def staged(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns (replacing those of the same name), each evaluated exactly once per row."""
    kept = [F.col(f"`{c}`") for c in df.columns if c not in columns]
    out = df.select(
        *[F.col(f"`{c}`") for c in df.columns],
        F.explode(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))).alias("_staged"),
    )
    return out.select(*kept, *[F.col(f"_staged.{n}").alias(n) for n in columns])


def by_document(df: DataFrame, key: str) -> DataFrame:
    """Spread documents over the shuffle partitions by their key.

    Reading a text costs far more than moving it, a document is one row, so its key is
    never hot, and every later grouping, window or join on the document (or on it and
    more) finds its rows in place: the chain needs this shuffle and no other.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, key)


def large(df: DataFrame) -> DataFrame:
    """A side that grows with the tables. Its size on disk or in a plan's guess says little of the
    words it holds in memory, so it is shuffled whatever that size, never gathered on the driver."""
    return df.hint("merge")
