"""Two tables that must agree, compared by order-free fingerprints per range of keys.

Each range of a table is reduced to its row count and two sums of 64-bit row hashes: no row moves,
and the order of rows does not matter. Ranges whose fingerprints agree are done; only the rows of
the others are joined. Two builds of one table that differ in a few rows cost a scan each and a
join of a few ranges, instead of a full outer join of both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Ranges of keys. What is broadcast is at most one row of each.
RANGES = 4096
#: Share of ranges above which the rows are joined without picking ranges.
MOST = 0.5


def key_range(keys: list[str], ranges: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(ranges)).cast("int")


def fingerprints(df: DataFrame, keys: list[str], columns: list[str], ranges: int = RANGES) -> DataFrame:
    """(range, rows, a, b): one row per range of keys that has rows."""
    own = [F.col(c) for c in [*keys, *columns]]
    # a null and a blank differ: the hash skips nulls, so they are counted in
    nulls = F.concat(*[F.when(c.isNull(), "0").otherwise("1") for c in own])
    wide = lambda seed: F.sum(F.xxhash64(F.lit(seed), nulls, *own).cast("decimal(38,0)"))
    return df.groupBy(key_range(keys, ranges).alias("range")).agg(F.count("*").alias("rows"), wide(1).alias("a"), wide(2).alias("b"))


def differing(left: DataFrame, right: DataFrame, keys: list[str], columns: list[str], ranges: int = RANGES) -> DataFrame:
    """The ranges whose fingerprints differ, or that one side alone has."""
    l, r = fingerprints(left, keys, columns, ranges).alias("l"), fingerprints(right, keys, columns, ranges).alias("r")
    same = F.lit(True)
    for c in ("rows", "a", "b"):
        same = same & F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}"))
    return l.join(r, F.col("l.range") == F.col("r.range"), "full_outer").where(~same).select(F.coalesce("l.range", "r.range").alias("range"))


def differences(left: DataFrame, right: DataFrame, keys: list[str], columns: list[str], ranges: int = RANGES) -> DataFrame:
    """``keys``, ``outcome``: left only, right only, differs, or held more than once.

    Keys may hold nulls, which are equal to each other. A key that stands more than once on a side
    of a differing range is named as such and not compared."""
    picked = differing(left, right, keys, columns, ranges).persist()
    some = picked.count()
    if some <= MOST * ranges:
        inside = [d.withColumn("_r", key_range(keys, ranges)).join(F.broadcast(picked.withColumnRenamed("range", "_r")), "_r", "left_semi").drop("_r") for d in (left, right)]
    else:
        inside = [left, right]
    picked.unpersist()
    sides = [d.select(*keys, *columns, F.lit(k).alias("_side")) for k, d in enumerate(inside)]
    value = F.struct(*columns) if columns else F.lit(0)
    per = sides[0].unionByName(sides[1]).groupBy(*keys).agg(
        F.count_if(F.col("_side") == 0).alias("_l"), F.count_if(F.col("_side") == 1).alias("_r"), F.min(value).alias("_min"), F.max(value).alias("_max")
    )
    outcome = (
        F.when((F.col("_l") > 1) | (F.col("_r") > 1), "held more than once")
        .when(F.col("_r") == 0, "left only")
        .when(F.col("_l") == 0, "right only")
        .when(~F.col("_min").eqNullSafe(F.col("_max")), "differs")
    )
    return per.withColumn("outcome", outcome).where("outcome IS NOT NULL").select(*keys, "outcome")
