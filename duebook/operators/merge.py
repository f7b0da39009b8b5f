"""Putting tables together: first source wins, upserts, differences, loose duplicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def first_wins(df: DataFrame, key: list[str], order: list[Column | str], payload: list[str]) -> DataFrame:
    """The first row of each key in an explicit order, with how many others it displaced.

    A minimum over a struct is combined on the map side, so copies of one key never
    meet in one task in full.
    """
    ranked = F.struct(*order, *payload)
    return (
        df.groupBy(*key)
        .agg(F.min(ranked).alias("_first"), (F.count("*") - 1).alias("displaced"))
        .select(*key, *[F.col(f"_first.{p}").alias(p) for p in payload], "displaced")
    )


def upsert(held: DataFrame, fresh: DataFrame, key: str, columns: list[str], placeholder: Column) -> DataFrame:
    """Fill placeholders of the held table in place, append unknown keys, keep the rest.

    ``placeholder`` is a condition on the held row (columns prefixed ``h.``).
    """
    h, f = held.alias("h"), fresh.alias("f")
    known = F.col(f"h.{key}").isNotNull()
    take = ~known | (placeholder & F.col(f"f.{key}").isNotNull())
    return h.join(f, F.col(f"h.{key}") == F.col(f"f.{key}"), "full_outer").select(
        F.coalesce(F.col(f"h.{key}"), F.col(f"f.{key}")).alias(key),
        *[F.when(take, F.col(f"f.{c}")).otherwise(F.col(f"h.{c}")).alias(c) for c in columns],
        F.when(~known, "new").when(take, "filled").otherwise("held").alias("action"),
    )


def new_and_gone(held: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """Keys on either side with what became of them: new, gone or held."""
    a = held.select(key).distinct().withColumn("_h", F.lit(True))
    b = seen.select(key).distinct().withColumn("_s", F.lit(True))
    return a.join(b, key, "full_outer").select(
        key,
        F.when(F.col("_h").isNull(), "new").when(F.col("_s").isNull(), "gone").otherwise("held").alias("fate"),
    )


def loose_dedupe(
    df: DataFrame, exact: list[str], loose: list[str], dated: Column, preferred: Column, order: list[str]
) -> DataFrame:
    """One row per loose key among dated rows and per exact key among the rest.

    Dated rows with the same exact key share their loose key, so one pass settles
    each row. It is a struct minima over (not preferred, source order): a group
    that holds a third of all rows is reduced before it is shuffled.
    """
    cols = df.columns
    rank = [(~preferred).cast("int").alias("_p"), *order]

    def once(part: DataFrame, key: list[str]) -> DataFrame:
        rest = [c for c in cols if c not in key + order]
        return (
            part.groupBy(*key)
            .agg(F.min(F.struct(*rank, *rest)).alias("_r"))
            .select(*key, F.col("_r.*"))
            .select(*cols)
        )

    known = F.coalesce(dated, F.lit(False))
    return once(df.where(known), loose).unionByName(once(df.where(~known), exact))


def union_fallback(primary: DataFrame, fallback: DataFrame, as_at: str, tabled: str) -> DataFrame:
    """The primary table, and fallback rows tabled after the date the primary speaks for."""
    return primary.withColumn("source", F.lit("primary")).unionByName(
        fallback.where(F.col(tabled) > F.to_date(F.lit(as_at))).withColumn("source", F.lit("fallback"))
    )
