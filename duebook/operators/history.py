"""Backlogs over time, editions of a register, streaks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def month_ends(spark: SparkSession, first: str, last: str) -> DataFrame:
    return spark.range(1).select(
        F.explode(
            F.transform(
                F.sequence(F.to_date(F.lit(first)), F.to_date(F.lit(last)), F.expr("interval 1 month")),
                F.last_day,
            )
        ).alias("as_at")
    )


def open_at(
    df: DataFrame, first: str, last: str, tabled: str = "tabled", answered: str = "answered"
) -> DataFrame:
    """Rows open at each month end, as (as_at, wait, rows).

    Obligations shrink to counts per (tabled, answered) pair of days first. Each
    pair then lists the month ends it was open at, so no range join is needed and
    the work grows with the calendar once the rows are reduced.
    """
    pairs = df.groupBy(tabled, answered).agg(F.count("*").alias("rows"))
    lo = F.greatest(F.to_date(F.lit(first)), F.trunc(tabled, "MM"))
    hi = F.least(
        F.to_date(F.lit(last)),
        F.coalesce(F.date_sub(answered, 1), F.to_date(F.lit(last))),
    )
    ends = F.when(
        lo <= hi,
        F.transform(F.sequence(lo, F.greatest(lo, hi), F.expr("interval 1 month")), F.last_day),
    )
    return (
        pairs.withColumn("as_at", F.explode(ends))
        .where(
            (F.col(tabled) <= F.col("as_at"))
            & (F.col(answered).isNull() | (F.col(answered) > F.col("as_at")))
            & (F.col("as_at") <= F.to_date(F.lit(last)))
        )
        .select("as_at", F.datediff("as_at", tabled).alias("wait"), "rows")
    )


def backlog(spark: SparkSession, df: DataFrame, first: str, last: str) -> DataFrame:
    """One row per month end: backlog, oldest, median and long waits; months with none included."""
    stats = (
        open_at(df, first, last)
        .groupBy("as_at")
        .agg(
            F.sum("rows").alias("backlog"),
            F.max("wait").alias("oldest_days"),
            F.bround(F.percentile("wait", F.lit(0.5), F.col("rows")), 0).cast("int").alias("median_days"),
            F.sum(F.when(F.col("wait") > 365, F.col("rows")).otherwise(0)).alias("over_1_year"),
            F.sum(F.when(F.col("wait") > 1826, F.col("rows")).otherwise(0)).alias("over_5_years"),
        )
    )
    return (
        month_ends(spark, first, last)
        .where(F.col("as_at") <= F.to_date(F.lit(last)))
        .join(stats, "as_at", "left")
        .na.fill(0, ["backlog", "over_1_year", "over_5_years"])
    )


def at_editions(df: DataFrame, editions: list[str]) -> DataFrame:
    """A row per obligation and edition that lists it (tabled by then, and not answered by then)."""
    dates = F.array(*[F.to_date(F.lit(e)) for e in editions])
    listed = F.filter(
        F.transform(dates, lambda e, i: F.struct(e.alias("edition"), (i + 1).cast("int").alias("edition_no"))),
        lambda s: (F.col("tabled") <= s["edition"])
        & (F.col("answered").isNull() | (F.col("answered") > s["edition"])),
    )
    return df.withColumn("_e", F.explode(listed)).select("*", "_e.edition", "_e.edition_no").drop("_e")


def streaks(df: DataFrame, key: list[str], edition_no: str, flag: Column, newest: int) -> DataFrame:
    """How many newest editions in a row carry the flag; a missing edition breaks the run.

    The editions of one key are a set no larger than the list of editions, and the
    set is built on the map side first.
    """
    held = df.where(flag).groupBy(*key).agg(F.collect_set(edition_no).alias("_in"))
    broken = F.array_except(F.sequence(F.lit(1), F.lit(newest)), F.col("_in"))
    return (
        held.withColumn("since_no", F.coalesce(F.array_max(broken), F.lit(0)) + 1)
        .withColumn("editions_in_a_row", F.lit(newest) - F.col("since_no") + 1)
        .where(F.col("editions_in_a_row") > 0)
        .drop("_in")
    )


def edition_changes(now: DataFrame, before: DataFrame, key: list[str]) -> DataFrame:
    """Keys that joined since the previous edition and keys that left."""
    a, b = now.select(*key).distinct(), before.select(*key).distinct()
    return (
        a.join(b, key, "left_anti")
        .withColumn("change", F.lit("joined"))
        .unionByName(b.join(a, key, "left_anti").withColumn("change", F.lit("left")))
    )
