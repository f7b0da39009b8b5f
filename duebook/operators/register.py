"""One refresh of a register, in the order its steps depend on each other.

Links come before removals, removals before the overlap of the registers, and the
history last. Two tables are written on the way, after the links and after the
removals: several steps read each, a lost executor does not take the work back to the
start, and no plan carries the plans of the steps before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from duebook.functions import dates
from duebook.operators import gates, history, matching, merge
from duebook.sources.sinks import settle
from duebook.streaming.increments import work_folder


def refresh(
    spark: SparkSession,
    schedule: DataFrame,
    tracker: DataFrame,
    reports: DataFrame,
    responses: DataFrame,
    links: DataFrame,
    by_hand: DataFrame,
    other: DataFrame,
    as_at: str,
    today: str,
    first_month: str,
) -> dict[str, DataFrame]:
    """Open obligations, removals with their evidence, rows on both registers, backlog, faults.

    schedule and tracker: id, title, body, tabled; reports: id, title, body, day;
    responses: rid, title, tabled; links: ref, rid; by_hand: title, tabled, rid; other:
    id, title, body, day, ref.
    """
    now = F.to_date(F.lit(today))
    listed = merge.union_fallback(schedule, tracker, as_at, "tabled")
    linked = matching.report_link(listed.select("id", "title", "body", F.col("tabled").alias("day")), reports)
    listed = listed.join(linked.select("id", F.col("rid").alias("ref")), "id", "left")
    folder = work_folder(spark, "refresh")
    listed = settle(spark, listed, f"{folder}/listed")
    since = responses.where(F.col("tabled") > F.to_date(F.lit(as_at)))
    removed = matching.removal_match(listed, since, links, by_hand)
    answered = removed.join(since.select("rid", F.col("tabled").alias("answered")), "rid")
    rows = settle(spark, listed.join(answered, "id", "left"), f"{folder}/rows")
    still = rows.where("answered IS NULL").select(
        "id",
        "title",
        "body",
        "tabled",
        "ref",
        "source",
        F.datediff(now, "tabled").alias("days_outstanding"),
        (now > dates.deadline(F.col("tabled"))).alias("overdue"),
    )
    return {
        "open": still,
        "removed": rows.where("answered IS NOT NULL").select("id", "rid", "basis", "answered"),
        "on_both": matching.cross_match(still.select("id", "title", "body", F.col("tabled").alias("day"), "ref"), other),
        "backlog": history.backlog(spark, rows, first_month, today),
        "faults": gates.violations(
            rows,
            {"response before report": F.col("answered") < F.col("tabled"), "no title": F.trim("title") == ""},
            F.col("id"),
        ),
    }
