"""Queries over the event log: increments, alerts, volumes, streams with their batch twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from duebook.operators import gates, scans
from duebook.plans.derived import OB, obligations
from duebook.plans.registry import query
from duebook.sources import load
from duebook.sources.sinks import fallback_partitions
from duebook.streaming import increments

DAY = "CAST(ts AS DATE)"


def events(spark, sf):
    return load(spark, sf, "events").withColumn("day", F.to_date("ts"))


def stream_of_events(spark, sf):
    """The landed events as a stream; the time column becomes a timestamp for the watermark."""
    return increments.landed(spark, sf, "events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))


@query(
    "incremental_lookback",
    f"""WITH known AS (SELECT * FROM events WHERE value < 50 AND {DAY} < DATE '2024-01-20'), newest AS (SELECT max({DAY}) AS d FROM known)
    SELECT event_id, {DAY}::VARCHAR AS day, event_type FROM events WHERE {DAY} > (SELECT d FROM newest) - 10 AND event_id NOT IN (SELECT event_id FROM known)""",
)
def incremental_lookback(spark, sf):
    """Re-read the days before the newest row held, and keep what is not held."""
    e = events(spark, sf)
    known = e.where((F.col("value") < 50) & (F.col("day") < F.to_date(F.lit("2024-01-20"))))
    newest = known.agg(F.max("day").alias("d")).scalar()  # one value, read as the query runs; none held: all is new
    return (
        e.where(F.coalesce(F.col("day") > F.date_sub(newest, 10), F.lit(True)))
        .join(known.select("event_id"), "event_id", "left_anti")
        .select("event_id", "day", "event_type")
    )


BURST = 1.1


@query(
    "burst_days",
    f"""WITH d AS (SELECT {DAY} AS day, event_type, count(*) AS n FROM events GROUP BY ALL), m AS (SELECT event_type, avg(n) AS mean FROM d GROUP BY 1),
    r AS (SELECT DISTINCT {DAY} AS day, event_type FROM events WHERE value > 400)
    SELECT day::VARCHAR AS day, event_type, n FROM d JOIN m USING (event_type) WHERE n >= {BURST} * mean AND (day, event_type) NOT IN (SELECT (day, event_type) FROM r)""",
)
def burst_days(spark, sf):
    """Days with unusually many events of a class that were not reported before."""
    e = events(spark, sf)
    d = e.groupBy("day", "event_type").agg(F.count("*").alias("n"))
    means = d.groupBy("event_type").agg(F.avg("n").alias("mean"))
    reported = e.where("value > 400").select("day", "event_type").distinct()
    return (
        d.join(means, "event_type").where(F.col("n") >= BURST * F.col("mean")).join(reported, ["day", "event_type"], "left_anti").select("day", "event_type", "n")
    )


@query(
    "digest",
    f"""WITH f AS (SELECT event_id, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k, value FROM events WHERE {DAY} >= DATE '2024-01-25' AND event_id NOT IN (SELECT event_id FROM events WHERE event_type = 'view')),
    r AS (SELECT *, row_number() OVER (ORDER BY value DESC, k DESC, event_id DESC) AS place FROM f)
    SELECT event_id, value, k, CAST(0 AS BIGINT) AS further FROM r WHERE place <= 40 UNION ALL SELECT NULL, NULL, NULL, count(*) FROM r WHERE place > 40""",
)
def digest(spark, sf):
    """New items, longest first: forty are listed and the rest counted."""
    e = events(spark, sf)
    seen = e.where("event_type = 'view'").select("event_id")
    fresh = e.where(F.col("day") >= F.to_date(F.lit("2024-01-25"))).join(seen, "event_id", "left_anti")
    fresh = fresh.select("event_id", "value", F.get_json_object("props", "$.k").try_cast("int").alias("k"))
    listed = fresh.orderBy(F.desc("value"), F.desc("k"), F.desc("event_id")).limit(40)
    rest = fresh.agg(F.greatest(F.count("*") - 40, F.lit(0)).alias("further")).select(
        F.lit(None).cast("bigint").alias("event_id"), F.lit(None).cast("double").alias("value"), F.lit(None).cast("int").alias("k"), "further"
    )
    return listed.withColumn("further", F.lit(0).cast("bigint")).unionByName(rest)


STALE_DAYS = 3
AS_AT = "2024-01-31"
STALE_SQL = f"""s AS (SELECT user_id, event_type, max({DAY}) AS last FROM events GROUP BY ALL), a AS (SELECT user_id, event_type, max({DAY}) AS raised FROM events WHERE value > 60 GROUP BY ALL)
  SELECT user_id, event_type, last::VARCHAR AS last, CAST(DATE '{AS_AT}' - last AS INTEGER) AS days FROM s WHERE DATE '{AS_AT}' - last >= {STALE_DAYS}
    AND (user_id, event_type) NOT IN (SELECT (user_id, event_type) FROM a WHERE DATE '{AS_AT}' - raised < {STALE_DAYS})"""


def raised(e):
    return e.where("value > 60").select("user_id", "event_type", F.to_date("ts").alias("raised")).groupBy("user_id", "event_type").agg(F.max("raised").alias("raised"))


@query("stale_sources", f"WITH {STALE_SQL}")
def stale_sources(spark, sf):
    e = events(spark, sf)
    seen = e.groupBy("user_id", "event_type").agg(F.max("day").alias("last"))
    as_at = F.to_date(F.lit(AS_AT))
    return increments.stale(seen, as_at, STALE_DAYS, raised(e), ["user_id", "event_type"])


@query("stream_stale_sources", f"WITH {STALE_SQL}")
def stream_stale_sources(spark, sf):
    """The same alarm from a stream whose state is the newest time per source."""
    folder = increments.work_folder(spark, "stale")
    seen = increments.last_seen(stream_of_events(spark, sf), "ts", ["user_id", "event_type"])

    def write(df, batch):
        df.write.mode("overwrite").parquet(increments.batch_path(f"{folder}/seen", batch))

    increments.drain(seen, folder, write, "update")
    newest = (
        increments.held(spark, f"{folder}/seen", seen.schema).groupBy("user_id", "event_type").agg(F.to_date(F.max("last")).alias("last"))
    )
    return increments.stale(newest, F.to_date(F.lit(AS_AT)), STALE_DAYS, raised(load(spark, sf, "events")), ["user_id", "event_type"])


@query(
    "stream_dedupe",
    f"SELECT {DAY}::VARCHAR AS day, event_type, count(*) AS events, CAST(sum(event_id) AS BIGINT) AS ids FROM events GROUP BY ALL",
)
def stream_dedupe(spark, sf):
    """Every event lands twice, the second copy in a later batch and dated up to ten days later, and is kept once."""
    folder = increments.work_folder(spark, "dedupe")
    e = load(spark, sf, "events").select("event_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    late = F.col("ts") + F.make_dt_interval((F.col("event_id") % 11).cast("int"))
    e.write.parquet(f"{folder}/landed/copy=1")
    e.withColumn("ts", late).write.parquet(f"{folder}/landed/copy=2")
    files = len(spark.read.parquet(f"{folder}/landed/copy=1").inputFiles())  # the first batch is the first landing
    s = increments.landed(spark, f"{folder}/landed", files_per_batch=files).select("event_id", "event_type", "ts")
    once = increments.dedupe_late(s, "ts", ["event_id"])
    rows = increments.collect_stream(spark, once, folder)
    return rows.groupBy(F.to_date("ts").alias("day"), "event_type").agg(F.count("*").alias("events"), F.sum("event_id").alias("ids"))


@query(
    "stream_burst_days",
    f"SELECT {DAY}::VARCHAR AS day, event_type FROM events WHERE value > 100 GROUP BY ALL HAVING count(*) >= 5",
)
def stream_burst_days(spark, sf):
    """Days with five or more large events of a type, each said once however many batches it grows over."""
    folder = increments.work_folder(spark, "burst")
    large = stream_of_events(spark, sf).where("value > 100")
    counts = increments.daily_counts(large, "ts", ["event_type"])
    return increments.say_once(spark, counts, ["day", "event_type"], folder, F.col("n") >= 5)


@query(
    "data_currency",
    f"""WITH c AS (SELECT event_type, max({DAY}) AS newest, max({DAY}) FILTER (WHERE value > 100) AS checked FROM events GROUP BY 1)
    SELECT event_type, newest::VARCHAR AS newest, checked::VARCHAR AS checked, least(newest, checked)::VARCHAR AS current_to FROM c""",
)
def data_currency(spark, sf):
    """How current each class is: its newest row, and the older of two currencies."""
    c = events(spark, sf).groupBy("event_type").agg(
        F.max("day").alias("newest"), F.max(F.when(F.col("value") > 100, F.col("day"))).alias("checked")
    )
    return c.withColumn("current_to", F.least("newest", "checked"))


@query(
    "gate_volume",
    f"""WITH v AS (SELECT user_id, count(*) FILTER (WHERE {DAY} < DATE '2024-01-15') AS held, count(*) FILTER (WHERE {DAY} >= DATE '2024-01-15') AS seen, count(*) FILTER (WHERE {DAY} >= DATE '2024-01-15' AND event_type = 'signup') AS new FROM events GROUP BY 1)
    SELECT 'fewer than 90% of held' AS rule, user_id::VARCHAR AS key FROM v WHERE seen < 0.9 * held UNION ALL SELECT 'more than 8 new', user_id::VARCHAR FROM v WHERE new > 8 UNION ALL SELECT 'fewer than 35 rows', user_id::VARCHAR FROM v WHERE seen < 35""",
)
def gate_volume(spark, sf):
    cut = F.col("day") >= F.to_date(F.lit("2024-01-15"))
    v = events(spark, sf).groupBy("user_id").agg(
        F.count_if(~cut).alias("held"), F.count_if(cut).alias("seen"), F.count_if(cut & (F.col("event_type") == "signup")).alias("new")
    )
    return gates.volume(v, "user_id", "held", "seen", "new", 0.9, 8, 35)


@query(
    "fallback_partition",
    f"""WITH f AS (SELECT {DAY} AS day, value FROM events WHERE event_type = 'purchase' AND value > 60), c AS (SELECT {DAY} AS day, value FROM events WHERE event_type <> 'purchase')
    SELECT day::VARCHAR AS day, stale, count(*) AS rows FROM (SELECT *, false AS stale FROM f UNION ALL SELECT *, true FROM c WHERE day NOT IN (SELECT day FROM f)) GROUP BY day, stale""",
)
def fallback_partition(spark, sf):
    """Days the fresh read did not bring come from the last good rows, marked as stale."""
    e = events(spark, sf)
    fresh = e.where("event_type = 'purchase' AND value > 60").select("day", "value")
    cached = e.where("event_type <> 'purchase'").select("day", "value")
    return fallback_partitions(fresh, cached, ["day"]).groupBy("day", "stale").agg(F.count("*").alias("rows"))


@query(
    "landing_completeness",
    """WITH p AS (SELECT event_type, event_id // 100 AS page, event_id FROM events), r AS (SELECT event_type, count(DISTINCT page) AS pages, count(DISTINCT event_id) AS ids, max(page) + 1 AS stated_pages, count(*) + length(event_type) AS stated_rows FROM p GROUP BY event_type)
    SELECT *, stated_rows - ids AS drift, pages = stated_pages AND abs(stated_rows - ids) <= 5 AS complete FROM r""",
)
def landing_completeness(spark, sf):
    """Landed pages against the totals the source states; a live source may move by five rows."""
    r = (
        events(spark, sf)
        .select("event_type", F.floor(F.col("event_id") / 100).alias("page"), "event_id")
        .groupBy("event_type")
        .agg(
            F.countDistinct("page").alias("pages"),
            F.countDistinct("event_id").alias("ids"),
            (F.max("page") + 1).alias("stated_pages"),
            (F.count("*") + F.length("event_type")).alias("stated_rows"),
        )
    )
    drift = F.col("stated_rows") - F.col("ids")
    return r.select("*", drift.alias("drift"), ((F.col("pages") == F.col("stated_pages")) & (F.abs(drift) <= 5)).alias("complete"))


@query(
    "response_strip",
    f"""WITH b AS (SELECT {DAY} AS day FROM events WHERE event_type = 'error' GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
    SELECT row_number() OVER (ORDER BY {DAY}, event_id) AS place, event_id, CASE WHEN event_type <> 'error' THEN 'other' WHEN {DAY} = (SELECT day FROM b) THEN 'busiest' ELSE 'closure' END AS kind FROM events""",
)
def response_strip(spark, sf):
    """Every row in order, its class, and the busiest day of the closing class marked."""
    e = events(spark, sf).select("event_id", "event_type", "day")
    busiest = (
        e.where("event_type = 'error'").groupBy("day").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "day").limit(1).select("day", F.lit(True).alias("b"))
    )
    p = scans.global_position(e, "day", "event_id", "place")
    kind = F.when(F.col("event_type") != "error", "other").when(F.col("b"), "busiest").otherwise("closure")
    return p.join(busiest, "day", "left").select("place", "event_id", kind.alias("kind"))


CLAIM_SQL = f"""{OB}, m AS (SELECT party, count(*) AS n, count(*) FILTER (WHERE answered IS NULL) AS u FROM ob GROUP BY party),
  s AS (SELECT party AS id, n, u, CASE WHEN party % 10 = 3 THEN n + 1 ELSE n END AS said_n, n - u AS answered, round(100 * u / n, 1) AS share FROM m)"""


@query(
    "claims_check",
    f"""WITH {CLAIM_SQL} SELECT id, 0 AS claim, 1 AS figure, CASE WHEN id % 10 = 3 THEN 'moved' ELSE 'agrees' END AS outcome FROM s
    UNION ALL SELECT id, 0, 2, 'agrees' FROM s UNION ALL SELECT id, 1, 1, CASE WHEN id % 10 = 4 THEN 'not said' ELSE 'agrees' END FROM s""",
)
def claims_check(spark, sf):
    """A brief per party, written with its figures, against the metrics they come from."""
    m = obligations(spark, sf).groupBy(F.col("party").alias("id")).agg(
        F.count("*").alias("n"), F.count_if(F.col("answered").isNull()).alias("u")
    )
    share = F.lit(100) * F.col("u") / F.col("n")
    printed = F.format_string("%.2f", share)
    said = F.when(F.col("id") % 10 == 3, F.col("n") + 1).otherwise(F.col("n"))
    text = F.concat(
        F.lit("The register lists "), said.cast("string"), F.lit(" reports,\nof which "), (F.col("n") - F.col("u")).cast("string"), F.lit(" are answered. "),
        F.when(F.col("id") % 10 == 4, "Nothing is late.").otherwise(F.concat(F.lit("In all, "), printed, F.lit(" per cent are not."))),
    )
    briefs = m.withColumn("text", text)
    return gates.claims(
        briefs,
        [
            ("lists {} reports, of which {} are answered", [F.col("n"), F.col("n") - F.col("u")]),
            ("In all, {} per cent", [share]),
        ],
    ).select("id", "claim", "figure", "outcome")
