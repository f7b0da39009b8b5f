"""What lasts between runs: digests and alerts said once, an alarm with a memory, versioned editions.

Each query makes its runs one after the other in a folder of its own, as a scheduler would over days."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from duebook.operators import gates, history
from duebook.plans.clock import AT_EDITIONS, EDITIONS
from duebook.plans.derived import OB, obligations
from duebook.plans.registry import query
from duebook.sources import load, tables, versions
from duebook.sources.sinks import export_index
from duebook.streaming import increments

DAY = "CAST(ts AS DATE)"
CUT = "2024-01-15"


def runs(spark, items, key, landings, folder):
    """What each landing says that no earlier one did; the last landing comes a second time, as in a replay."""
    said = []
    for k, where in [*enumerate(landings, 1), (len(landings), landings[-1])]:
        fresh, _ = increments.say_new(spark, items.where(where), key, folder, f"r{k}")
        said.append(fresh.withColumn("run", F.lit(k)).withColumn("again", F.lit(len(said) >= len(landings))))
    return reduce(DataFrame.unionByName, said)


@query(
    "digest_runs",
    f"""WITH s AS (SELECT event_id, value, CASE WHEN {DAY} < DATE '{CUT}' THEN 1 ELSE 2 END AS run FROM events)
    SELECT run, false AS again, event_id, value FROM s UNION ALL SELECT run, true, event_id, value FROM s WHERE run = 2""",
)
def digest_runs(spark, sf):
    """Two landings and a replay: the second run says only what is new, the replay what the second said."""
    e = load(spark, sf, "events").select("event_id", "value", F.to_date("ts").alias("day"))
    rows = runs(spark, e, ["event_id"], [f"day < DATE '{CUT}'", "true"], increments.work_folder(spark, "digest"))
    return rows.select("run", "again", "event_id", "value")


@query(
    "candidate_alert",
    """WITH c AS (SELECT o_orderkey AS id, o_orderpriority AS kind, CAST(o_orderdate AS DATE) AS day FROM orders WHERE o_orderstatus = 'P' AND o_orderkey % 5 <> 0),
    s AS (SELECT *, CASE WHEN day < DATE '1996-01-01' THEN 1 WHEN day < DATE '1998-01-01' THEN 2 ELSE 3 END AS run FROM c)
    SELECT run, false AS again, id, kind FROM s UNION ALL SELECT run, true, id, kind FROM s WHERE run = 3""",
)
def candidate_alert(spark, sf):
    """Records that look like ours and that nobody has ruled on, each raised once over three landings."""
    o = load(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("kind"), "o_orderstatus", F.to_date("o_orderdate").alias("day"))
    ruled_on = o.where("id % 5 = 0").select("id")
    c = o.where("o_orderstatus = 'P'").join(ruled_on, "id", "left_anti")
    landings = ["day < DATE '1996-01-01'", "day < DATE '1998-01-01'", "true"]
    return runs(spark, c, ["id"], landings, increments.work_folder(spark, "candidates")).select("run", "again", "id", "kind")


CHECKS, PERIOD = ("2024-01-10", "2024-01-12", "2024-01-20"), 3


def step(n):
    """One run of the alarm in SQL: the newest day so far, what is said, and what is remembered."""
    day, before = CHECKS[n - 1], f"a{n - 1}" if n > 1 else "(SELECT source, CAST(NULL AS DATE) AS raised FROM u)"
    stale = f"(l.last IS NULL OR d.day - l.last >= {PERIOD})"
    return f"""a{n} AS (SELECT b.source, d.day, CAST(d.day - l.last AS INTEGER) AS days,
      CASE WHEN NOT {stale} THEN CASE WHEN b.raised IS NOT NULL THEN 'back' END WHEN b.raised IS NULL THEN 'raised' WHEN d.day - b.raised >= {PERIOD} THEN 'raised again' END AS outcome,
      CASE WHEN NOT {stale} THEN NULL WHEN b.raised IS NULL OR d.day - b.raised >= {PERIOD} THEN d.day ELSE b.raised END AS raised
    FROM {before} b, (SELECT DATE '{day}' AS day) d LEFT JOIN (SELECT user_id || '/' || event_type AS source, max({DAY}) AS last FROM events WHERE {DAY} <= DATE '{day}' GROUP BY 1) l ON l.source = b.source)"""


@query(
    "alarm_memory",
    f"WITH u AS (SELECT DISTINCT user_id || '/' || event_type AS source FROM events), {step(1)}, {step(2)}, {step(3)} "
    + " UNION ALL ".join(f"SELECT source, day::VARCHAR AS day, outcome, days FROM a{n} WHERE outcome IS NOT NULL" for n in (1, 2, 3)),
)
def alarm_memory(spark, sf):
    """Three runs of one stream: raise, stay silent within the period, raise again, say what is back."""
    folder = increments.work_folder(spark, "alarm")
    e = load(spark, sf, "events").select(F.concat_ws("/", "user_id", "event_type").alias("source"), F.to_date("ts").alias("day"))
    sources = e.select("source").distinct()
    before = "1900-01-01"
    for k, day in enumerate(CHECKS):
        seen = e.where((F.col("day") > F.lit(before)) & (F.col("day") <= F.lit(day))).distinct().select("source", F.lit("seen").alias("kind"), "day")
        looks = sources.select("source", F.lit("check").alias("kind"), F.to_date(F.lit(day)).alias("day"))
        seen.unionByName(looks).coalesce(1).write.mode("append").parquet(f"{folder}/landed")
        before = day
        stream = increments.landed(spark, f"{folder}/landed")

        def write(df, batch):
            df.write.mode("overwrite").parquet(increments.batch_path(f"{folder}/said", batch))

        increments.drain(increments.alarm(stream, PERIOD), folder, write, "append")
    return spark.read.parquet(f"{folder}/said").select("source", "day", "outcome", "days")


@query(
    "edition_versions",
    f"""WITH {OB}, {AT_EDITIONS}, v AS (SELECT 1 AS version, edition_no, edition, id FROM listed WHERE edition_no <= 6
      UNION ALL SELECT 2, edition_no, edition, id FROM listed WHERE edition_no <> 6 OR id % 3 <> 0)
    SELECT version, edition::VARCHAR AS edition, count(*) AS rows, CAST(sum(id) AS BIGINT) AS ids FROM v GROUP BY ALL""",
)
def edition_versions(spark, sf):
    """Six editions published, then the seventh with a corrected sixth: both versions can be read."""
    folder = increments.work_folder(spark, "editions")
    e = history.at_editions(obligations(spark, sf), EDITIONS).select("edition", "edition_no", "id", "body")
    versions.publish(e.where("edition_no <= 6"), folder, ["edition"])
    versions.publish(e.where("edition_no = 7 OR (edition_no = 6 AND id % 3 <> 0)"), folder, ["edition"])
    both = [versions.read(spark, folder, v).withColumn("version", F.lit(v)) for v in versions.versions(spark, folder)]
    return reduce(DataFrame.unionByName, both).groupBy("version", "edition").agg(F.count("*").alias("rows"), F.sum("id").alias("ids"))


@query(
    "open_years",
    """WITH y AS (SELECT year(o_orderdate) AS year, count(*) AS n FROM orders GROUP BY 1)
    SELECT year, CASE WHEN year <= 1996 THEN 'held' ELSE 'fresh' END AS origin, year = 1996 AS stale, n AS rows FROM y WHERE year < 2001""",
)
def open_years(spark, sf):
    """Years already held stay, those that can change are read again, and one that does not come is stale."""
    folder = increments.work_folder(spark, "years")
    o = load(spark, sf, "orders").select(F.year("o_orderdate").alias("year"), F.col("o_orderkey").alias("id"))
    years = [r["year"] for r in o.select("year").distinct().orderBy("year").collect()]  # a row a year
    versions.publish(o.where("year <= 1997").withColumn("origin", F.lit("held")), folder, ["year"])
    fetch = lambda todo: o.where(F.col("year").isin(todo) & ~F.col("year").isin(1996) & (F.col("year") < 2001)).withColumn("origin", F.lit("fresh"))
    rows = versions.refresh(spark, folder, "year", years, [1996, 1997], fetch)
    return rows.groupBy("year", "origin", "stale").agg(F.count("*").alias("rows"))


@query(
    "append_once",
    "SELECT 'already appended' AS rule, count(*)::VARCHAR AS key FROM orders WHERE o_orderpriority = '1-URGENT' HAVING count(*) > 0",
)
def append_once(spark, sf):
    """A source whose rows are already there may not be appended again; one that is not there may."""
    o = load(spark, sf, "orders")
    return gates.append_once(o, F.col("o_orderpriority") == "1-URGENT").unionByName(gates.append_once(o, F.col("o_orderpriority") == "not read yet"))


@query(
    "search_index",
    "SELECT o_orderkey::VARCHAR AS i, CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE o_orderpriority END AS t, CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderstatus END AS s FROM orders",
)
def search_index(spark, sf):
    """The index as a reader loads it: short names, blanks for what is not there, one JSON object a line."""
    path = increments.work_folder(spark, "index")
    o = load(spark, sf, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 4 != 0, F.col("o_orderpriority")).alias("title"), F.nullif("o_orderstatus", F.lit("P")).alias("status"))
    export_index(o, {"o_orderkey": "i", "title": "t", "status": "s"}, path)
    return spark.read.schema("i string, t string, s string").json(path)


@query(
    "csv_scan",
    """SELECT o_orderkey AS id, 'a "quoted" title,' || chr(10) || 'of ' || o_orderpriority AS title, CAST(o_orderdate AS DATE)::VARCHAR AS tabled, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_custkey END AS days, CAST(NULL AS VARCHAR) AS absent
    FROM orders""",
)
def csv_scan(spark, sf):
    """Rows written as a spreadsheet writes them, quoted line breaks and all, and read again with their types."""
    path = increments.work_folder(spark, "csv")
    title = F.concat(F.lit('a "quoted" title,\nof '), "o_orderpriority")
    days = F.when(F.col("o_orderkey") % 3 == 0, "n/a").otherwise(F.col("o_custkey").cast("string"))
    o = load(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), title.alias("title"), F.to_date("o_orderdate").alias("tabled"), days.alias("days"))
    o.write.csv(path, header=True, quoteAll=True, escape='"')
    schema = o.select(F.col("id").cast("long"), "title", "tabled", F.col("days").try_cast("long").alias("days"), F.lit(None).cast("date").alias("absent")).schema
    return tables.read_table(spark, path, schema)


@query(
    "typography_sidecar",
    "SELECT 'Face-' || (o_orderkey % 3) AS font, CAST(10 + o_orderkey % 4 AS DOUBLE) AS size, CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderkey % 100 AS DOUBLE) ELSE -1 END AS down, 'Line of ' || o_custkey AS text FROM orders",
)
def typography_sidecar(spark, sf):
    """Typeset lines from their sidecar files, those that lack the place on the page among them."""
    path = increments.work_folder(spark, "type")
    k = F.col("o_orderkey")
    down = F.when(k % 2 == 0, F.concat((k % 100).cast("string"), F.lit("\t"))).otherwise("")
    line = F.concat(F.lit("Face-"), (k % 3).cast("string"), F.lit("\t"), (F.lit(10) + k % 4).cast("string"), F.lit("\t"), down, F.lit("Line of "), F.col("o_custkey").cast("string"))
    load(spark, sf, "orders").select(line.alias("value")).write.text(path)
    return tables.read_typography(spark, path).select("font", "size", "down", "text")
