"""Obligations and their clocks: orders as reports, shipments as responses."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from duebook.functions import dates, text
from duebook.operators import gates, history, merge, scans, status
from duebook.plans.derived import OB, PERIODS_SQL, TODAY, clocks, obligations, periods
from duebook.plans.registry import query
from duebook.sources import load
from duebook.sources.sinks import merge_metrics

TODAY_SQL = f"DATE '{TODAY}'"
EDITIONS = [f"{y}-12-31" for y in range(1995, 2002)]
EDITIONS_SQL = "(VALUES " + ", ".join(f"(DATE '{e}', {i})" for i, e in enumerate(EDITIONS, 1)) + ") AS e(edition, edition_no)"
LAST = "2001-12-31"


def today():
    return F.to_date(F.lit(TODAY))


@query(
    "deadline_days",
    f"""WITH {OB} SELECT allowed, CAST(count(*) AS BIGINT) AS obligations, min(tabled)::VARCHAR AS earliest,
        max(CAST(tabled + INTERVAL 3 MONTH AS DATE))::VARCHAR AS latest_due FROM clock GROUP BY allowed""",
)
def deadline_days(spark, sf):
    o = load(spark, sf, "orders").select(F.to_date("o_orderdate").alias("tabled"))
    return o.groupBy(dates.deadline_days(F.col("tabled")).alias("allowed")).agg(
        F.count("*").alias("obligations"),
        F.min("tabled").alias("earliest"),
        F.max(dates.deadline(F.col("tabled"))).alias("latest_due"),
    )


@query(
    "obligation_clock",
    f"""WITH {OB} SELECT id, tabled::VARCHAR AS tabled, answered::VARCHAR AS answered, allowed, waited,
        last_answer - tabled AS waited_for_last, greatest(0, waited - allowed) AS overdue,
        CASE WHEN answered IS NULL THEN {TODAY_SQL} - tabled END AS outstanding FROM clock""",
)
def obligation_clock(spark, sf):
    c = clocks(spark, sf)
    return c.select(
        "id",
        "tabled",
        "answered",
        "allowed",
        "waited",
        F.datediff("last_answer", "tabled").alias("waited_for_last"),
        dates.overdue_days(F.col("waited"), F.col("allowed")).alias("overdue"),
        F.when(F.col("answered").isNull(), F.datediff(today(), "tabled")).alias("outstanding"),
    )


BUCKET_SQL = """CASE WHEN waited <= allowed THEN 'within the deadline' WHEN waited <= 180 THEN 'to 180 days'
  WHEN waited <= 365 THEN '181 to 365 days' WHEN waited <= 730 THEN '1 to 2 years'
  WHEN waited <= 1826 THEN '2 to 5 years' ELSE 'over 5 years' END"""


@query(
    "duration_buckets",
    f"""WITH {OB}, a AS (SELECT * FROM clock WHERE waited IS NOT NULL)
    SELECT {BUCKET_SQL} AS bucket, count(*) AS responses, count(*) / (SELECT count(*) FROM a) AS share
    FROM a GROUP BY 1""",
)
def duration_buckets(spark, sf):
    c = clocks(spark, sf).where("waited IS NOT NULL")
    per = c.groupBy(dates.duration_bucket(F.col("waited"), F.col("allowed")).alias("bucket")).agg(
        F.count("*").alias("responses")
    )
    # Six rows at most are left for the total.
    return per.withColumn("share", F.col("responses") / F.sum("responses").over(Window.partitionBy()))


HUMAN_SQL = """CASE WHEN floor(d / 365.25) = 0 THEN m || ' month' || CASE WHEN m = 1 THEN '' ELSE 's' END
  WHEN m = 0 THEN y || ' year' || CASE WHEN y = 1 THEN '' ELSE 's' END
  ELSE y || ' year' || CASE WHEN y = 1 THEN '' ELSE 's' END || ', ' || m || ' month' || CASE WHEN m = 1 THEN '' ELSE 's' END END"""


@query(
    "human_duration",
    f"""WITH {OB}, w AS (SELECT DISTINCT coalesce(waited, {TODAY_SQL} - tabled) AS days FROM clock),
    n AS (SELECT days, days::DOUBLE AS d, floor(days / 365.25::DOUBLE)::BIGINT AS y,
      floor((days - floor(days / 365.25::DOUBLE) * 365.25::DOUBLE) / 30.44::DOUBLE)::BIGINT AS m,
      days // 365 AS py, (days % 365) // 30 AS pm FROM w)
    SELECT days, {HUMAN_SQL} AS human,
      CASE WHEN py > 0 AND pm > 0 THEN py || CASE WHEN py = 1 THEN ' year ' ELSE ' years ' END || pm || CASE WHEN pm = 1 THEN ' month' ELSE ' months' END
        WHEN py > 0 THEN py || CASE WHEN py = 1 THEN ' year' ELSE ' years' END
        WHEN pm > 0 THEN pm || CASE WHEN pm = 1 THEN ' month' ELSE ' months' END
        ELSE days || CASE WHEN days = 1 THEN ' day' ELSE ' days' END END AS plain,
      floor(d / 30.44::DOUBLE + 0.5)::BIGINT || CASE WHEN floor(d / 30.44::DOUBLE + 0.5) = 1 THEN ' month' ELSE ' months' END AS months
    FROM n""",
)
def human_duration(spark, sf):
    d = clocks(spark, sf).select(F.coalesce("waited", F.datediff(today(), "tabled")).alias("days")).distinct()
    return d.select(
        "days",
        dates.human_duration(F.col("days")).alias("human"),
        dates.plain_duration(F.col("days")).alias("plain"),
        dates.in_months(F.col("days")).alias("months"),
    )


@query(
    "compliance",
    f"""WITH {OB}, a AS (SELECT * FROM clock WHERE waited IS NOT NULL),
    long AS (SELECT 'by response' AS basis, answered AS day, * FROM a UNION ALL SELECT 'by report', tabled, * FROM a)
    SELECT basis, coalesce(period, 'all') AS period, count(*) AS n, count(*) FILTER (WHERE waited <= allowed) AS on_time,
      count(*) FILTER (WHERE waited <= allowed) / count(*) AS rate, median(waited) AS median_days
    FROM long JOIN {PERIODS_SQL} ON day >= starts AND day < ends GROUP BY GROUPING SETS ((basis), (basis, period))""",
)
def compliance(spark, sf):
    a = (
        clocks(spark, sf)
        .where("waited IS NOT NULL")
        .select(
            "waited",
            "allowed",
            F.explode(
                F.array(
                    F.struct(F.lit("by response").alias("basis"), F.col("answered").alias("day")),
                    F.struct(F.lit("by report").alias("basis"), F.col("tabled").alias("day")),
                )
            ).alias("_b"),
        )
        .groupBy("_b.basis", "_b.day", "waited", "allowed")
        .agg(F.count("*").alias("rows"))
    )
    # The period table is a fixed parameter of a few rows.
    inside = a.join(F.broadcast(periods(spark)), (F.col("day") >= F.col("starts")) & (F.col("day") < F.col("ends")))
    on_time = F.sum(F.when(F.col("waited") <= F.col("allowed"), F.col("rows")).otherwise(0))
    return (
        inside.groupingSets([["basis"], ["basis", "period"]], "basis", "period")
        .agg(
            F.sum("rows").alias("n"),
            on_time.alias("on_time"),
            (on_time / F.sum("rows")).alias("rate"),
            F.percentile("waited", F.lit(0.5), F.col("rows")).alias("median_days"),
        )
        .select("basis", F.coalesce("period", F.lit("all")).alias("period"), "n", "on_time", "rate", "median_days")
    )


@query(
    "period_join",
    f"""WITH {OB} SELECT period, status, count(*) AS obligations, min(id) AS first_id FROM ob
    JOIN {PERIODS_SQL} ON tabled >= starts AND tabled < ends GROUP BY period, status""",
)
def period_join(spark, sf):
    o = load(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"), F.to_date("o_orderdate").alias("tabled")
    )
    inside = o.join(F.broadcast(periods(spark)), (F.col("tabled") >= F.col("starts")) & (F.col("tabled") < F.col("ends")))
    return inside.groupBy("period", "status").agg(F.count("*").alias("obligations"), F.min("id").alias("first_id"))


BACKLOG_SQL = f"""m AS (SELECT last_day(d)::DATE AS as_at FROM generate_series(DATE '1995-01-01', DATE '{LAST}', INTERVAL 1 MONTH) AS g(d)),
  b AS (SELECT as_at, count(id) AS backlog, max(as_at - tabled) AS oldest_days,
      CAST(round_even(median(as_at - tabled), 0) AS INTEGER) AS median_days,
      count(*) FILTER (WHERE as_at - tabled > 365) AS over_1_year, count(*) FILTER (WHERE as_at - tabled > 1826) AS over_5_years
    FROM m LEFT JOIN ob ON tabled <= as_at AND (answered IS NULL OR answered > as_at) GROUP BY as_at)"""


@query(
    "backlog_history",
    f"""WITH {OB}, {BACKLOG_SQL} SELECT as_at::VARCHAR AS as_at, backlog, oldest_days, median_days, over_1_year, over_5_years FROM b""",
)
def backlog_history(spark, sf):
    return history.backlog(spark, obligations(spark, sf), "1995-01-01", LAST)


@query(
    "backlog_peak",
    f"""WITH {OB}, {BACKLOG_SQL} SELECT as_at::VARCHAR AS as_at, backlog FROM b ORDER BY backlog DESC, as_at LIMIT 1""",
)
def backlog_peak(spark, sf):
    return (
        history.backlog(spark, obligations(spark, sf), "1995-01-01", LAST)
        .select("as_at", "backlog")
        .orderBy(F.desc("backlog"), "as_at")
        .limit(1)
    )


@query(
    "observed_vs_reconstructed",
    f"""WITH {OB}, {BACKLOG_SQL}, kept AS (
      SELECT CAST(o_orderdate AS DATE) AS as_at, 'observed' AS basis, count(*) AS backlog FROM orders
      WHERE o_orderstatus = 'P' AND CAST(o_orderdate AS DATE) <> DATE '{LAST}' GROUP BY 1)
    SELECT as_at::VARCHAR AS as_at, 'reconstructed' AS basis, backlog FROM b UNION ALL
    SELECT as_at::VARCHAR, basis, backlog FROM kept UNION ALL
    SELECT '{LAST}', 'observed', backlog FROM b WHERE as_at = DATE '{LAST}'""",
)
def observed_vs_reconstructed(spark, sf):
    """Observed snapshots (here, partly shipped orders counted per day) survive a rebuild;
    reconstructed rows are recomputed and today's snapshot replaces itself."""
    rebuilt = history.backlog(spark, obligations(spark, sf), "1995-01-01", LAST).select("as_at", "backlog")
    held = (
        load(spark, sf, "orders")
        .where("o_orderstatus = 'P'")
        .groupBy(F.to_date("o_orderdate").alias("as_at"))
        .agg(F.count("*").alias("backlog"))
    )
    last = F.to_date(F.lit(LAST))
    both = rebuilt.withColumn(
        "basis",
        F.explode(F.when(F.col("as_at") == last, F.array(F.lit("reconstructed"), F.lit("observed"))).otherwise(F.array(F.lit("reconstructed")))),
    )
    return both.select("as_at", "basis", "backlog").unionByName(
        held.where(F.col("as_at") != last).select("as_at", F.lit("observed").alias("basis"), "backlog")
    )


@query(
    "longest_waits",
    f"""WITH {OB} SELECT id, body, tabled::VARCHAR AS tabled, {TODAY_SQL} - tabled AS days FROM ob WHERE answered IS NULL
    ORDER BY days DESC, id LIMIT 25""",
)
def longest_waits(spark, sf):
    return (
        obligations(spark, sf)
        .where("answered IS NULL")
        .select("id", "body", "tabled", F.datediff(today(), "tabled").alias("days"))
        .orderBy(F.desc("days"), "id")
        .limit(25)
    )


@query(
    "clock_asof",
    f"""WITH {OB}, t AS (SELECT o.id, o.tabled + 400 AS resp, CAST(l_shipdate AS DATE) AS d, l_linenumber % 3 <> 0 AS tb
      FROM ob o JOIN lineitem ON l_orderkey = o.id),
    p AS (SELECT id, resp, d FROM t WHERE tb OR id NOT IN (SELECT id FROM t WHERE tb)),
    s AS (SELECT id, resp, min(d) AS first_report, max(d) AS newest, max(d) FILTER (WHERE d <= resp) AS prior FROM p GROUP BY id, resp)
    SELECT id, first_report::VARCHAR AS first_report,
      (CASE WHEN newest > resp AND prior IS NOT NULL THEN prior ELSE newest END)::VARCHAR AS clock_start,
      resp - CASE WHEN newest > resp AND prior IS NOT NULL THEN prior ELSE newest END AS days,
      newest > resp AND prior IS NOT NULL AS later_report FROM s""",
)
def clock_asof(spark, sf):
    """The clock runs from the latest report, unless that post-dates the response.

    Report lines shrink to distinct (order, wording, day) before they are grouped, so
    the list per order is bounded by the calendar.
    """
    lines = (
        load(spark, sf, "lineitem")
        .groupBy(
            F.col("l_orderkey").alias("id"),
        )
        .agg(
            F.collect_set(F.when(F.col("l_linenumber") % 3 != 0, F.to_date("l_shipdate"))).alias("by_tabled"),
            F.collect_set(F.to_date("l_shipdate")).alias("by_any"),
        )
    )
    reports = F.when(F.size("by_tabled") > 0, F.col("by_tabled")).otherwise(F.col("by_any"))
    o = load(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.date_add(F.to_date("o_orderdate"), 400).alias("resp")
    )
    j = lines.select("id", reports.alias("reports")).join(o, "id")
    prior = F.array_max(F.filter("reports", lambda d: d <= F.col("resp")))
    j = j.select(
        "id", "resp", F.array_min("reports").alias("first_report"), F.array_max("reports").alias("newest"), prior.alias("prior")
    )
    later = (F.col("newest") > F.col("resp")) & F.col("prior").isNotNull()
    j = j.withColumn("later_report", later).withColumn(
        "clock_start", F.when(F.col("later_report"), F.col("prior")).otherwise(F.col("newest"))
    )
    return j.select(
        "id", "first_report", "clock_start", F.datediff("resp", "clock_start").alias("days"), "later_report"
    )


@query(
    "first_source_wins",
    """WITH u AS (SELECT o_custkey AS party, CAST(o_orderdate AS DATE) AS tabled, CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'P' THEN 2 ELSE 3 END AS rank, o_orderkey AS id FROM orders)
    SELECT party, tabled::VARCHAR AS tabled, arg_min(rank, rank * 1000000000000 + id) AS rank, arg_min(id, rank * 1000000000000 + id) AS id, count(*) - 1 AS displaced
    FROM u GROUP BY party, tabled""",
)
def first_source_wins(spark, sf):
    rank = F.when(F.col("o_orderstatus") == "O", 1).when(F.col("o_orderstatus") == "P", 2).otherwise(3)
    u = load(spark, sf, "orders").select(
        F.col("o_custkey").alias("party"), F.to_date("o_orderdate").alias("tabled"), rank.alias("rank"), F.col("o_orderkey").alias("id")
    )
    return merge.first_wins(u, ["party", "tabled"], [], ["rank", "id"])


STATUS_CELL_SQL = """schedule AS (
  SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS tabled, o_totalprice,
    CASE o_orderkey % 10 WHEN 0 THEN strftime(o_orderdate + INTERVAL 120 DAY, '%-d.%-m.%y') WHEN 1 THEN '-' WHEN 2 THEN 'Interim' WHEN 3 THEN 'Interim*'
      WHEN 4 THEN 'Executive minute received. Complete response' WHEN 5 THEN 'Recommendation 2 outstanding. Incomplete response'
      WHEN 6 THEN '' WHEN 7 THEN 'Pending advice' WHEN 8 THEN strftime(o_orderdate + INTERVAL 90 DAY, '%-d/%-m/%Y') || '*' ELSE '–' END AS cell,
    CASE WHEN o_orderkey % 11 = 0 THEN '' ELSE 'Report ' || o_custkey || CASE WHEN o_orderkey % 3 = 0 THEN ' interim' ELSE '' END END AS title
  FROM orders)"""


def schedule(spark, sf):
    """Status cells in every shape the first register uses, written from each order."""
    key, day = F.col("o_orderkey"), F.to_date("o_orderdate")
    n = key % 10
    cell = (
        F.when(n == 0, F.date_format(F.date_add(day, 120), "d.M.yy"))
        .when(n == 1, "-")
        .when(n == 2, "Interim")
        .when(n == 3, "Interim*")
        .when(n == 4, "Executive minute received. Complete response")
        .when(n == 5, "Recommendation 2 outstanding. Incomplete response")
        .when(n == 6, "")
        .when(n == 7, "Pending advice")
        .when(n == 8, F.concat(F.date_format(F.date_add(day, 90), "d/M/yyyy"), F.lit("*")))
        .otherwise("–")
    )
    title = F.when(key % 11 == 0, "").otherwise(
        F.concat(F.lit("Report "), F.col("o_custkey").cast("string"), F.when(key % 3 == 0, " interim").otherwise(""))
    )
    return load(spark, sf, "orders").select(key.alias("id"), day.alias("tabled"), cell.alias("cell"), title.alias("title"))


DECODED_SQL = f"""{STATUS_CELL_SQL}, decoded AS (SELECT id, tabled, title, cell,
    CASE id % 10 WHEN 0 THEN tabled + 120 WHEN 8 THEN tabled + 90 END AS received,
    cell LIKE 'Interim%' AS interim, cell LIKE 'Interim*%' AS considered, cell LIKE '%Incomplete response' AS partial, cell LIKE '%Complete response' AS complete,
    concat_ws('; ', CASE WHEN title = '' THEN 'no title in source row' END,
      CASE id % 10 WHEN 6 THEN 'no status recorded in the schedule' WHEN 7 THEN 'unrecognised status Pending advice' END) AS notes
  FROM schedule)"""


@query(
    "decode_status",
    f"WITH {DECODED_SQL} SELECT id, received::VARCHAR AS received, interim, considered, partial, complete, notes FROM decoded",
)
def decode_status(spark, sf):
    d = status.decode(schedule(spark, sf), "cell", "tabled", "title")
    return d.select("id", "received", "interim", "considered", "partial", "complete", "notes")


@query(
    "display_status",
    f"""WITH {DECODED_SQL} SELECT
      CASE WHEN partial THEN 'answered in part' WHEN considered THEN 'being considered' WHEN interim THEN 'interim response' WHEN tabled + 90 < {TODAY_SQL} - 1000 THEN 'overdue' ELSE 'no response' END AS first_register,
      CASE WHEN tabled + 90 < {TODAY_SQL} - 1000 THEN 'overdue' WHEN partial THEN 'answered in part' WHEN considered THEN 'being considered' ELSE 'no response' END AS second_register,
      count(*) AS n FROM decoded GROUP BY ALL""",
)
def display_status(spark, sf):
    d = status.decode(schedule(spark, sf), "cell", "tabled", "title")
    overdue = F.date_add("tabled", 90) < F.date_sub(today(), 1000)
    first = status.display(
        [(F.col("partial"), "answered in part"), (F.col("considered"), "being considered"), (F.col("interim"), "interim response"), (overdue, "overdue")],
        "no response",
    )
    second = status.display(
        [(overdue, "overdue"), (F.col("partial"), "answered in part"), (F.col("considered"), "being considered")], "no response"
    )
    return d.groupBy(first.alias("first_register"), second.alias("second_register")).agg(F.count("*").alias("n"))


@query(
    "edition_counts",
    f"""WITH {OB} SELECT edition::VARCHAR AS edition, count(*) AS listed, count(*) FILTER (WHERE answered <= edition) AS answered,
      count(*) FILTER (WHERE answered IS NULL OR answered > edition) AS outstanding,
      count(*) FILTER (WHERE (answered IS NULL OR answered > edition) AND (id + edition_no) % 4 <> 0) AS being_considered
    FROM ob JOIN {EDITIONS_SQL} ON tabled <= edition AND tabled > edition - 365 GROUP BY edition""",
)
def edition_counts(spark, sf):
    """Status counts per yearly edition; an edition lists the reports of its last 365 days."""
    o = obligations(spark, sf)
    dts = F.array(*[F.struct(F.to_date(F.lit(e)).alias("edition"), F.lit(i).alias("no")) for i, e in enumerate(EDITIONS, 1)])
    listed = F.filter(dts, lambda s: (F.col("tabled") <= s["edition"]) & (F.col("tabled") > F.date_sub(s["edition"], 365)))
    e = o.select("id", "tabled", "answered", F.explode(listed).alias("e"))
    is_open = F.col("answered").isNull() | (F.col("answered") > F.col("e.edition"))
    return e.groupBy(F.col("e.edition").alias("edition")).agg(
        F.count("*").alias("listed"),
        F.count_if(~is_open).alias("answered"),
        F.count_if(is_open).alias("outstanding"),
        F.count_if(is_open & ((F.col("id") + F.col("e.no")) % 4 != 0)).alias("being_considered"),
    )


AT_EDITIONS = f"""listed AS (SELECT ob.*, edition, edition_no FROM ob JOIN {EDITIONS_SQL} ON tabled <= edition AND (answered IS NULL OR answered > edition))"""


@query(
    "edition_snapshot",
    f"""WITH {OB}, {AT_EDITIONS} SELECT edition::VARCHAR AS edition, body, id, tabled::VARCHAR AS tabled, edition - tabled AS days,
      CASE WHEN edition > tabled + INTERVAL 3 MONTH THEN 'overdue' ELSE 'not yet due' END AS status FROM listed""",
)
def edition_snapshot(spark, sf):
    """Edition rows, ready to be written as one partition per edition.

    The nested form (an array of all rows per edition) would gather an edition in
    one task, so the export stays one row per obligation.
    """
    e = history.at_editions(obligations(spark, sf), EDITIONS)
    return e.select(
        "edition",
        "body",
        "id",
        "tabled",
        F.datediff("edition", "tabled").alias("days"),
        F.when(F.col("edition") > dates.deadline(F.col("tabled")), "overdue").otherwise("not yet due").alias("status"),
    )


@query(
    "edition_diff",
    f"""WITH {OB}, {AT_EDITIONS},
    a AS (SELECT DISTINCT tabled, party FROM listed WHERE edition_no = 7), b AS (SELECT DISTINCT tabled, party FROM listed WHERE edition_no = 6)
    SELECT 'joined' AS change, tabled::VARCHAR AS tabled, party FROM (SELECT * FROM a EXCEPT SELECT * FROM b)
    UNION ALL SELECT 'left', tabled::VARCHAR, party FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""",
)
def edition_diff(spark, sf):
    o = obligations(spark, sf)
    now, before = (history.at_editions(o, [e]) for e in (EDITIONS[-1], EDITIONS[-2]))
    return history.edition_changes(now, before, ["tabled", "party"])


@query(
    "status_streaks",
    f"""WITH {OB}, {AT_EDITIONS}, c AS (SELECT DISTINCT id, edition_no FROM listed WHERE (id + edition_no) % 4 <> 0),
    gap AS (SELECT i.id, max(n) AS last_gap FROM (SELECT DISTINCT id FROM c) i, range(0, 8) g(n)
      WHERE n = 0 OR NOT EXISTS (SELECT 1 FROM c WHERE c.id = i.id AND c.edition_no = n) GROUP BY i.id)
    SELECT id, CAST(7 - last_gap AS INTEGER) AS editions_in_a_row, (SELECT edition FROM {EDITIONS_SQL} WHERE edition_no = last_gap + 1)::VARCHAR AS since
    FROM gap WHERE last_gap < 7""",
)
def status_streaks(spark, sf):
    e = history.at_editions(obligations(spark, sf), EDITIONS)
    s = history.streaks(e, ["id"], "edition_no", (F.col("id") + F.col("edition_no")) % 4 != 0, len(EDITIONS))
    since = F.element_at(F.array(*[F.to_date(F.lit(x)) for x in EDITIONS]), F.col("since_no"))
    return s.select("id", F.col("editions_in_a_row").cast("int").alias("editions_in_a_row"), since.alias("since"))


@query(
    "wait_percentile",
    f"""WITH {OB}, a AS (SELECT id, waited FROM clock WHERE waited IS NOT NULL)
    SELECT id, waited, CAST(round_even(100 * (rank() OVER (ORDER BY waited) - 1) / count(*) OVER (), 0) AS BIGINT) AS longer_than FROM a""",
)
def wait_percentile(spark, sf):
    a = clocks(spark, sf).where("waited IS NOT NULL").select("id", "waited")
    ranks = scans.histogram_rank(a, "waited")
    return a.join(ranks, "waited").select(
        "id", "waited", text.percent(F.col("below"), F.col("total")).cast("bigint").alias("longer_than")
    )


YEARS_SQL = f"""years AS (SELECT y FROM range(1994, 2003) g(y)),
  yc AS (SELECT y, count(id) AS responses, count(*) FILTER (WHERE waited <= allowed) AS on_time, count(*) FILTER (WHERE status = 'P') AS partial
    FROM years LEFT JOIN clock ON year(answered) = y GROUP BY y)"""


def year_counts(spark, sf):
    per = (
        clocks(spark, sf)
        .where("answered IS NOT NULL")
        .groupBy(F.year("answered").cast("bigint").alias("y"))
        .agg(
            F.count("*").alias("responses"),
            F.count_if(F.col("waited") <= F.col("allowed")).alias("on_time"),
            F.count_if(F.col("status") == "P").alias("partial"),
        )
    )
    return spark.range(1994, 2003).withColumnRenamed("id", "y").join(per, "y", "left").na.fill(0)


@query("yearly_counts", f"WITH {OB}, {YEARS_SQL} SELECT y, responses, on_time, partial FROM yc")
def yearly_counts(spark, sf):
    return year_counts(spark, sf)


@query(
    "typical_year",
    f"""WITH {OB}, {YEARS_SQL}, u AS (SELECT * FROM yc WHERE y <= 2000 AND responses > 0), r AS (SELECT responses, row_number() OVER (ORDER BY responses) AS n FROM u)
    SELECT (SELECT avg(responses) FROM u) AS mean, (SELECT responses FROM r WHERE n = (SELECT count(*) FROM u) // 2 + 1) AS upper_median,
      min(responses) AS least, max(responses) AS most, count(*) AS years FROM u""",
)
def typical_year(spark, sf):
    """The median is the upper middle of the sorted years; the list is one number per year."""
    u = year_counts(spark, sf).where("y <= 2000 AND responses > 0")
    return u.agg(
        F.avg("responses").alias("mean"),
        F.element_at(F.array_sort(F.collect_list("responses")), F.expr("cast(count(*) div 2 + 1 as int)")).alias("upper_median"),
        F.min("responses").alias("least"),
        F.max("responses").alias("most"),
        F.count("*").alias("years"),
    )


@query(
    "busiest_days",
    f"""WITH {OB}, d AS (SELECT answered AS day, count(*) AS responses, count(*) FILTER (WHERE waited > allowed) AS late FROM clock WHERE answered IS NOT NULL GROUP BY 1)
    SELECT day::VARCHAR AS day, responses, late, CAST(rank() OVER (ORDER BY responses DESC) AS INTEGER) AS place FROM d ORDER BY responses DESC, day LIMIT 5""",
)
def busiest_days(spark, sf):
    d = (
        clocks(spark, sf)
        .where("answered IS NOT NULL")
        .groupBy(F.col("answered").alias("day"))
        .agg(F.count("*").alias("responses"), F.count_if(F.col("waited") > F.col("allowed")).alias("late"))
    )
    # One row per day is left to rank.
    ranked = d.withColumn("place", F.rank().over(Window.orderBy(F.desc("responses"))))
    return ranked.orderBy(F.desc("responses"), "day").limit(5)


GATE_SQL = f"""v AS (
  SELECT 'response before report' AS rule, id::VARCHAR AS key FROM ob WHERE early
  UNION ALL SELECT 'report date out of range', id::VARCHAR FROM ob WHERE tabled < DATE '1995-02-01' OR tabled > DATE '2001-06-30'
  UNION ALL SELECT 'response date out of range', id::VARCHAR FROM ob WHERE answered > DATE '2001-06-30'
  UNION ALL SELECT 'missing date without a note', id::VARCHAR FROM ob WHERE answered IS NULL AND answer_days = 0
  UNION ALL SELECT 'missing dates above budget', (SELECT count(*) FROM ob WHERE answered IS NULL) || '/' || (SELECT count(*) FROM ob) WHERE (SELECT count(*) FROM ob WHERE answered IS NULL) > 0.03 * (SELECT count(*) FROM ob)
  UNION ALL SELECT 'duplicate row', min(id)::VARCHAR FROM ob GROUP BY party, body, tabled, answered HAVING count(*) > 1
  UNION ALL SELECT 'duplicate split differently', min(id)::VARCHAR FROM ob WHERE answered IS NOT NULL GROUP BY tabled, answered, party HAVING count(*) > 1
  UNION ALL SELECT 'rows differ from stated total', status || ': ' || n || ' read, ' || s || ' stated'
    FROM (SELECT status, count(*) AS n, count(*) FILTER (WHERE answer_days > 0) AS s FROM ob GROUP BY status) WHERE n <> s)"""


@query("gate_register", f"WITH {OB}, {GATE_SQL} SELECT rule, key FROM v")
def gate_register(spark, sf):
    o = obligations(spark, sf)
    lo, hi = F.to_date(F.lit("1995-02-01")), F.to_date(F.lit("2001-06-30"))
    stated = o.groupBy("status").agg(F.count_if(F.col("answer_days") > 0).alias("stated"))
    return gates.together(
        [
            gates.violations(
                o,
                {
                    "response before report": F.col("early"),
                    "report date out of range": ~F.col("tabled").between(lo, hi),
                    "response date out of range": F.col("answered") > hi,
                    "missing date without a note": F.col("answered").isNull() & (F.col("answer_days") == 0),
                },
                F.col("id"),
            ),
            gates.budget(o, "missing dates above budget", F.col("answered").isNull(), 0.03),
            gates.duplicates(o, "duplicate row", ["party", "body", "tabled", "answered"], F.col("id")),
            gates.duplicates(
                o.where("answered IS NOT NULL"), "duplicate split differently", ["tabled", "answered", "party"], F.col("id")
            ),
            gates.stated_totals(o, stated, "status", "rows differ from stated total"),
        ]
    )


@query(
    "tally_reconcile",
    f"""WITH {OB}, t AS (SELECT body, count(*) FILTER (WHERE answered IS NULL) AS outstanding, count(*) FILTER (WHERE answered IS NOT NULL) AS answered,
        count(*) FILTER (WHERE answered IS NOT NULL AND early) AS out_of_period,
        count(*) FILTER (WHERE answered IS NULL OR early) AS stated_outstanding, count(*) FILTER (WHERE answered IS NOT NULL AND NOT early) AS stated_answered
      FROM ob GROUP BY body)
    SELECT *, CASE WHEN outstanding = stated_outstanding AND answered = stated_answered THEN 'agree'
      WHEN outstanding + out_of_period = stated_outstanding AND answered - out_of_period = stated_answered THEN 'agree once explained'
      ELSE 'does not reconcile' END AS outcome FROM t""",
)
def tally_reconcile(spark, sf):
    """Parsed counts against the register's own tally, which books early answers as awaiting;
    where the tally has no answered part, the explained difference must close it."""
    o = obligations(spark, sf)
    got = F.col("answered").isNotNull()
    t = o.groupBy("body").agg(
        F.count_if(~got).alias("outstanding"),
        F.count_if(got).alias("answered"),
        F.count_if(got & F.col("early")).alias("out_of_period"),
        F.count_if(~got | F.col("early")).alias("stated_outstanding"),
        F.count_if(got & ~F.col("early")).alias("stated_answered"),
    )
    agree = (F.col("outstanding") == F.col("stated_outstanding")) & (F.col("answered") == F.col("stated_answered"))
    explained = (F.col("outstanding") + F.col("out_of_period") == F.col("stated_outstanding")) & (
        F.col("answered") - F.col("out_of_period") == F.col("stated_answered")
    )
    return t.withColumn(
        "outcome", F.when(agree, "agree").when(explained, "agree once explained").otherwise("does not reconcile")
    )


@query(
    "primary_fallback_union",
    """WITH p AS (SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS tabled FROM orders WHERE o_orderstatus = 'O'),
    f AS (SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS tabled FROM orders WHERE o_orderstatus <> 'O')
    SELECT id, tabled::VARCHAR AS tabled, 'primary' AS source FROM p UNION ALL SELECT id, tabled::VARCHAR, 'fallback' FROM f WHERE tabled > DATE '1999-06-30'""",
)
def primary_fallback_union(spark, sf):
    o = load(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.to_date("o_orderdate").alias("tabled"), F.col("o_orderstatus").alias("s")
    )
    return merge.union_fallback(o.where("s = 'O'").drop("s"), o.where("s <> 'O'").drop("s"), "1999-06-30", "tabled")


@query(
    "placeholder_upsert",
    """WITH h AS (SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS class FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01'),
    f AS (SELECT DISTINCT l_orderkey AS id, 'read ' || (l_orderkey % 3) AS class FROM lineitem WHERE l_shipdate >= TIMESTAMP '1999-01-01')
    SELECT coalesce(h.id, f.id) AS id, CASE WHEN h.id IS NULL OR (h.class IS NULL AND f.id IS NOT NULL) THEN f.class ELSE h.class END AS class,
      CASE WHEN h.id IS NULL THEN 'new' WHEN h.class IS NULL AND f.id IS NOT NULL THEN 'filled' ELSE 'held' END AS action
    FROM h FULL JOIN f ON h.id = f.id""",
)
def placeholder_upsert(spark, sf):
    held = (
        load(spark, sf, "orders")
        .where(F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp_ntz"))
        .select(F.col("o_orderkey").alias("id"), F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority")).alias("class"))
    )
    fresh = (
        load(spark, sf, "lineitem")
        .where(F.col("l_shipdate") >= F.lit("1999-01-01").cast("timestamp_ntz"))
        .select(F.col("l_orderkey").alias("id"))
        .distinct()
        .withColumn("class", F.concat(F.lit("read "), (F.col("id") % 3).cast("string")))
    )
    return merge.upsert(held, fresh, "id", ["class"], F.col("h.class").isNull())


@query(
    "new_gone",
    """WITH h AS (SELECT DISTINCT l_orderkey AS id FROM lineitem WHERE l_returnflag <> 'A'), s AS (SELECT DISTINCT l_orderkey AS id FROM lineitem WHERE l_returnflag <> 'N')
    SELECT coalesce(h.id, s.id) AS id, CASE WHEN h.id IS NULL THEN 'new' WHEN s.id IS NULL THEN 'gone' ELSE 'held' END AS fate FROM h FULL JOIN s ON h.id = s.id""",
)
def new_gone(spark, sf):
    l = load(spark, sf, "lineitem").select(F.col("l_orderkey").alias("id"), "l_returnflag")
    return merge.new_and_gone(l.where("l_returnflag <> 'A'"), l.where("l_returnflag <> 'N'"), "id")


META = {
    "rows": "count(*)",
    "overdue": "count_if(answered is null and date_add(tabled, allowed) < date'{t}')",
    "outstanding": "count_if(answered is null)",
    "partial": "count_if(status = 'P' and answered is null)",
    "joint": "count_if(body like '%SPECIFIED%')",
}


@query(
    "register_meta",
    f"""WITH {OB} SELECT count(*) AS rows, count(*) FILTER (WHERE answered IS NULL AND tabled + CAST(allowed AS INT) < {TODAY_SQL}) AS overdue,
      count(*) FILTER (WHERE answered IS NULL) AS outstanding, count(*) FILTER (WHERE status = 'P' AND answered IS NULL) AS partial,
      count(*) FILTER (WHERE body LIKE '%SPECIFIED%') AS joint FROM clock""",
)
def register_meta(spark, sf):
    return clocks(spark, sf).agg(*[F.expr(e.format(t=TODAY)).alias(k) for k, e in META.items()])


@query(
    "metrics_merge",
    f"""WITH {OB}, c AS (SELECT body AS register, unnest(['rows', 'outstanding']) AS key, unnest([count(*), count(*) FILTER (WHERE answered IS NULL)]) AS value FROM ob GROUP BY body),
    h AS (SELECT o_orderpriority AS register, unnest(['rows', 'customers']) AS key, unnest([CAST(0 AS BIGINT), count(DISTINCT o_custkey)]) AS value FROM orders GROUP BY 1)
    SELECT coalesce(c.register, h.register) AS register, coalesce(c.key, h.key) AS key, coalesce(c.value, h.value) AS value,
      CASE WHEN c.value IS NOT NULL THEN 'computed' ELSE 'held' END AS origin FROM h FULL JOIN c ON h.register = c.register AND h.key = c.key""",
)
def metrics_merge(spark, sf):
    """Each step owns some keys of the metrics table; the others' keys stay."""

    def long(df, **values):
        return df.select(
            F.col("body").alias("register"),
            F.explode(F.array(*[F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in values.items()])).alias("m"),
        ).select("register", "m.key", "m.value")

    o = obligations(spark, sf)
    now = o.groupBy("body").agg(F.count("*").alias("n"), F.count_if(F.col("answered").isNull()).alias("u"))
    held = (
        load(spark, sf, "orders")
        .groupBy(F.col("o_orderpriority").alias("body"))
        .agg(F.countDistinct("o_custkey").alias("c"))
    )
    return merge_metrics(
        long(held, rows=F.lit(0).cast("bigint"), customers=F.col("c")),
        long(now, rows=F.col("n"), outstanding=F.col("u")),
        ["register", "key"],
        "value",
    )


@query(
    "semi_live_rows",
    """SELECT o_orderkey AS id, o_orderstatus AS status FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')""",
)
def semi_live_rows(spark, sf):
    live = load(spark, sf, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return (
        load(spark, sf, "orders")
        .join(live, "o_orderkey", "left_semi")
        .select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"))
    )


@query(
    "distinct_union_count",
    f"""WITH {OB}, a AS (SELECT id, answered IS NULL AS od FROM ob WHERE status <> 'F'), b AS (SELECT id, answered IS NULL AS od FROM ob WHERE status <> 'O')
    SELECT (SELECT count(*) FROM a) AS first_register, (SELECT count(*) FROM b) AS second_register, (SELECT count(*) FROM a JOIN b USING (id)) AS on_both,
      (SELECT count(DISTINCT id) FROM (SELECT id FROM a UNION ALL SELECT id FROM b)) AS distinct_reports,
      (SELECT count(DISTINCT id) FROM (SELECT id FROM a WHERE od UNION ALL SELECT id FROM b WHERE od)) AS distinct_open""",
)
def distinct_union_count(spark, sf):
    """Two registers are never added: A + B less those on both, from one row per report."""
    o = obligations(spark, sf)
    a, b = F.col("status") != "F", F.col("status") != "O"
    is_open = F.col("answered").isNull()
    c = o.agg(
        F.count_if(a).alias("first_register"),
        F.count_if(b).alias("second_register"),
        F.count_if(a & b).alias("on_both"),
        F.count_if(a & is_open).alias("_a"),
        F.count_if(b & is_open).alias("_b"),
        F.count_if(a & b & is_open).alias("_ab"),
    )
    return c.select(
        "first_register",
        "second_register",
        "on_both",
        (F.col("first_register") + F.col("second_register") - F.col("on_both")).alias("distinct_reports"),
        (F.col("_a") + F.col("_b") - F.col("_ab")).alias("distinct_open"),
    )


@query(
    "share_without_subset",
    f"""WITH {OB}, r AS (SELECT *, party % 6 = 0 AS bill FROM clock WHERE waited IS NOT NULL)
    SELECT body, count(*) AS n, count(*) FILTER (WHERE waited <= allowed) AS on_time, count(*) FILTER (WHERE NOT bill) AS n_without,
      count(*) FILTER (WHERE NOT bill AND waited <= allowed) AS on_time_without,
      count(*) FILTER (WHERE NOT bill AND waited <= allowed) / count(*) FILTER (WHERE NOT bill) AS share_without FROM r GROUP BY body""",
)
def share_without_subset(spark, sf):
    c = clocks(spark, sf).where("waited IS NOT NULL")
    ok, bill = F.col("waited") <= F.col("allowed"), F.col("party") % 6 == 0
    return c.groupBy("body").agg(
        F.count("*").alias("n"),
        F.count_if(ok).alias("on_time"),
        F.count_if(~bill).alias("n_without"),
        F.count_if(~bill & ok).alias("on_time_without"),
        F.try_divide(F.count_if(~bill & ok), F.count_if(~bill)).alias("share_without"),
    )


@query(
    "collection_rollup",
    f"""WITH {OB} SELECT party, count(*) AS reports, min(tabled)::VARCHAR AS first_tabled, max(answered)::VARCHAR AS last_answer, count(answered) AS found,
      count(*) FILTER (WHERE answer_days > 0) AS stated, max(coalesce(answered, {TODAY_SQL}) - tabled) AS longest, min(id) AS first_report FROM ob GROUP BY party""",
)
def collection_rollup(spark, sf):
    """One row per collection. Its reports are summarised; the list itself stays a table."""
    o = obligations(spark, sf)
    return o.groupBy("party").agg(
        F.count("*").alias("reports"),
        F.min("tabled").alias("first_tabled"),
        F.max("answered").alias("last_answer"),
        F.count("answered").alias("found"),
        F.count_if(F.col("answer_days") > 0).alias("stated"),
        F.max(F.datediff(F.coalesce("answered", today()), "tabled")).alias("longest"),
        F.min("id").alias("first_report"),
    )


@query(
    "register_view",
    f"""WITH {OB} SELECT id, body, status, {TODAY_SQL} - tabled AS days FROM ob WHERE answered IS NULL AND lower(body) LIKE '%high%' AND status <> 'F'""",
)
def register_view(spark, sf):
    """A reader's view of the register: terms contained, all rows, with what it sorts by."""
    o = obligations(spark, sf).where("answered IS NULL")
    terms = ["high"]
    for t in terms:
        o = o.where(F.lower("body").contains(t))
    return (
        o.where("status <> 'F'")
        .select("id", "body", "status", F.datediff(today(), "tabled").alias("days"))
    )


@query(
    "referential_faults",
    """SELECT 'seed without register row' AS rule, o_orderkey::VARCHAR AS key FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
    UNION ALL SELECT 'party not registered', c_custkey::VARCHAR FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)
    UNION ALL SELECT 'both held and rejected', l_orderkey::VARCHAR FROM lineitem WHERE l_returnflag = 'A' AND l_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') GROUP BY l_orderkey""",
)
def referential_faults(spark, sf):
    o, l, c = (load(spark, sf, t) for t in ("orders", "lineitem", "customer"))

    def fault(rule, df, key):
        return df.select(F.lit(rule).alias("rule"), F.col(key).cast("string").alias("key"))

    lines = l.select(F.col("l_orderkey").alias("o_orderkey"), "l_returnflag")
    rejected = lines.where("l_returnflag = 'R'").select("o_orderkey")
    return gates.together(
        [
            fault("seed without register row", o.join(lines, "o_orderkey", "left_anti"), "o_orderkey"),
            fault("party not registered", c.join(o, c.c_custkey == o.o_custkey, "left_anti"), "c_custkey"),
            fault(
                "both held and rejected",
                lines.where("l_returnflag = 'A'").select("o_orderkey").distinct().join(rejected, "o_orderkey", "left_semi"),
                "o_orderkey",
            ),
        ]
    )


@query(
    "partition_reconciles",
    f"""WITH {OB}, c AS (SELECT CASE WHEN answered IS NOT NULL THEN 'answered' WHEN early THEN 'answered before the report' WHEN answer_days = 0 THEN 'nothing received' ELSE 'unclassified' END AS class, body FROM ob)
    SELECT body, count(*) FILTER (WHERE class = 'answered') AS answered, count(*) FILTER (WHERE class = 'answered before the report') AS answered_before,
      count(*) FILTER (WHERE class = 'nothing received') AS nothing, count(*) AS total,
      count(*) FILTER (WHERE class <> 'unclassified') = count(*) AS adds_up FROM c GROUP BY body""",
)
def partition_reconciles(spark, sf):
    o = obligations(spark, sf)
    answered = F.col("answered").isNotNull()
    before = ~answered & F.col("early")
    nothing = ~answered & ~F.col("early") & (F.col("answer_days") == 0)
    t = o.groupBy("body").agg(
        F.count_if(answered).alias("answered"),
        F.count_if(before).alias("answered_before"),
        F.count_if(nothing).alias("nothing"),
        F.count("*").alias("total"),
    )
    return t.withColumn("adds_up", F.col("answered") + F.col("answered_before") + F.col("nothing") == F.col("total"))


@query(
    "gate_monotonic",
    """SELECT 'orders' AS "table", (SELECT count(*) FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01') AS before, (SELECT count(*) FROM orders) AS after, 'ok' AS verdict
    UNION ALL SELECT 'lineitem', (SELECT count(*) FROM lineitem), (SELECT count(*) FROM lineitem WHERE l_returnflag <> 'A'), 'shrank'""",
)
def gate_monotonic(spark, sf):
    o, l = load(spark, sf, "orders"), load(spark, sf, "lineitem")
    earlier = o.where(F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp_ntz"))
    return gates.not_shrunk(earlier, o, "orders").unionByName(
        gates.not_shrunk(l, l.where("l_returnflag <> 'A'"), "lineitem")
    )


@query(
    "gate_publish",
    f"""WITH {OB}, n AS (SELECT count(*) AS n, count(*) FILTER (WHERE status IS NULL OR status = '') AS blank, count(*) FILTER (WHERE status IN ('O', 'F', 'P')) AS classed,
        count(answered) AS answered, count(*) FILTER (WHERE answered IS NULL) AS open, count(*) FILTER (WHERE early) AS early FROM ob)
    SELECT 'every response is classified' AS rule, blank = 0 AS holds, blank::VARCHAR AS detail FROM n
    UNION ALL SELECT 'classes add up', classed = n, classed || '/' || n FROM n
    UNION ALL SELECT 'register has a minimum of rows', open >= 10, open::VARCHAR FROM n
    UNION ALL SELECT 'removals counted and listed alike', answered + open = n, answered::VARCHAR FROM n
    UNION ALL SELECT 'no response precedes its report', early = 0, early::VARCHAR FROM n""",
)
def gate_publish(spark, sf):
    """Every publishing rule over one pass of totals."""
    n = obligations(spark, sf).agg(
        F.count("*").alias("n"),
        F.count_if(F.col("status").isNull() | (F.col("status") == "")).alias("blank"),
        F.count_if(F.col("status").isin("O", "F", "P")).alias("classed"),
        F.count("answered").alias("answered"),
        F.count_if(F.col("answered").isNull()).alias("open"),
        F.count_if("early").alias("early"),
    )
    rules = F.array(
        *[
            F.struct(F.lit(r).alias("rule"), h.alias("holds"), d.alias("detail"))
            for r, h, d in (
                ("every response is classified", F.col("blank") == 0, F.col("blank").cast("string")),
                ("classes add up", F.col("classed") == F.col("n"), F.concat_ws("/", F.col("classed").cast("string"), F.col("n").cast("string"))),
                ("register has a minimum of rows", F.col("open") >= 10, F.col("open").cast("string")),
                ("removals counted and listed alike", F.col("answered") + F.col("open") == F.col("n"), F.col("answered").cast("string")),
                ("no response precedes its report", F.col("early") == 0, F.col("early").cast("string")),
            )
        ]
    )
    return n.select(F.explode(rules).alias("r")).select("r.*")


@query(
    "redraw_sample",
    """WITH listed AS (SELECT l_orderkey AS id, min(l_linenumber) AS pos FROM lineitem WHERE l_quantity = 50 GROUP BY l_orderkey)
    SELECT listed.id, pos, o_orderstatus AS status, o_orderkey IS NULL AS gone FROM listed LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus <> 'P') ON o_orderkey = listed.id""",
)
def redraw_sample(spark, sf):
    """A listed sample is drawn again exactly; rows no longer held are marked, so it can be refused."""
    listed = (
        load(spark, sf, "lineitem").where("l_quantity = 50").groupBy(F.col("l_orderkey").alias("id")).agg(F.min("l_linenumber").alias("pos"))
    )
    held = load(spark, sf, "orders").where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"))
    return listed.join(held, "id", "left").select("id", "pos", "status", F.col("status").isNull().alias("gone"))
