"""Rows the queries share, derived from the given tables, and the SQL that derives the same.

``obligations``   one row per order: tabled on its date, answered by the first shipment on or
                  after it; earlier shipments are answers that precede their report.
``answers``       one response document per order, written from its own columns in the wording
                  real responses use, with one labelled item per ``o_orderkey % 6 + 1``.
``registers``     two registers of titles taken from the orders still open in each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from duebook.sources import load

PERIODS = (
    ("first", "1995-01-01", "1996-07-01"),
    ("second", "1996-07-01", "1998-01-01"),
    ("third", "1998-01-01", "2000-01-01"),
    ("fourth", "2000-01-01", "2099-01-01"),
)
TODAY = "2002-01-01"
PERIODS_SQL = "(VALUES " + ", ".join(
    f"('{n}', DATE '{a}', DATE '{b}')" for n, a, b in PERIODS
) + ") AS p(period, starts, ends)"


def periods(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(PERIODS), "period string, starts string, ends string").select(
        "period", F.to_date("starts").alias("starts"), F.to_date("ends").alias("ends")
    )


def obligations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their answers.

    The shipments of an order shrink to its set of distinct days before anything
    is shuffled, so a hot order costs no more than the calendar it spans.
    """
    days = (
        load(spark, sf_dir, "lineitem")
        .select("l_orderkey", F.to_date("l_shipdate").alias("day"))
        .groupBy("l_orderkey")
        .agg(F.array_sort(F.collect_set("day")).alias("days"))
    )
    after = F.filter("days", lambda d: d >= F.col("tabled"))
    return (
        load(spark, sf_dir, "orders")
        .select(
            F.col("o_orderkey").alias("id"),
            F.col("o_custkey").alias("party"),
            F.col("o_orderpriority").alias("body"),
            F.col("o_orderstatus").alias("status"),
            F.to_date("o_orderdate").alias("tabled"),
        )
        .join(days, F.col("id") == F.col("l_orderkey"), "left")
        .select(
            "id",
            "party",
            "body",
            "status",
            "tabled",
            F.get(after, F.lit(0)).alias("answered"),
            F.array_max(after).alias("last_answer"),
            F.coalesce(F.get("days", F.lit(0)) < F.col("tabled"), F.lit(False)).alias("early"),
            F.coalesce(F.size("days"), F.lit(0)).alias("answer_days"),
        )
    )


OB = """ob AS (
  SELECT o_orderkey AS id, any_value(o_custkey) AS party, any_value(o_orderpriority) AS body,
         any_value(o_orderstatus) AS status, any_value(CAST(o_orderdate AS DATE)) AS tabled,
         min(CAST(l_shipdate AS DATE)) FILTER (WHERE l_shipdate >= o_orderdate) AS answered,
         max(CAST(l_shipdate AS DATE)) FILTER (WHERE l_shipdate >= o_orderdate) AS last_answer,
         coalesce(bool_or(l_shipdate < o_orderdate), false) AS early,
         count(DISTINCT l_shipdate) AS answer_days
  FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey),
clock AS (
  SELECT *, CAST(tabled + INTERVAL 3 MONTH AS DATE) - tabled AS allowed, answered - tabled AS waited FROM ob)"""


def clocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Obligations with days allowed and days waited."""
    from duebook.functions import dates

    return obligations(spark, sf_dir).select(
        "*",
        dates.deadline_days(F.col("tabled")).alias("allowed"),
        F.datediff("answered", "tabled").alias("waited"),
    )


# --- response documents -----------------------------------------------------------------------

FORMS = 15
_ASKED = "The committee recommends that the Australian Government fund program {p} for {i} further years and report to the parliament"
_SAID = {
    0: "The Government accepts this recommendation. Work is under way.",
    1: "Supported in principle. The Government will consult the states and territories.",
    2: "The Government does not support this recommendation.",
    3: "The Government notes this recommendation. The Government will introduce legislation by 1 July 2027.",
    4: "Government response: Given the passage of time since this report was tabled, a substantive Government response is no longer appropriate.",
    5: "",
    6: "Noted. This is a matter for state and territory governments.",
    7: "Agreed in part.",
    8: "The Government has implemented this recommendation. Victorian Government agencies were consulted.",
    9: "The Government does not accept recommendations one and two.",
    10: "Response: The recommendation has been implemented.",
    11: "The Government notes this recommendation and the answer given to recommendation 2 above.",
    13: "The Government notes this recommendation.",
    14: "The Government notes this recommendation.",
}


def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, body, tabled, items, text): one document per order, built within its own row."""
    key, party = F.col("o_orderkey"), F.col("o_custkey")
    items = (key % 6 + 1).cast("int")

    def item(i: Column) -> Column:
        form = (key + party + 5 * i) % FORMS
        said = F.element_at(
            F.array(*[F.lit(_SAID.get(r, "")) for r in range(FORMS)]), (form + 1).cast("int")
        )
        program, nth = party.cast("string"), i.cast("string")
        asked = (
            F.when(
                form == 13,
                F.concat(
                    F.lit("The committee recommends that the G overnment f und program "),
                    program,
                    F.lit(" as a matter of urgency now"),
                ),
            )
            .when(
                form == 14,
                F.concat(
                    F.lit("Funding of program "),
                    program,
                    F.lit(" was considered at length by members in the course of hearings"),
                ),
            )
            .otherwise(
                F.concat(
                    F.lit("The committee recommends that the Australian Government fund program "),
                    program,
                    F.lit(" for "),
                    nth,
                    F.lit(" further years and report to the parliament"),
                )
            )
        )
        return F.concat(
            F.lit("Recommendation "),
            nth,
            F.when(form == 12, "\nSupported\n").otherwise("\n"),
            asked,
            F.lit(".\n"),
            said,
            F.lit("\n"),
        )

    contents = F.when(
        key % 4 == 0, "Summary\nRecommendation 1 ........ 4\nRecommendation 2 ........ 5\n\n"
    ).otherwise("")
    dissent = F.when(
        (key % 5 == 0) & (items >= 2),
        F.concat(
            F.lit("Dissenting report\nRecommendation 1\nThe Australian Greens recommend that the Australian Government double the funding of program "),
            party.cast("string"),
            F.lit(" without any delay.\n"),
        ),
    ).otherwise("")
    return load(spark, sf_dir, "orders").select(
        key.alias("doc_id"),
        F.col("o_orderpriority").alias("body"),
        F.to_date("o_orderdate").alias("tabled"),
        items.alias("items"),
        F.concat(
            F.lit("Government response to the "),
            F.col("o_orderpriority"),
            F.lit(" Committee report\n\n"),
            contents,
            F.array_join(F.transform(F.sequence(F.lit(1), items), item), ""),
            dissent,
        ).alias("text"),
    )


# What the extractor must find in those documents, stated from the columns, never from the text.
FOUND = """item AS (
  SELECT o_orderkey AS doc_id, o_custkey AS p, CAST(i AS BIGINT) AS i, (o_orderkey + o_custkey + 5 * i) % 15 AS r,
         o_orderkey % 6 + 1 AS k, (o_orderkey % 5 = 0 AND o_orderkey % 6 + 1 >= 2) AS dissents,
         CAST(o_orderdate AS DATE) AS tabled, o_orderpriority AS body
  FROM orders, range(1, 7) AS g(i) WHERE i <= o_orderkey % 6 + 1),
body_item AS (
  SELECT *, (dissents AND i = k) AS last_before_dissent, r IN (13, 14) AS refused FROM item),
made AS (
  SELECT doc_id, CAST(i AS VARCHAR) AS label, tabled, body, p, r, i,
         'The committee recommends that the Australian Government fund program ' || p || ' for ' || i
           || ' further years and report to the parliament'
           || CASE WHEN r IN (5, 12) AND last_before_dissent THEN '. Dissenting report' ELSE '' END AS asked,
         CASE r
           WHEN 0 THEN 'The Government accepts this recommendation. Work is under way'
           WHEN 1 THEN 'Supported in principle. The Government will consult the states and territories'
           WHEN 2 THEN 'The Government does not support this recommendation'
           WHEN 3 THEN 'The Government notes this recommendation. The Government will introduce legislation by 1 July 2027'
           WHEN 4 THEN 'Given the passage of time since this report was tabled, a substantive Government response is no longer appropriate'
           WHEN 5 THEN ''
           WHEN 6 THEN 'Noted. This is a matter for state and territory governments'
           WHEN 7 THEN 'Agreed in part'
           WHEN 8 THEN 'The Government has implemented this recommendation. Victorian Government agencies were consulted'
           WHEN 9 THEN 'The Government does not accept recommendations one and two'
           WHEN 10 THEN 'The recommendation has been implemented'
           WHEN 11 THEN 'The Government notes this recommendation and the answer given to'
           WHEN 12 THEN 'Supported' END
         || CASE WHEN last_before_dissent AND r NOT IN (5, 11, 12) THEN '. Dissenting report' ELSE '' END AS said,
         CASE WHEN r IN (5, 12) AND last_before_dissent THEN 'Dissenting report' ELSE '' END AS author,
         r = 12 AS verdict_first
  FROM body_item WHERE NOT refused),
greens AS (
  SELECT b.doc_id, '1' AS label, b.tabled, b.body, b.p, CAST(NULL AS BIGINT) AS r, b.i,
         'The Australian Greens recommend that the Australian Government double the funding of program ' || p || ' without any delay' AS asked,
         '' AS said, 'Australian Greens' AS author, false AS verdict_first
  FROM body_item b WHERE dissents AND i = 1 AND refused),
found AS (SELECT * FROM made UNION ALL SELECT * FROM greens),
judged AS (
  SELECT *,
    CASE WHEN r IS NULL OR author <> '' THEN 'dissent'
         WHEN r IN (0, 1, 2, 7, 8, 10, 12) OR (r = 9 AND i <= 2) THEN 'position'
         WHEN r = 4 THEN 'form letter' WHEN r = 5 THEN 'unreadable' ELSE 'noted' END AS state,
    CASE WHEN r IS NULL OR author <> '' THEN ''
         WHEN r IN (0, 8, 10, 12) THEN 'accepted' WHEN r IN (1, 7) THEN 'in part or in principle'
         WHEN r = 2 OR (r = 9 AND i <= 2) THEN 'not accepted' ELSE '' END AS verdict
  FROM found)"""


# --- two registers of titles ------------------------------------------------------------------

TOPICS = (
    "regional water security",
    "aged care funding",
    "digital identity services",
    "bushfire recovery grants",
    "university research integrity",
    "freight rail corridors",
    "hospital pharmacy pricing",
    "coastal fishing licences",
    "energy market reliability",
    "veterans housing support",
    "cyber crime reporting",
)


def registers(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two officers' registers over the orders: (id, tabled, body, title, ref).

    The first lists orders not marked final, the second orders not marked open; an
    order on both is the same report, tabled some days later, its title worded
    differently.
    """
    o = load(spark, sf_dir, "orders")
    key, party = F.col("o_orderkey"), F.col("o_custkey")
    topic = F.element_at(F.array(*[F.lit(t) for t in TOPICS]), (party % 11 + 1).cast("int"))
    case = F.concat(
        F.lit(" case"), party.cast("string"), F.lit(" site"), (party % 997).cast("string"), F.lit(" plan"), (party % 1009).cast("string")
    )
    tabled = F.to_date("o_orderdate")
    first = o.where(F.col("o_orderstatus") != "F").select(
        key.alias("id"),
        tabled.alias("tabled"),
        F.concat(F.col("o_orderpriority"), F.lit(" Standing Committee")).alias("body"),
        F.concat(F.lit("Inquiry into "), topic, case, F.lit(" matters")).alias("title"),
        F.when(key % 5 == 0, key).alias("ref"),
    )
    second = o.where(F.col("o_orderstatus") != "O").select(
        key.alias("id"),
        F.date_add(tabled, (key % 40).cast("int")).alias("tabled"),
        F.concat(F.lit("Joint "), F.col("o_orderpriority"), F.lit(" Committee")).alias("body"),
        F.when(key % 7 == 0, F.concat(F.lit("Report on "), topic))
        .when(key % 7 == 1, F.concat(F.lit("Report: "), topic, case, F.lit(" second stage review")))
        .otherwise(F.concat(F.lit("Report: "), topic, case))
        .alias("title"),
        F.when(key % 5 == 0, key).alias("ref"),
    )
    return first, second


_TOPIC_SQL = "[" + ", ".join(f"'{t}'" for t in TOPICS) + "][CAST(o_custkey % 11 + 1 AS INT)]"
_CASE_SQL = "' case' || o_custkey || ' site' || (o_custkey % 997) || ' plan' || (o_custkey % 1009)"
REGISTERS = f"""first AS (
  SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS tabled, o_orderpriority || ' Standing Committee' AS body,
         'Inquiry into ' || {_TOPIC_SQL} || {_CASE_SQL} || ' matters' AS title,
         CASE WHEN o_orderkey % 5 = 0 THEN o_orderkey END AS ref
  FROM orders WHERE o_orderstatus <> 'F'),
second AS (
  SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 40 AS INT) AS tabled,
         'Joint ' || o_orderpriority || ' Committee' AS body,
         CASE o_orderkey % 7 WHEN 0 THEN 'Report on ' || {_TOPIC_SQL}
           WHEN 1 THEN 'Report: ' || {_TOPIC_SQL} || {_CASE_SQL} || ' second stage review'
           ELSE 'Report: ' || {_TOPIC_SQL} || {_CASE_SQL} END AS title,
         CASE WHEN o_orderkey % 5 = 0 THEN o_orderkey END AS ref
  FROM orders WHERE o_orderstatus <> 'O')"""


def words_sql(text: str, longer_than: int, noise: list[str] = ()) -> str:
    """SQL for a sorted word set, with its noise words and years removed."""
    drop = ("AND w NOT IN (" + ", ".join(f"'{n}'" for n in noise) + ")") if noise else ""
    return (
        "list_sort(list_distinct(list_filter(string_split_regex(regexp_replace(lower("
        f"{text}), '[^a-z0-9 ]', ' ', 'g'), '\\s+'), lambda w: length(w) > {longer_than} {drop}"
        + (" AND NOT regexp_matches(w, '^(19|20)[0-9][0-9]$')" if noise else "")
        + ")))"
    )
