"""Scalar readings, on strings written from the rows of the tables.

``both`` turns one expression into Spark's and DuckDB's spelling, so that both read the
same strings; what must be found in them is stated case by case in the SQL.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from duebook.functions import dates, numbering, text, tokens, wording
from duebook.operators import coverage, status
from duebook.plans.derived import words_sql
from duebook.plans.registry import query
from duebook.sources import load

import re


def both(expr: str) -> tuple[str, str]:
    """LONG(d), DOTS(d), DOTS2(d), SLASH(d): date spellings; the rest is common SQL."""
    forms = {
        "LONG": ("date_format({0}, 'd MMMM yyyy')", "strftime({0}, '%-d %B %Y')"),
        "DOTS2": ("date_format({0}, 'd.M.yy')", "strftime({0}, '%-d.%-m.%y')"),
        "DOTS": ("date_format({0}, 'd.M.yyyy')", "strftime({0}, '%-d.%-m.%Y')"),
        "SLASH": ("date_format({0}, 'd/M/yyyy')", "strftime({0}, '%-d/%-m/%Y')"),
    }
    spark, duck = expr, expr
    for name, (s, d) in forms.items():
        spark = re.sub(rf"\b{name}\(([^()]*)\)", lambda m: s.format(m.group(1)), spark)
        duck = re.sub(rf"\b{name}\(([^()]*)\)", lambda m: d.format(m.group(1)), duck)
    return spark, duck


def orders(spark, sf, **columns: str):
    o = load(spark, sf, "orders").select(
        F.col("o_orderkey").alias("k"),
        F.col("o_custkey").alias("p"),
        F.col("o_orderpriority").alias("body"),
        F.to_date("o_orderdate").alias("d"),
        F.date_add(F.to_date("o_orderdate"), 30).alias("d30"),
    )
    return o.select("*", *[F.expr(both(e)[0]).alias(n) for n, e in columns.items()])


def orders_sql(**columns: str) -> str:
    cols = "".join(f", {both(e)[1]} AS {n}" for n, e in columns.items())
    return (
        "(SELECT *" + cols + " FROM (SELECT o_orderkey AS k, o_custkey AS p, o_orderpriority AS body, "
        "CAST(o_orderdate AS DATE) AS d, CAST(o_orderdate AS DATE) + 30 AS d30 FROM orders))"
    )


PROSE = """CASE k % 6 WHEN 0 THEN 'Report tabled ' || LONG(d)
  WHEN 1 THEN 'Report presented ' || LONG(d30) || ', tabled  ' || LONG(d)
  WHEN 2 THEN 'Report tbled 31 February 1999 and ' || LONG(d)
  WHEN 3 THEN 'Report tabled: ' || SLASH(d) || ' then 1/13/1999 then ' || SLASH(d30)
  WHEN 4 THEN 'no date is recorded' ELSE 'on 12 Foobar 1999' END"""


@query(
    "parse_dates",
    f"""SELECT k, (CASE k % 6 WHEN 0 THEN d WHEN 1 THEN d30 END)::VARCHAR AS first_long, CASE k % 6 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 1 ELSE 0 END AS long_dates,
    (CASE WHEN k % 6 < 3 THEN d END)::VARCHAR AS earliest, (CASE k % 6 WHEN 0 THEN d WHEN 1 THEN d30 WHEN 2 THEN d END)::VARCHAR AS latest,
    (CASE k % 6 WHEN 3 THEN d END)::VARCHAR AS first_slash, CASE k % 6 WHEN 3 THEN 2 ELSE 0 END AS slash_dates FROM {orders_sql()}""",
)
def parse_dates(spark, sf):
    o, t = orders(spark, sf, t=PROSE), F.col("t")
    o = o.withColumn("found", dates.long_dates(t))
    return o.select(
        "k",
        dates.long_date(t).alias("first_long"),
        F.size("found").alias("long_dates"),
        F.array_min("found").alias("earliest"),
        F.array_max("found").alias("latest"),
        dates.slash_date(t).alias("first_slash"),
        F.size(dates.slash_dates(t)).alias("slash_dates"),
    )


CELL = """CASE k % 4 WHEN 0 THEN DOTS2(d) WHEN 1 THEN DOTS(d) WHEN 2 THEN SLASH(d) || ' * i' ELSE '31.2.' || (k % 100) END"""


@query(
    "two_digit_year",
    f"""SELECT k, c AS cell, (CASE k % 4 WHEN 3 THEN NULL WHEN 0 THEN CASE WHEN year(d) >= 2000 AND year(d) - 2000 < 90 THEN d
        WHEN year(d) < 2000 AND year(d) - 1900 < 90 THEN d + INTERVAL 100 YEAR ELSE d END ELSE d END)::DATE::VARCHAR AS fixed_pivot,
      (CASE k % 4 WHEN 3 THEN NULL WHEN 0 THEN CASE WHEN year(d) % 100 <= 0 + 1 THEN make_date(2000 + year(d) % 100, month(d), day(d)) ELSE make_date(1900 + year(d) % 100, month(d), day(d)) END ELSE d END)::DATE::VARCHAR AS edition_pivot
      FROM {orders_sql(c=CELL)}""",
)
def two_digit_year(spark, sf):
    o, c = orders(spark, sf, c=CELL), F.col("c")
    # The second reading belongs to an edition of 2000: years up to 01 are of this century.
    return o.select(
        "k",
        c.alias("cell"),
        dates.cell_date(c, 90).alias("fixed_pivot"),
        dates.cell_date(c, F.lit(2000 % 100 + 1), inclusive=True).alias("edition_pivot"),
    )


AS_AT = """CASE k % 3 WHEN 0 THEN 'Status of responses As At ' || LONG(d) || ', responses received since ' || LONG(d30)
  WHEN 1 THEN 'Status as at 30 Smarch 2020' ELSE 'Responses received  since ' || LONG(d) END"""


@query(
    "as_at_date",
    f"""SELECT k, (CASE k % 3 WHEN 0 THEN d END)::VARCHAR AS as_at, (CASE k % 3 WHEN 0 THEN d30 END)::VARCHAR AS period_start FROM {orders_sql()}""",
)
def as_at_date(spark, sf):
    o = orders(spark, sf, t=AS_AT)
    return o.select("k", dates.as_at(F.col("t")).alias("as_at"), dates.period_start(F.col("t")).alias("period_start"))


PREFERRED = r"""CASE k % 4 WHEN 0 THEN 'Report presented: ' || SLASH(d) || '\nReport tabled: ' || SLASH(d30)
  WHEN 1 THEN 'Report presented: ' || SLASH(d) WHEN 2 THEN 'Tabled 1/1/1990\nTabled ' || SLASH(d) ELSE 'none' END"""


@query(
    "preferred_date",
    f"""SELECT k, (CASE k % 4 WHEN 0 THEN d30 WHEN 1 THEN d WHEN 2 THEN d END)::VARCHAR AS latest, (CASE k % 4 WHEN 0 THEN d30 WHEN 1 THEN d WHEN 2 THEN DATE '1990-01-01' END)::VARCHAR AS earliest,
    CASE k % 4 WHEN 1 THEN 'presented date used' WHEN 3 THEN 'no date parsed' ELSE 'tabled' END AS basis FROM {orders_sql()}""",
)
def preferred_date(spark, sf):
    o = orders(spark, sf, t=PREFERRED)
    found, basis = dates.preferred_dates(F.col("t"))
    return o.select("k", F.array_max(found).alias("latest"), F.array_min(found).alias("earliest"), basis.alias("basis"))


# --- titles -----------------------------------------------------------------------------------

PART_TITLE = "'Report ' || (p_partkey % 500) || ': Inquiry into the ' || p_name || ' and ' || p_type || ' ' || p_brand || ' measures bill ' || (1990 + p_size)"


def part_titles(spark, sf):
    return load(spark, sf, "part").select(F.col("p_partkey").alias("k"), F.expr(PART_TITLE).alias("title"))


PT = f"(SELECT p_partkey AS k, {PART_TITLE} AS title FROM part)"


@query(
    "token_sets",
    f"""SELECT k, array_to_string({words_sql('title', 3)}, ' ') AS longer_than_3, array_to_string({words_sql('title', 2)}, ' ') AS longer_than_2 FROM {PT}""",
)
def token_sets(spark, sf):
    return part_titles(spark, sf).select(
        "k",
        F.array_join(tokens.word_set(F.col("title"), 3), " ").alias("longer_than_3"),
        F.array_join(tokens.word_set(F.col("title"), 2), " ").alias("longer_than_2"),
    )


@query(
    "distinctive_tokens",
    f"""SELECT k, array_to_string({words_sql('title', 3, tokens.SCHEDULE_TITLE_NOISE)}, ' ') AS schedule_words,
    array_to_string({words_sql('title', 2, tokens.PAIRING_NOISE)}, ' ') AS pairing_words FROM {PT}""",
)
def distinctive_tokens(spark, sf):
    t = F.col("title")
    return part_titles(spark, sf).select(
        "k",
        F.array_join(tokens.distinctive(tokens.word_set(t, 3), tokens.SCHEDULE_TITLE_NOISE), " ").alias("schedule_words"),
        F.array_join(tokens.distinctive(tokens.word_set(t, 2), tokens.PAIRING_NOISE), " ").alias("pairing_words"),
    )


@query(
    "title_similarity",
    f"""WITH t AS (SELECT k, {words_sql('title', 3, tokens.SCHEDULE_TITLE_NOISE)} AS w FROM {PT}),
    j AS (SELECT a.k, len(a.w) AS na, len(b.w) AS nb, len(list_intersect(a.w, b.w)) AS s FROM t a JOIN t b ON b.k = a.k + 1)
    SELECT k, s AS shared, s / least(na, nb) AS containment, s / na AS share_of_left, least(s / na, s / nb) AS lesser FROM j""",
)
def title_similarity(spark, sf):
    t = part_titles(spark, sf).select(
        "k", tokens.distinctive(tokens.word_set(F.col("title"), 3), tokens.SCHEDULE_TITLE_NOISE).alias("w")
    )
    j = t.join(t.select((F.col("k") - 1).alias("k"), F.col("w").alias("v")), "k")
    a, b = F.col("w"), F.col("v")
    return j.select(
        "k",
        tokens.shared(a, b).alias("shared"),
        tokens.containment(a, b).alias("containment"),
        tokens.share_of_left(a, b).alias("share_of_left"),
        tokens.lesser_share(a, b).alias("lesser"),
    )


NUMBERED = """CASE p % 4 WHEN 0 THEN 'Report No. ' || (p % 600) || ': accounts' WHEN 1 THEN 'Report ' || (p % 600) || ' and report no ' || (p % 7)
  WHEN 2 THEN 'Reporting 12 matters' ELSE 'report ' || p || ' of ' || body END"""


@query(
    "report_numbers",
    f"""SELECT k, CASE p % 4 WHEN 0 THEN (p % 600)::VARCHAR WHEN 1 THEN array_to_string(list_sort(list_distinct([(p % 600)::VARCHAR, (p % 7)::VARCHAR])), ',')
     WHEN 2 THEN '' ELSE CASE WHEN p < 10000 THEN p::VARCHAR ELSE '' END END AS numbers,
     CASE p % 4 WHEN 0 THEN p % 600 = p WHEN 1 THEN p % 600 = p AND p % 7 = p WHEN 2 THEN false ELSE p < 10000 END AS names_its_party FROM {orders_sql()}""",
)
def report_numbers(spark, sf):
    n = tokens.numbers(F.col("t"))
    return orders(spark, sf, t=NUMBERED).select(
        "k", F.array_join(n, ",").alias("numbers"), (n == F.array(F.col("p").cast("string"))).alias("names_its_party")
    )


LINE = """CASE k % 5 WHEN 0 THEN 'funding of case ' || p || ' Select Committee on Work ' || (p % 9) WHEN 1 THEN 'bank fees ' || p || ' Economics References Committee'
  WHEN 2 THEN 'access to Parliament House Finance Legislation Committee' WHEN 3 THEN 'water use  Procedure Committee' ELSE 'plain title ' || p END"""


@query(
    "split_title_body",
    f"""SELECT k, CASE k % 5 WHEN 0 THEN 'funding of case ' || p WHEN 1 THEN 'bank fees ' || p WHEN 2 THEN 'access to' WHEN 3 THEN 'water use' ELSE 'plain title ' || p END AS title,
    CASE k % 5 WHEN 0 THEN 'Select Committee on Work ' || (p % 9) WHEN 1 THEN 'Economics References Committee' WHEN 2 THEN 'Parliament House Finance Legislation Committee' WHEN 3 THEN 'Procedure Committee' ELSE '' END AS body FROM {orders_sql()}""",
)
def split_title_body(spark, sf):
    title, body = text.split_title_body(F.col("t"))
    return orders(spark, sf, t=LINE).select("k", title.alias("title"), body.alias("body"))


RESPONSE_TITLE = """CASE k % 7 WHEN 0 THEN 'Australian Government response to the Finance Committee report: Costs of case ' || p || ' [May 2020]'
  WHEN 1 THEN 'Government responses to the Joint Committee on Work inquiry into matter ' || p WHEN 2 THEN 'Government response to the Treasury Laws Amendment Bill ' || p
  WHEN 3 THEN 'Government response to the Public Accounts Committee report Report ' || (p % 500) || ': accounts' WHEN 4 THEN 'Response to the Royal Commission into Work ' || p || ' - report on the future of work (June 2021)'
  WHEN 5 THEN 'Ministerial statement ' || p ELSE 'Response to Senator Smith report – Costs “again”' END"""


@query(
    "body_from_title",
    f"""SELECT k, CASE k % 7 WHEN 0 THEN 'Finance Committee' WHEN 1 THEN 'Joint Committee on Work' WHEN 3 THEN 'Public Accounts Committee'
      WHEN 4 THEN 'Royal Commission into Work ' || p ELSE '' END AS body FROM {orders_sql()}""",
)
def body_from_title(spark, sf):
    return orders(spark, sf, t=RESPONSE_TITLE).select("k", text.body_from_title(F.col("t")).alias("body"))


@query(
    "answered_title",
    f"""SELECT k, CASE k % 7 WHEN 0 THEN 'Costs of case ' || p WHEN 2 THEN 'Treasury Laws Amendment Bill ' || p WHEN 3 THEN 'Report ' || (p % 500) || ': accounts'
      WHEN 4 THEN 'future of work' WHEN 6 THEN 'Costs “again' WHEN 1 THEN '' ELSE '' END AS title FROM {orders_sql()}""",
)
def answered_title(spark, sf):
    return orders(spark, sf, t=RESPONSE_TITLE).select("k", text.answered_title(F.col("t")).alias("title"))


STAGES = (
    "CASE k % 3 WHEN 0 THEN 'Interim report ' || (1990 + p % 4) WHEN 1 THEN 'Final report and second matter' ELSE 'Report ' || (1990 + p % 3) END",
    "CASE p % 3 WHEN 0 THEN 'The interim report ' || (1990 + k % 4) || ' and 1991' WHEN 1 THEN 'Second FINAL report' ELSE 'Report of 1990 and 1992' END",
)


@query(
    "stage_year_agree",
    f"""SELECT k, CASE WHEN k % 3 = 0 AND p % 3 = 0 THEN 1990 + p % 4 IN (1990 + k % 4, 1991) WHEN k % 3 = 1 AND p % 3 = 1 THEN true
      WHEN k % 3 = 2 AND p % 3 = 2 THEN 1990 + p % 3 IN (1990, 1992) ELSE false END AS agree FROM {orders_sql()}""",
)
def stage_year_agree(spark, sf):
    o = orders(spark, sf, a=STAGES[0], b=STAGES[1])
    return o.select("k", tokens.stage_and_year_agree(F.col("a"), F.col("b")).alias("agree"))


FLAG_TITLE = "CASE k % 4 WHEN 0 THEN 'Interim report ' || p WHEN 1 THEN 'Tax Bill ' || p WHEN 2 THEN 'Interims and billing' ELSE 'Bills digest, interim' END"
FLAG_BODY = "CASE p % 4 WHEN 0 THEN 'Joint Committee' WHEN 1 THEN 'PJC on Law' WHEN 2 THEN 'Adjoint Committee' ELSE body END"


@query(
    "title_flags",
    f"""SELECT p % 4 < 2 AS joint, k % 4 IN (0, 3) AS interim_report, k % 4 IN (1, 3) AS bill, count(*) AS n FROM {orders_sql()} GROUP BY ALL""",
)
def title_flags(spark, sf):
    o = orders(spark, sf, title=FLAG_TITLE, b=FLAG_BODY)
    flags = status.title_flags(F.col("title"), F.col("b"))
    return o.groupBy(*[c.alias(n) for n, c in flags.items()]).agg(F.count("*").alias("n"))


# --- cells ------------------------------------------------------------------------------------

GRID = {
    "c1": "CASE WHEN k % 6 = 4 THEN '' ELSE 'Report ' || p END",
    "c2": "CASE WHEN k % 3 = 0 THEN 'part two' ELSE ' ' END",
    "c3": "CASE WHEN k % 6 IN (3, 4) THEN '' ELSE DOTS(d) END",
    "c4": "CASE k % 5 WHEN 0 THEN '' WHEN 1 THEN 'Yes' WHEN 2 THEN 'Interim' ELSE DOTS(d30) END",
    "c5": "CASE WHEN k % 2 = 0 THEN 'No' ELSE '' END",
}


@query(
    "grid_row_decode",
    f"""WITH g AS (SELECT *, list_filter([trim(c1), trim(c2), trim(c3), trim(c4), trim(c5)], lambda c: c <> '') AS f FROM {orders_sql(**GRID)}),
    a AS (SELECT *, list_position(list_transform(f, lambda c: regexp_matches(c, '^[0-9]+[.][0-9]+[.][0-9]+$')), true) AS pos FROM g),
    r AS (SELECT *, coalesce(f[pos + 1], '') AS resp, coalesce(f[pos + 2], '') AS w FROM a)
    SELECT k, CASE WHEN pos > 1 THEN 'record' WHEN len(f) = 1 THEN 'continuation' ELSE 'skipped' END AS kind,
      CASE WHEN pos > 1 THEN array_to_string(f[1:pos - 1], ' ') END AS title, CASE WHEN pos > 1 THEN f[pos] END AS tabled_cell,
      CASE WHEN pos > 1 THEN CASE WHEN resp IN ('Yes', 'No') THEN '' ELSE resp END END AS response,
      CASE WHEN pos > 1 THEN CASE WHEN resp IN ('Yes', 'No') THEN resp ELSE w END END AS within FROM r""",
)
def grid_row_decode(spark, sf):
    o = orders(spark, sf, **GRID)
    rec = status.grid_record(F.array("c1", "c2", "c3", "c4", "c5"))
    return o.select("k", *[c.alias(n) for n, c in rec.items()])


VERDICT_CELL = """CASE k % 7 WHEN 0 THEN SLASH(d) WHEN 1 THEN 'No response to date' WHEN 2 THEN 'Partial response received ' || SLASH(d30) WHEN 3 THEN 'Fully responded'
  WHEN 4 THEN 'Time not expired' WHEN 5 THEN 'Withdrawn' ELSE DOTS2(d30) || ' *' END"""
WITHIN_CELL = "CASE WHEN k % 7 = 4 THEN '' WHEN p % 3 = 0 THEN 'Yes' WHEN p % 3 = 1 THEN 'No' ELSE 'Late' END"


@query(
    "decode_status_verdict",
    f"""WITH o AS {orders_sql()}, r AS (SELECT k, CASE k % 7 WHEN 0 THEN d WHEN 6 THEN d30 END AS received, k % 7 = 2 AS partial, k % 7 = 3 AS complete, k % 7 IN (1, 4) AS nothing,
      CASE WHEN k % 7 = 4 THEN 'Time not expired' WHEN p % 3 = 0 THEN 'Yes' WHEN p % 3 = 1 THEN 'No' ELSE 'Late' END AS verdict FROM o)
    SELECT k, received::VARCHAR AS received, partial, complete, nothing, verdict, (CASE WHEN received < DATE '1997-01-01' THEN received END)::VARCHAR AS out_of_period,
      concat_ws('; ', CASE WHEN received < DATE '1997-01-01' THEN 'response of ' || received || ' predates this reporting period' END,
        CASE WHEN k % 7 = 5 THEN 'unrecognised status Withdrawn' END, CASE WHEN verdict = 'Late' THEN 'unrecognised deadline verdict Late' END) AS notes FROM r""",
)
def decode_status_verdict(spark, sf):
    o = orders(spark, sf, cell=VERDICT_CELL, w=WITHIN_CELL)
    d = status.decode_with_verdict(o, "cell", "w", F.to_date(F.lit("1997-01-01")))
    return d.select("k", "received", "partial", "complete", "nothing", "verdict", "out_of_period", "notes")


SENTENCE = """CASE k % 6 WHEN 0 THEN 'The Government response is Being Considered and was tabled on ' || LONG(d) WHEN 1 THEN 'A full response was tabled on ' || LONG(d)
  WHEN 2 THEN 'Response tabled on ' || LONG(d) WHEN 3 THEN 'Awaiting advice' WHEN 4 THEN '' ELSE 'Interim reply; FULL RESPONSE to follow' END"""


@query(
    "status_buckets",
    f"""SELECT CASE k % 6 WHEN 0 THEN 'considered' WHEN 1 THEN 'full' WHEN 5 THEN 'full' WHEN 2 THEN 'answered' ELSE 'other' END AS bucket, count(*) AS n FROM {orders_sql()} GROUP BY 1""",
)
def status_buckets(spark, sf):
    return orders(spark, sf, t=SENTENCE).groupBy(status.sentence_bucket(F.col("t")).alias("bucket")).agg(F.count("*").alias("n"))


# --- labels -----------------------------------------------------------------------------------

HEADING = """CASE k % 6 WHEN 0 THEN (p % 9) || '.' || (k % 8 + 1) || '–' || (p % 9) || '.' || (k % 8 + 4) WHEN 1 THEN (k % 50) || ' to ' || (k % 50 + 3)
  WHEN 2 THEN '7.2, 7.3, ' || (p % 90) || ' and 7.13' WHEN 3 THEN '6.30 to 7.2' WHEN 4 THEN (p % 99) || '' ELSE (p % 99) || ' and ' || (p % 99) END"""


@query(
    "expand_ranges",
    f"""SELECT k, CASE k % 6 WHEN 0 THEN array_to_string(list_transform(range(k % 8 + 1, k % 8 + 5), lambda n: (p % 9) || '.' || n), ' ')
      WHEN 1 THEN array_to_string(range(k % 50, k % 50 + 4), ' ') WHEN 2 THEN '7.2 7.3 ' || (p % 90) || ' 7.13' WHEN 3 THEN '6.30 7.2' ELSE (p % 99)::VARCHAR END AS labels,
      CASE k % 3 WHEN 0 THEN '1 2' WHEN 1 THEN '3 4 5 6' ELSE '' END AS named FROM {orders_sql()}""",
)
def expand_ranges(spark, sf):
    o = orders(spark, sf, t=HEADING, n="CASE k % 3 WHEN 0 THEN 'one and Two' WHEN 1 THEN '3 to six, and 4' ELSE 'none of them' END")
    return o.select(
        "k",
        F.array_join(numbering.labels_in(F.col("t")), " ").alias("labels"),
        F.array_join(numbering.numbers_in(F.col("n")), " ").alias("named"),
    )


@query(
    "label_order",
    """WITH l AS (SELECT DISTINCT l_orderkey AS doc_id, l_linenumber AS a, l_suppkey % 12 AS b FROM lineitem)
    SELECT doc_id, a || '.' || b AS label, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY a, b) AS INTEGER) AS place FROM l""",
)
def label_order(spark, sf):
    """Labels in numeric order. The set of a document's labels is distinct before it is gathered."""
    l = load(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("doc_id"),
        F.concat_ws(".", F.col("l_linenumber").cast("string"), (F.col("l_suppkey") % 12).cast("string")).alias("label"),
    )
    keyed = l.groupBy("doc_id").agg(F.collect_set(F.struct(numbering.label_key(F.col("label")).alias("key"), "label")).alias("s"))
    return keyed.select("doc_id", F.posexplode(F.array_sort("s")).alias("place", "x")).select(
        "doc_id", "x.label", (F.col("place") + 1).alias("place")
    )


TOTAL = """CASE k % 4 WHEN 0 THEN 'a list of ' || (p % 300) || ' recommendations, a total of ' || (p % 300) || ' recommendations' WHEN 1 THEN 'Total of 12 recommendations; List of ' || (p % 13) || ' recommendations'
  WHEN 2 THEN 'no total of recommendations' ELSE 'the  list  of recommendations, list of 7  recommendations' END"""


@query(
    "stated_total",
    f"""SELECT k, CASE k % 4 WHEN 0 THEN p % 300 WHEN 1 THEN CASE WHEN p % 13 = 12 THEN 12 END WHEN 3 THEN 7 END AS total,
      CASE k % 4 WHEN 1 THEN CASE WHEN p % 13 = 12 THEN '' ELSE 'states more than one total' END WHEN 2 THEN 'states no total' ELSE '' END AS note FROM {orders_sql()}""",
)
def stated_total(spark, sf):
    n, note = numbering.stated_total(F.col("t"))
    return orders(spark, sf, t=TOTAL).select("k", n.alias("total"), note.alias("note"))


SHAPED = r"""CASE k % 5 WHEN 0 THEN 'Recommendation 1.1 Fund it\nRecommendation 1.2: Do it\nRecommendation 3 Stop\n' WHEN 1 THEN ' Recommendation 4 ........ 9\nRecommendation 4 Title\nRecommendation 5 Title\nRecommendation 2.1 was noted'
  WHEN 2 THEN 'Recommendation 1\nRecommendation 2\n Recommendation 2 \nWords' WHEN 3 THEN 'See Recommendation 4 Title\n' || body ELSE 'Recommendation ' || (p % 100 + 100) || ' Widen\nRecommendation 1.1 Fund' END"""


@query(
    "numbering_vote",
    f"""SELECT k, CASE k % 5 WHEN 0 THEN 2 WHEN 4 THEN 1 ELSE 0 END AS by_chapter, CASE k % 5 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 4 THEN 1 ELSE 0 END AS straight, CASE k % 5 WHEN 2 THEN 2 ELSE 0 END AS untitled,
      CASE k % 5 WHEN 0 THEN 'by chapter' WHEN 1 THEN 'straight through' WHEN 2 THEN 'untitled' WHEN 3 THEN 'none' ELSE 'by chapter' END AS shape FROM {orders_sql()}""",
)
def numbering_vote(spark, sf):
    t = F.col("t")
    votes = numbering.shape_votes(t)
    return orders(spark, sf, t=SHAPED).select(
        "k", *[v.alias(n) for v, n in zip(votes, ("by_chapter", "straight", "untitled"))], numbering.shape(t).alias("shape")
    )


# --- quotations -------------------------------------------------------------------------------

ASKED = """CASE k % 7 WHEN 0 THEN 'Wage practices The Government of the The Committee recommends that case ' || p || ' be reviewed' WHEN 1 THEN 'The committee recommends that the The Government fund case ' || p
  WHEN 2 THEN 'The committee recommends a review of case ' || p || ' and then The Department acts' WHEN 3 THEN 'The committee recommends a review of ' || p || ' and the Government has agreed to it'
  WHEN 4 THEN 'The committee recommends a review after the Government has reported on ' || p WHEN 5 THEN 'The committee recommends a review. The Government has reported on ' || p ELSE 'The Government should fund case ' || p END"""


@query(
    "splice_suspect",
    f"""SELECT k, CASE k % 7 WHEN 1 THEN 'two sentences joined after a short word' WHEN 2 THEN 'a new sentence without a stop before it'
      WHEN 3 THEN 'a report of action inside the quoted item' ELSE '' END AS why FROM {orders_sql()}""",
)
def splice_suspect(spark, sf):
    return orders(spark, sf, t=ASKED).select("k", wording.splice_reason(F.col("t")).alias("why"))


@query(
    "layout_suspects",
    f"""WITH f AS (SELECT o_custkey AS doc_id, k, k % 7 IN (1, 2, 3) AS flagged FROM {orders_sql()} JOIN orders ON o_orderkey = k),
    d AS (SELECT doc_id FROM f GROUP BY doc_id HAVING count(*) FILTER (WHERE flagged) >= 3 AND count(*) FILTER (WHERE flagged) >= 0.5 * count(*))
    SELECT doc_id, k, flagged FROM f WHERE doc_id IN (SELECT doc_id FROM d)""",
)
def layout_suspects(spark, sf):
    """All rows of the documents in which half the quotations look read across a column break."""
    rows = orders(spark, sf, t=ASKED).select("k", "t").join(load(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("doc_id")), "k")
    return coverage.suspects(rows, "doc_id", wording.splice_reason(F.col("t")) != "").select("doc_id", "k", "flagged")
