"""Line-based queries: pages, register entries, conversations as ordered rows, typeset lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from duebook.functions import wording
from duebook.operators import lines
from duebook.plans.registry import query
from duebook.plans.scalars import both
from duebook.sources import load
from duebook.sources.tables import parse_lines

MARKED_SQL = r"""s AS (SELECT page_id, regexp_replace(html, '(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->', '', 'g') AS t FROM pages),
m AS (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(t, '<h1[^>]*>', chr(2) || 'h' || chr(3), 'g'), '<li[^>]*>', chr(2) || 'li' || chr(3), 'g'), '<p(?: [^>]*)?>', chr(2) || 'p' || chr(3), 'g'),
   '</(?:h[1-6]|li|p|ul|ol|div|article|nav|body)\s*>', chr(2) || '-' || chr(3), 'g'), '<br[^>]*>', chr(4), 'g') AS t FROM s),
b AS (SELECT page_id, string_split(regexp_replace(t, '<[^>]*>', ' ', 'g'), chr(2)) AS bs FROM m),
u AS (SELECT page_id, i - 1 AS block_no, bs[i] AS b FROM b, range(2, 5000) AS g(i) WHERE i <= len(bs)),
p AS (SELECT page_id, block_no, split_part(b, chr(3), 1) AS kind, string_split(split_part(b, chr(3), 2), chr(4)) AS ts FROM u),
l AS (SELECT page_id, kind, block_no, j, regexp_replace(regexp_replace(ts[j], '\s+', ' ', 'g'), '^\s+|\s+$', '', 'g') AS text FROM p, range(1, 500) AS h(j) WHERE j <= len(ts) AND kind <> '-'),
marked AS (SELECT page_id, kind, block_no * 100000 + j - 1 AS line_no, text FROM l WHERE text <> '')"""


@query(
    "html_to_marked_lines",
    f"WITH {MARKED_SQL} SELECT page_id, line_no, kind, text FROM marked",
)
def html_to_marked_lines(spark, sf):
    return lines.marked_lines(load(spark, sf, "pages"), "page_id", "html")


@query(
    "json_links_explode",
    r"""SELECT page_id, CAST(i AS INTEGER) AS place, regexp_extract_all(html, '<a href="([^"]*)"', 1)[i + 1] AS href FROM pages, range(0, 1000) AS g(i) WHERE i < len(regexp_extract_all(html, '<a href="([^"]*)"', 1))
    UNION ALL SELECT page_id, NULL, NULL FROM pages WHERE len(regexp_extract_all(html, '<a href="([^"]*)"', 1)) = 0""",
)
def json_links_explode(spark, sf):
    """A landed payload holds its links beside the document; documents without links stay."""
    found = F.regexp_extract_all("html", F.lit(r'<a href="([^"]*)"'), F.lit(1))
    payload = load(spark, sf, "pages").select(
        F.to_json(
            F.struct(
                F.struct(F.col("page_id").alias("id"), "url").alias("document"),
                F.transform(found, lambda h, i: F.struct(i.alias("place"), h.alias("href"))).alias("links"),
            )
        ).alias("value")
    )
    schema = "document struct<id: bigint, documentId: bigint, url: string>, links array<struct<place: int, href: string>>"
    d = payload.select(F.from_json("value", schema).alias("d"))
    return d.select(
        F.coalesce("d.document.id", "d.document.documentId").alias("page_id"), F.explode_outer("d.links").alias("l")
    ).select("page_id", "l.place", "l.href")


# A register page per order: a heading, then an entry in one of the forms registers use.
def register_lines(spark, sf):
    entry = r"""CASE o_orderkey % 7
      WHEN 0 THEN 'Funding of case ' || o_custkey || '—Report presented ' || LONG(d30) || ', tabled ' || LONG(d) || '\nInterim response tabled ' || LONG(d60) || '\nResponse tabled ' || LONG(d90)
      WHEN 1 THEN 'Funding of case ' || o_custkey || '—Report tabled ' || LONG(d) || '\nReport presented ' || LONG(d60) || ', tabled ' || LONG(d90)
      WHEN 2 THEN 'Review of case ' || o_custkey || '\nReaponse tabled ' || LONG(d60)
      WHEN 3 THEN 'Report tbled ' || LONG(d) || '\nResponse tabled soon'
      WHEN 4 THEN 'Schedule ' || o_custkey || '—Tabled by the President of the Senate ' || LONG(d) || '\nInterim response tabled ' || LONG(d60) || '\nInterim response tabled ' || LONG(d90)
      WHEN 5 THEN 'First ' || o_custkey || '—Report presented ' || LONG(d) || '\nSecond ' || o_custkey || '—Reports tabled ' || LONG(d30) || ' and ' || LONG(d) || '\nResponse tabled ' || LONG(d90)
      ELSE 'Previous page\n## 41st Parliament\nLate report ' || o_custkey || '—Report tabled 31 June 1999\nNext page' END"""
    o = load(spark, sf, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_orderpriority",
        *[F.date_add(F.to_date("o_orderdate"), n).alias("d" if n == 0 else f"d{n}") for n in (0, 30, 60, 90)],
    )
    body = F.concat(F.lit("## "), F.col("o_orderpriority"), F.lit("\n\n"), F.expr(both(entry)[0]))
    return o.select(F.col("o_orderkey").alias("page"), F.posexplode(F.split(body, "\n")).alias("line_no", "text"))


@query(
    "register_entries",
    """WITH o AS (SELECT o_orderkey AS page, o_custkey AS c, o_orderpriority AS body, o_orderkey % 7 AS f, CAST(o_orderdate AS DATE) AS d FROM orders),
    e AS (SELECT page, body, 2 AS line_no, CASE f WHEN 0 THEN 'Funding of case ' || c WHEN 1 THEN 'Funding of case ' || c WHEN 2 THEN 'Review of case ' || c WHEN 3 THEN '' WHEN 4 THEN 'Schedule ' || c WHEN 5 THEN 'First ' || c END AS title,
        CASE f WHEN 2 THEN NULL ELSE d END AS first_report, CASE f WHEN 2 THEN NULL ELSE d END AS last_report, CASE f WHEN 0 THEN d + 90 WHEN 1 THEN d + 90 WHEN 2 THEN d + 60 WHEN 4 THEN d + 60 END AS answered,
        f = 4 AS interim_only, CASE f WHEN 2 THEN 'report date not recorded in register' WHEN 1 THEN 'response line written as a report line' WHEN 3 THEN 'unparsed response line' WHEN 5 THEN 'presented date used (no tabled date)' ELSE '' END AS notes FROM o WHERE f < 6
      UNION ALL SELECT page, body, 3, 'Second ' || c, d, d + 30, d + 90, false, '' FROM o WHERE f = 5
      UNION ALL SELECT page, body, 4, 'Late report ' || c, NULL, NULL, NULL, false, 'no report date parsed' FROM o WHERE f = 6)
    SELECT page, body, line_no, title, first_report::VARCHAR AS first_report, last_report::VARCHAR AS last_report, answered::VARCHAR AS answered, interim_only, notes FROM e""",
)
def register_entries(spark, sf):
    return lines.register_entries(register_lines(spark, sf))


@query(
    "merge_runs",
    """WITH t AS (SELECT conv_id, turn, role = 'assistant' AS a, length(text) AS n FROM conversations),
    r AS (SELECT *, coalesce(sum(CAST(a AS INT)) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS run FROM t)
    SELECT conv_id, CAST(run AS BIGINT) AS run, count(*) AS items, min(n) AS first, max(n) AS last, bool_or(a) AS answered, min(turn) AS from_position, max(turn) AS to_position FROM r GROUP BY conv_id, run""",
)
def merge_runs(spark, sf):
    c = load(spark, sf, "conversations").withColumn("n", F.length("text").cast("bigint"))
    return lines.merge_runs(c, ["conv_id"], "turn", F.col("role") == "assistant", "n", "n")


@query(
    "fold_continuations",
    """WITH t AS (SELECT conv_id, turn, regexp_replace(CASE WHEN turn % 3 = 0 THEN text || '—' ELSE text END, '^\\s+|\\s+$', '', 'g') AS t, role <> 'assistant' AS s FROM conversations),
    i AS (SELECT *, sum(CAST(s AS INT)) OVER (PARTITION BY conv_id ORDER BY turn) AS island FROM t),
    j AS (SELECT *, lag(t) OVER (PARTITION BY conv_id, island ORDER BY turn) AS above FROM i)
    SELECT conv_id, min(turn) AS turn, count(*) AS rows, string_agg(CASE WHEN above IS NULL OR regexp_matches(above, '[—–-]$') THEN t ELSE ' ' || t END, '' ORDER BY turn) AS text FROM j GROUP BY conv_id, island""",
)
def fold_continuations(spark, sf):
    c = load(spark, sf, "conversations").select(
        "conv_id", "turn", "role", F.when(F.col("turn") % 3 == 0, F.concat("text", F.lit("—"))).otherwise(F.col("text")).alias("text")
    )
    return lines.fold_continuations(c, ["conv_id"], "turn", "text", F.col("role") != "assistant")


@query(
    "block_pairs",
    """SELECT a.conv_id, a.turn, md5(a.text) AS asked, CASE WHEN b.role = 'assistant' THEN md5(b.text) END AS said, coalesce(b.role = 'assistant', false) AS paired
    FROM conversations a LEFT JOIN conversations b ON b.conv_id = a.conv_id AND b.turn = a.turn + 1 WHERE a.role <> 'assistant'""",
)
def block_pairs(spark, sf):
    c = load(spark, sf, "conversations").select("conv_id", "turn", "role", F.md5("text").alias("h"))
    p = lines.block_pairs(c, ["conv_id"], "turn", F.col("role") == "assistant", ["h"])
    return p.select("conv_id", "turn", F.col("h").alias("asked"), F.col("next_h").alias("said"), "paired")


TRACKER = """CASE e % 5 WHEN 0 THEN DASHES(d) || ' ~ ' || t || ' ~ matter ' || u WHEN 1 THEN '  ' || DASHES(d) || ' ~ ' || t || ' ~ matter ' || u || ' ~ two '
  WHEN 2 THEN DASHES(d) || ' ' || t WHEN 3 THEN '31-02-2024 ~ ' || t || ' ~ matter' ELSE DASHES(d) || ' ~ ' || t || ' ~ ' END"""


@query(
    "parse_lines_with_rejects",
    """WITH l AS (SELECT event_id AS e, CAST(ts AS DATE) AS d, event_type AS t, user_id AS u FROM events),
    o AS (SELECT e, u, t, d, CASE WHEN e % 5 IN (2, 3, 4) THEN 'malformed' WHEN d > DATE '2024-01-10' THEN 'kept' ELSE 'before the cut-off' END AS outcome FROM l)
    SELECT outcome, count(*) AS lines, min(CASE WHEN outcome <> 'malformed' THEN d END)::VARCHAR AS first, count(DISTINCT CASE WHEN outcome <> 'malformed' THEN t END) AS bodies,
      count(*) FILTER (WHERE outcome <> 'malformed' AND e % 5 = 1) AS titled_two FROM o GROUP BY outcome""",
)
def parse_lines_with_rejects(spark, sf):
    e = load(spark, sf, "events").select(
        F.col("event_id").alias("e"), F.to_date("ts").alias("d"), F.col("event_type").alias("t"), F.col("user_id").alias("u")
    )
    raw = e.select(F.expr(TRACKER.replace("DASHES(d)", "date_format(d, 'dd-MM-yyyy')")).alias("value"))
    p = parse_lines(raw, F.to_date(F.lit("2024-01-10")))
    good = F.col("outcome") != "malformed"
    return p.groupBy("outcome").agg(
        F.count("*").alias("lines"),
        F.min("tabled").alias("first"),
        F.countDistinct(F.when(good, F.col("body"))).alias("bodies"),
        F.count_if(good & F.col("title").endswith("~ two")).alias("titled_two"),
    )


# --- typeset lines: every document line set in a face and size that depend on its place --------

TYPE_SQL = r"""raw AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents),
typeset AS (SELECT doc_id, i - 1 AS line_no, CASE (i - 1) % 6 WHEN 0 THEN 'Bold' WHEN 1 THEN 'Bold' WHEN 2 THEN 'Bold' ELSE 'Plain' END AS font,
   CASE (i - 1) % 6 WHEN 0 THEN 16.0 WHEN 1 THEN 16.0 WHEN 2 THEN 11.0 WHEN 5 THEN 8.0 ELSE 10.0 END AS size,
   CASE (i - 1) % 6 WHEN 2 THEN 'Recommendation ' || ((i - 1) // 6 + 1) ELSE ls[i] END AS text FROM raw, range(1, 4000) AS g(i) WHERE i <= len(ls))"""


def typeset(spark, sf):
    l = load(spark, sf, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "t"))
    k = F.col("line_no") % 6
    return l.select(
        "doc_id",
        "line_no",
        F.when(k < 3, "Bold").otherwise("Plain").alias("font"),
        F.when(k < 2, 16.0).when(k == 2, 11.0).when(k == 5, 8.0).otherwise(10.0).alias("size"),
        F.when(k == 5, 90.0).otherwise(50.0).alias("down"),
        F.when(k == 2, F.concat(F.lit("Recommendation "), F.floor(F.col("line_no") / 6 + 1).cast("string"))).otherwise(F.col("t")).alias("text"),
    )


@query(
    "typographic_headings",
    f"""WITH {TYPE_SQL}, h AS (SELECT *, font = 'Bold' AND size > 11 AND trim(text) <> '' AND NOT regexp_matches(text, '^[ \\t]*Recommendation[ \\t]+[0-9]') AS h FROM typeset WHERE doc_id IN (SELECT doc_id FROM typeset WHERE regexp_matches(text, '^[ \\t]*Recommendation[ \\t]+[0-9]'))),
    i AS (SELECT *, sum(CASE WHEN h THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY line_no) AS island FROM h)
    SELECT doc_id, min(line_no) AS line_no, string_agg(trim(text), ' ' ORDER BY line_no) AS heading, count(*) AS lines FROM i WHERE h GROUP BY doc_id, island""",
)
def typographic_headings(spark, sf):
    return lines.headings(typeset(spark, sf))


@query(
    "small_type_lines",
    f"""WITH {TYPE_SQL}, l AS (SELECT doc_id, size, trim(text) AS line FROM typeset WHERE trim(text) <> ''), c AS (SELECT doc_id, size, count(*) AS n FROM l GROUP BY ALL),
    b AS (SELECT doc_id, arg_max(size, n * 100 - size) AS body FROM c GROUP BY doc_id)
    SELECT DISTINCT l.doc_id, line FROM l JOIN b ON l.doc_id = b.doc_id AND size < body WHERE (l.doc_id, line) NOT IN (SELECT (l.doc_id, line) FROM l JOIN b ON l.doc_id = b.doc_id AND size >= body)""",
)
def small_type_lines(spark, sf):
    return lines.small_type(typeset(spark, sf))


BLOCK = r"""'Response to Recommendations ' || CASE o_orderkey % 3 WHEN 0 THEN '4.1–4.3' WHEN 1 THEN '7.8 and 7.10' ELSE '' || (o_custkey % 90 + 1) END
  || '\nResponsibility: ' || CASE WHEN o_orderkey % 2 = 0 THEN 'Commonwealth' ELSE 'Commonwealth and state governments' END
  || CASE o_orderkey % 5 WHEN 0 THEN '\nResponse: Accept' WHEN 1 THEN '\nAustralian Government response: Accept in principle\nACT and WA: Note' WHEN 2 THEN '\nJoint response: Subject to\nfurther consideration'
       WHEN 3 THEN '\nCommonwealth: Accept\nCommonwealth (part b): Note' ELSE '\nNSW: Accept' END
  || '\nThe program for case ' || o_custkey || ' continues.\n' || 'Work is under way.\n' || 'Response to Recommendation 99\nResponsibility: Commonwealth\nResponse: Not accepted\nThis is closed.'"""


@query(
    "answer_blocks",
    """WITH o AS (SELECT o_orderkey AS doc_id, o_custkey AS c, o_orderkey % 5 AS f, CASE o_orderkey % 3 WHEN 0 THEN ['4.1', '4.2', '4.3'] WHEN 1 THEN ['7.8', '7.10'] ELSE [(o_custkey % 90 + 1)::VARCHAR] END AS labels,
      CASE WHEN o_orderkey % 2 = 0 THEN 'Commonwealth' ELSE 'Commonwealth and state governments' END AS responsible FROM orders)
    SELECT doc_id, unnest(labels) AS label, responsible, CASE f WHEN 0 THEN 'Accept' WHEN 1 THEN 'Accept in principle' WHEN 2 THEN 'Subject to further consideration' WHEN 3 THEN 'Accept; Note' ELSE '' END AS own,
      CASE f WHEN 1 THEN 'ACT and WA: Note' WHEN 4 THEN 'NSW: Accept' ELSE '' END AS others, CASE f WHEN 0 THEN 'position' WHEN 1 THEN 'position' WHEN 3 THEN 'position' ELSE 'noted' END AS state,
      CASE f WHEN 0 THEN 'accepted' WHEN 1 THEN 'in part or in principle' WHEN 3 THEN 'in part or in principle' ELSE '' END AS verdict, 'The program for case ' || c || ' continues. Work is under way.' AS words FROM o
    UNION ALL SELECT doc_id, '99', 'Commonwealth', 'Not accepted', '', 'position', 'not accepted', 'This is closed.' FROM o""",
)
def answer_blocks(spark, sf):
    docs = load(spark, sf, "orders").select(F.col("o_orderkey").alias("doc_id"), F.expr(BLOCK).alias("text"))
    b = lines.block_verdicts(lines.answer_blocks(docs), lambda said: wording.verdict(said, F.lit("")))
    return b.select(
        "doc_id", "label", "responsible", F.array_join("own", "; ").alias("own"), "others", "state", "verdict", "words"
    )
