"""Labelled segments and the states of their answers, on response documents written per order."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from duebook.functions import wording
from duebook.operators import coverage, segments
from duebook.operators.fence import staged
from duebook.plans.derived import FOUND, PERIODS_SQL, answers, periods
from duebook.plans.registry import query
from duebook.sources import load


@query(
    "segment_qa",
    f"WITH {FOUND} SELECT doc_id, label, asked, said, author, verdict_first FROM found",
)
def segment_qa(spark, sf):
    found = segments.candidates(answers(spark, sf), "doc_id", "text")
    return segments.best_per_label(found).drop("pos")


@query(
    "segment_refusals",
    f"""WITH {FOUND}, no AS (
      SELECT doc_id, i::VARCHAR AS label, CASE r WHEN 13 THEN 'characters or words are damaged' ELSE 'no wording of a proposal in it' END AS why, true AS answered FROM body_item WHERE refused
      UNION ALL SELECT doc_id, g.l::VARCHAR, 'fewer characters than an item needs', false FROM (SELECT DISTINCT doc_id FROM item WHERE doc_id % 4 = 0), range(1, 3) AS g(l))
    SELECT doc_id, label, why, answered FROM no WHERE NOT EXISTS (SELECT 1 FROM found f WHERE f.doc_id = no.doc_id AND f.label = no.label)""",
)
def segment_refusals(spark, sf):
    found = segments.candidates(answers(spark, sf), "doc_id", "text")
    return segments.refusals(found).select("doc_id", "label", "why", "answered")


@query(
    "best_per_label",
    f"""WITH {FOUND} SELECT author, verdict_first, count(*) AS labels, CAST(sum(length(asked)) AS BIGINT) AS asked_chars, CAST(sum(length(said)) AS BIGINT) AS said_chars FROM found GROUP BY ALL""",
)
def best_per_label(spark, sf):
    best = segments.best_per_label(segments.candidates(answers(spark, sf), "doc_id", "text"))
    return best.groupBy("author", "verdict_first").agg(
        F.count("*").alias("labels"), F.sum(F.length("asked")).alias("asked_chars"), F.sum(F.length("said")).alias("said_chars")
    )


def judged(spark, sf, carry=()):
    return segments.read(answers(spark, sf), "doc_id", "text", carry)


@query(
    "stated_position",
    f"""WITH {FOUND} SELECT doc_id, label, CASE r WHEN 0 THEN 'The Government accepts' WHEN 1 THEN 'Supported in principle' WHEN 2 THEN 'The Government does not support' WHEN 7 THEN 'Agreed in part'
      WHEN 8 THEN 'implemented this recommendation' WHEN 9 THEN 'The Government does not accept' WHEN 10 THEN 'recommendation has been implemented' ELSE 'Supported' END AS "match"
      FROM judged WHERE state = 'position'""",
)
def stated_position(spark, sf):
    return judged(spark, sf).where("match IS NOT NULL AND state = 'position'").select("doc_id", "label", "match")


@query(
    "verdict_three_way",
    f"WITH {FOUND} SELECT doc_id, label, verdict FROM judged WHERE state = 'position'",
)
def verdict_three_way(spark, sf):
    return judged(spark, sf).where("state = 'position'").select("doc_id", "label", "verdict")


# Scope and awaiting are facts of the register: a document of a party in the noted class is
# out of scope, and a document tabled after the register's date has no response yet.
SCOPE_SQL = "CASE WHEN author <> '' THEN 'dissent' WHEN tabled >= DATE '2001-01-01' THEN 'awaiting' WHEN body = '5-LOW' THEN 'out of scope' ELSE state END"


@query(
    "answer_state",
    f"""WITH {FOUND}, g AS (SELECT *, r IS NULL OR author <> '' AS d FROM judged)
    SELECT doc_id, label, CASE WHEN d THEN 'dissent' WHEN tabled >= DATE '2001-01-01' THEN 'awaiting' WHEN body = '5-LOW' THEN 'out of scope' ELSE state END AS state FROM g""",
)
def answer_state(spark, sf):
    s = judged(spark, sf, ("tabled", "body"))
    state = wording.answer_state(
        F.col("author"),
        F.when(F.col("tabled") < F.to_date(F.lit("2001-01-01")), F.col("doc_id")),
        F.col("body") != "5-LOW",
        F.lit("response"),
        F.col("said"),
        F.col("match"),
    )
    return s.select("doc_id", "label", state.alias("state"))


@query(
    "noted_commitments",
    f"WITH {FOUND} SELECT doc_id, label FROM judged WHERE state = 'noted' AND r = 3",
)
def noted_commitments(spark, sf):
    return judged(spark, sf).where((F.col("state") == "noted") & F.col("said").rlike(wording.COMMITMENT)).select("doc_id", "label")


@query(
    "names_jurisdiction",
    f"""WITH {FOUND} SELECT doc_id, label, CASE r WHEN 1 THEN 'states and territories' WHEN 6 THEN 'state and territory' ELSE 'Victorian Government' END AS named FROM judged WHERE r IN (1, 6, 8)""",
)
def names_jurisdiction(spark, sf):
    best = segments.best_per_label(segments.candidates(answers(spark, sf), "doc_id", "text"))
    return best.where(F.col("said").rlike(wording.OTHER_GOVERNMENT)).select(
        "doc_id", "label", F.regexp_extract("said", wording.OTHER_GOVERNMENT, 0).alias("named")
    )


@query("points_elsewhere", f"WITH {FOUND} SELECT doc_id, label FROM judged WHERE r = 6")
def points_elsewhere(spark, sf):
    best = segments.best_per_label(segments.candidates(answers(spark, sf), "doc_id", "text"))
    return best.where(wording.points_elsewhere(F.col("said"))).select("doc_id", "label")


@query(
    "jurisdiction_counts",
    f"""WITH {FOUND} SELECT coalesce(state, 'all') AS state, count(*) AS items, count(*) FILTER (WHERE r IN (1, 6, 8)) AS names_another, count(*) FILTER (WHERE r = 6) AS points_elsewhere
      FROM judged GROUP BY GROUPING SETS ((), (state))""",
)
def jurisdiction_counts(spark, sf):
    j = judged(spark, sf).select(
        "state",
        F.col("said").rlike(wording.OTHER_GOVERNMENT).alias("n"),
        wording.points_elsewhere(F.col("said")).alias("p"),
    )
    return (
        j.groupingSets([[], ["state"]], "state")
        .agg(F.count("*").alias("items"), F.count_if("n").alias("names_another"), F.count_if("p").alias("points_elsewhere"))
        .select(F.coalesce("state", F.lit("all")).alias("state"), "items", "names_another", "points_elsewhere")
    )


@query(
    "done_claims",
    f"""WITH {FOUND} SELECT doc_id, label, CASE r WHEN 8 THEN 'The Government has implemented this recommendation.' ELSE said END AS claim FROM judged
      WHERE r = 8 OR (r = 10 AND said NOT LIKE '%. Dissenting%')
      UNION ALL SELECT doc_id, label, 'The recommendation has been implemented.' FROM judged WHERE r = 10 AND said LIKE '%. Dissenting%'""",
)
def done_claims(spark, sf):
    best = segments.best_per_label(segments.candidates(answers(spark, sf), "doc_id", "text"))
    return staged(best, claim=wording.done_claim(F.col("said"))).where("claim IS NOT NULL").select("doc_id", "label", "claim")


# --- roll-ups ---------------------------------------------------------------------------------

PER_DOC_SQL = """per_doc AS (
  SELECT doc_id, count(*) FILTER (WHERE state IN ('position', 'noted', 'form letter', 'not individual')) AS assessable, count(*) FILTER (WHERE state = 'position') AS stated,
    count(*) FILTER (WHERE verdict = 'accepted') AS accepted, count(*) FILTER (WHERE verdict = 'in part or in principle') AS in_part, count(*) FILTER (WHERE verdict = 'not accepted') AS not_accepted,
    count(*) FILTER (WHERE state = 'noted') AS noted, count(*) FILTER (WHERE state = 'form letter') AS form_letter, count(*) FILTER (WHERE state = 'unreadable') AS unreadable,
    any_value(tabled) AS tabled, any_value(body) AS body
  FROM judged WHERE state <> 'dissent' GROUP BY doc_id)"""


@query(
    "coverage_per_doc",
    f"""WITH {FOUND}, {PER_DOC_SQL} SELECT doc_id, assessable, stated, accepted, in_part, not_accepted, noted, form_letter, unreadable,
      CASE WHEN assessable > 0 THEN round_even(stated / assessable, 4) END AS coverage FROM per_doc""",
)
def coverage_per_doc(spark, sf):
    return coverage.per_document(judged(spark, sf)).drop("not_individual")


@query(
    "coverage_grouping_sets",
    f"""WITH {FOUND}, {PER_DOC_SQL}, d AS (SELECT *, year(tabled) AS y FROM per_doc JOIN {PERIODS_SQL} ON tabled >= starts AND tabled < ends)
    SELECT CASE WHEN y IS NOT NULL THEN 'year' WHEN period IS NOT NULL THEN 'period' WHEN body IS NOT NULL THEN 'class' ELSE 'total' END AS level, coalesce(y::VARCHAR, period, body, 'all') AS value,
      count(*) AS responses, count(*) FILTER (WHERE assessable > 0 AND stated = 0) AS none_stated, count(*) FILTER (WHERE assessable > 0 AND stated = assessable) AS fully_covered,
      CAST(sum(assessable) AS BIGINT) AS assessable, CAST(sum(stated) AS BIGINT) AS stated, CAST(sum(accepted) AS BIGINT) AS accepted, CAST(sum(in_part) AS BIGINT) AS in_part,
      CAST(sum(not_accepted) AS BIGINT) AS not_accepted, CASE WHEN sum(assessable) > 0 THEN round_even(sum(stated) / sum(assessable), 4) END AS coverage
    FROM d GROUP BY GROUPING SETS ((), (y), (period), (body))""",
)
def coverage_grouping_sets(spark, sf):
    carry = ("tabled", "body")
    d = coverage.per_document(judged(spark, sf, carry), carry)
    # The period table is a fixed parameter of a few rows.
    d = d.join(F.broadcast(periods(spark)), (F.col("tabled") >= F.col("starts")) & (F.col("tabled") < F.col("ends")))
    return coverage.rollup(d.withColumn("y", F.year("tabled").cast("string")), {"year": "y", "period": "period", "class": "body"})


@query(
    "label_tally",
    f"""WITH {FOUND} SELECT label, verdict, count(*) AS n FROM judged WHERE state = 'position' GROUP BY ALL""",
)
def label_tally(spark, sf):
    return judged(spark, sf).where("state = 'position'").groupBy("label", "verdict").agg(F.count("*").alias("n"))


@query(
    "join_positions",
    f"""WITH {FOUND.replace("found AS (", "found AS MATERIALIZED (")}, pos AS MATERIALIZED (SELECT doc_id, label, state, verdict FROM judged WHERE state <> 'unreadable')
    SELECT f.doc_id, f.label, f.author, coalesce(state, 'no position row') AS state, coalesce(verdict, '') AS verdict FROM found f LEFT JOIN pos USING (doc_id, label)""",
)
def join_positions(spark, sf):
    """Segments with the position row of the same composite key, where there is one."""
    best = segments.best_per_label(segments.candidates(answers(spark, sf), "doc_id", "text"))
    pos = segments.judge(best).where("state <> 'unreadable'").select("doc_id", "label", "state", "verdict")
    return best.select("doc_id", "label", "author").join(pos, ["doc_id", "label"], "left").na.fill(
        {"state": "no position row", "verdict": ""}
    )


@query(
    "position_checks",
    f"""WITH {FOUND}, t AS (SELECT *, CASE r WHEN 9 THEN '' ELSE '' END AS others FROM judged WHERE state = 'position')
    SELECT doc_id, label, verdict, CASE WHEN r IN (8) THEN strpos(said, 'implemented') - 1 WHEN r = 10 THEN strpos(said, 'recommendation') - 1 ELSE 0 END AS distance,
      '' AS names_others, '' AS why FROM t""",
)
def position_checks(spark, sf):
    return coverage.position_checks(judged(spark, sf)).select("doc_id", "label", "verdict", "distance", "names_others", "why")


@query(
    "sibling_runon",
    f"""WITH {FOUND}, o AS (SELECT doc_id, label, substr(asked, 1, 60) AS opening FROM found WHERE length(asked) >= 60), w AS (SELECT doc_id, label, said || ' ' || coalesce(lead(asked) OVER (PARTITION BY doc_id ORDER BY CAST(label AS INT)), '') AS said FROM found)
    SELECT w.doc_id, w.label, min(o.label) AS runs_into FROM w JOIN o ON o.doc_id = w.doc_id AND o.label <> w.label AND contains(w.said, o.opening) GROUP BY w.doc_id, w.label""",
)
def sibling_runon(spark, sf):
    """Answers that hold the opening of another item of their document. To have some that do,
    each answer is read here with the item that follows it."""
    best = segments.best_per_label(segments.candidates(answers(spark, sf), "doc_id", "text"))
    # A document is one text, so its items are few, and they already lie together.
    following = F.lead("asked").over(Window.partitionBy("doc_id").orderBy(F.col("label").cast("int")))
    said = best.select(
        "doc_id", "label", "asked", F.concat_ws(" ", "said", F.coalesce(following, F.lit(""))).alias("said")
    )
    return coverage.sibling_runon(said)


# --- completeness, numbering, totals -----------------------------------------------------------


CONTIGUITY_SQL = """WITH l AS (SELECT o_orderkey AS doc_id, o_orderkey % 6 + 1 AS k, o_custkey AS p,
        list_distinct(list_transform(range(1, o_orderkey % 6 + 2), lambda i: CASE WHEN o_custkey % 5 = 0 AND i = 2 THEN i + 7 ELSE i END)) AS labels FROM orders),
      n AS (SELECT doc_id, CASE WHEN p % 7 = 0 THEN 0 ELSE len(labels) END AS labels, p % 7 = 0 OR list_sort(labels) = range(1, len(labels) + 1) AS contiguous, CASE WHEN p % 3 = 0 THEN 1 ELSE len(labels) END AS notes FROM l)
    SELECT doc_id, CAST(labels AS INTEGER) AS labels, CAST(notes AS INTEGER) AS notes, CASE WHEN labels = 0 THEN 'no labels found' WHEN NOT contiguous THEN 'labels have gaps'
      WHEN notes <> labels THEN notes || ' notes for ' || labels || ' labels' WHEN labels < 2 THEN 'one label proves nothing' ELSE '' END AS why FROM n"""


@query("contiguity_floor", CONTIGUITY_SQL)
def contiguity_floor(spark, sf):
    """Form letters whose own numbering proves how many items they close."""
    key, p = F.col("o_orderkey"), F.col("o_custkey")
    items = F.sequence(F.lit(1), (key % 6 + 1).cast("int"))
    body = F.array_join(
        F.transform(
            items,
            lambda i: F.concat(
                F.when(p % 7 == 0, "Item ").otherwise("Recommendation "),
                F.when((p % 5 == 0) & (i == 2), i + 7).otherwise(i).cast("string"),
                F.when((p % 3 == 0) & (i > 1), " is closed.\n").otherwise(". The Government notes this recommendation.\n"),
            ),
        ),
        "",
    )
    docs = load(spark, sf, "orders").select(key.alias("doc_id"), body.alias("text"))
    return coverage.contiguity(docs)


@query(
    "stated_gap",
    """WITH l AS (SELECT o_orderkey AS doc_id, CAST(o_orderkey % 6 + 1 AS INTEGER) AS addressed, CAST(CASE WHEN o_custkey % 3 = 0 THEN o_custkey % 30 ELSE 0 END AS INTEGER) AS stated FROM orders)
    SELECT doc_id, stated, addressed, stated - addressed AS gap FROM l WHERE stated > 0""",
)
def stated_gap(spark, sf):
    """Documents that state more items than they address, every one."""
    docs = answers(spark, sf).join(
        load(spark, sf, "orders").select(F.col("o_orderkey").alias("doc_id"), F.col("o_custkey").alias("p")), "doc_id"
    )
    body = F.concat(
        F.when(F.col("p") % 3 == 0, F.concat(F.lit("The report made "), (F.col("p") % 30).cast("string"), F.lit(" recommendations.\n"))).otherwise(""),
        F.array_join(F.transform(F.sequence(F.lit(1), F.col("items")), lambda i: F.concat(F.lit("Recommendation "), i.cast("string"), F.lit(" Agreed.\n"))), ""),
    )
    return coverage.stated_gap(docs.select("doc_id", body.alias("text")))


@query(
    "floor_summary",
    f"""WITH c AS ({CONTIGUITY_SQL}) SELECT CASE WHEN why = '' THEN 'counted' WHEN regexp_matches(why, '^[0-9]') THEN 'the notes sentences and the labels disagree' ELSE why END AS reason,
      count(*) AS documents, CAST(sum(CASE WHEN why = '' THEN labels ELSE 0 END) AS BIGINT) AS floor, CAST(sum(notes) AS BIGINT) AS sentences FROM c GROUP BY 1""",
)
def floor_summary(spark, sf):
    """Verified floor and a histogram of why the others are not counted; reasons that open
    with a number carry per-document figures and are folded into one."""
    why = F.col("why")
    reason = F.when(why == "", "counted").when(why.rlike(r"^\d"), "the notes sentences and the labels disagree").otherwise(why)
    return contiguity_floor(spark, sf).groupBy(reason.alias("reason")).agg(
        F.count("*").alias("documents"), F.sum(F.when(why == "", F.col("labels")).otherwise(0)).alias("floor"), F.sum("notes").alias("sentences")
    )


REFUSED_SQL = f"""{FOUND}, no AS (
      SELECT doc_id, i::VARCHAR AS label, CASE r WHEN 13 THEN 'characters or words are damaged' ELSE 'no wording of a proposal in it' END AS why, true AS answered FROM body_item WHERE refused
      UNION ALL SELECT doc_id, g.l::VARCHAR, 'fewer characters than an item needs', false FROM (SELECT DISTINCT doc_id FROM item WHERE doc_id % 4 = 0), range(1, 3) AS g(l)),
    refused AS (SELECT * FROM no WHERE NOT EXISTS (SELECT 1 FROM found f WHERE f.doc_id = no.doc_id AND f.label = no.label))"""


@query(
    "refusal_summary",
    f"""WITH {REFUSED_SQL} SELECT coalesce(why, 'all') AS why, count(*) AS rows, count(DISTINCT (doc_id, label)) AS labels, count(DISTINCT doc_id) AS documents,
      count(*) FILTER (WHERE answered) AS answered_rows, count(DISTINCT CASE WHEN answered THEN (doc_id, label) END) AS answered_labels, count(DISTINCT CASE WHEN answered THEN doc_id END) AS answered_documents
    FROM refused GROUP BY GROUPING SETS ((why), ())""",
)
def refusal_summary(spark, sf):
    """What the documents name and the index does not hold, in all and by reason."""
    return segments.refusal_totals(segments.refusals(segments.candidates(answers(spark, sf), "doc_id", "text")))


DONE_SQL = wording.COMPLETED_VERB.replace("'", "''")


@query(
    "implementation_summary",
    f"""WITH {FOUND}, a AS (SELECT doc_id, said, r = 8 OR r = 10 AS claims FROM judged WHERE said <> '')
    SELECT 'answers' AS figure, count(*) AS n FROM a UNION ALL SELECT 'say that this item is done', count(*) FILTER (WHERE claims) FROM a
    UNION ALL SELECT 'speak of a finished action', count(*) FILTER (WHERE regexp_matches(said, '{DONE_SQL}')) FROM a
    UNION ALL SELECT 'documents with a section on it', count(*) FILTER (WHERE o_orderkey % 9 = 0 AND o_orderkey IN (SELECT doc_id FROM body_item)) FROM orders""",
)
def implementation_summary(spark, sf):
    """How many answers say that their item is done, against how many speak of anything finished, and
    the documents that head a section on implementation themselves."""
    docs = answers(spark, sf)
    best = segments.best_per_label(segments.candidates(docs, "doc_id", "text"))
    headed = docs.withColumn("text", F.concat("text", F.when(F.col("doc_id") % 9 == 0, "\nImplementation  status: July\n").otherwise("")))
    return coverage.implementation(best, headed)


SECOND = """CASE k % 4 WHEN 0 THEN 'The Government accepts this recommendation.' WHEN 1 THEN concat('The Government accepts this recommendation. See also recommendation ', k % 6 + 2, '.')
  WHEN 2 THEN concat(repeat('Background to the matter is set out here. ', 6), 'The Government accepts this recommendation.') ELSE 'Nothing is said about it.' END"""


@query(
    "position_second_reading",
    """SELECT o_orderkey AS doc_id, (o_orderkey % 6 + 1)::VARCHAR AS label, CASE o_orderkey % 4 WHEN 2 THEN 6 * 42 + 15 WHEN 3 THEN -1 ELSE 0 END AS distance,
      CASE WHEN o_orderkey % 4 = 1 THEN (o_orderkey % 6 + 2)::VARCHAR ELSE '' END AS names_others,
      CASE o_orderkey % 4 WHEN 1 THEN 'names recommendation ' || (o_orderkey % 6 + 2) WHEN 2 THEN 'verdict 267 characters in' WHEN 3 THEN 'no verdict found on a second reading' ELSE '' END AS why FROM orders""",
)
def position_second_reading(spark, sf):
    """Stated positions read again: each check of the second reading finds some."""
    rows = load(spark, sf, "orders").select(F.col("o_orderkey").alias("k")).select(
        F.col("k").alias("doc_id"), (F.col("k") % 6 + 1).cast("string").alias("label"), F.expr(SECOND).alias("said"), F.lit("position").alias("state")
    )
    return coverage.position_checks(rows).select("doc_id", "label", "distance", "names_others", "why")
