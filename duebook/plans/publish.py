"""What is checked before rows are published: positions in long documents, tables against each
other, figures in texts against metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from duebook.operators import compare, gates, positions
from duebook.plans import derived
from duebook.plans.registry import query
from duebook.sources import load

# --- positions: one response document per order, with a claim for every way a check can end -------

RESPONSE = r"""'The case ' || o_custkey || ' was considered.\nResponse to Recommendations 1 to 3\nResponsibility: Australian Government\nResponse to Recommendation 4\n'
  || 'Responsibility: Australian Government\nResponse: Accept in principle\nThe case ' || o_custkey || '\ncontinues in full.\nResponse to Recommendation 5\nResponse: Accept\nThe fund of '
  || o_custkey || ' will be doubled, as set out in\nRecommendation 6 as part of the review.\nResponse to Recommendation 7\nResponsibility: Commonwealth\nResponse: Subject to\nfurther consideration\n'
  || 'Nothing more was said.\nResponse to Recommendation 4\nResponse: Note\nIt was answered before.\n'"""

VERDICT = """CASE label WHEN 1 THEN IF(k % 7 = 1, 'Accept', 'Accept in principle') WHEN 4 THEN IF(k % 7 = 6, 'Note', 'Accept in principle')
  WHEN 5 THEN 'Accept' WHEN 7 THEN 'Subject to further consideration' END"""
WORDS = """CASE label WHEN 1 THEN concat('The case ', c, ' continues in full.')
  WHEN 4 THEN CASE k % 7 WHEN 2 THEN 'Nothing more was said.' WHEN 6 THEN 'It was answered before.' ELSE concat('The case ', c, ' continues in full.') END
  WHEN 5 THEN IF(k % 7 = 3, 'The moon will be doubled', concat('The fund of ', c, ' will be doubled')) WHEN 6 THEN ''
  WHEN 7 THEN IF(k % 7 = 4, ' ', 'Nothing more was said.') END"""

POSITION_SQL = """p AS (SELECT o_orderkey AS k, label, CASE WHEN label = 8 THEN 'verified' WHEN o_orderkey % 11 = 5 THEN 'source text missing'
    WHEN label = 6 THEN 'the document does not name this label' WHEN label = 7 AND o_orderkey % 7 = 4 THEN 'no words to check'
    WHEN label = 5 AND o_orderkey % 7 = 3 THEN 'the words are not in the document' WHEN label = 4 AND o_orderkey % 7 = 2 THEN 'the words stand under another label'
    WHEN label = 1 AND o_orderkey % 7 = 1 THEN 'the verdict is not stated there' ELSE 'verified' END AS outcome
  FROM orders, (VALUES (1), (2), (4), (5), (6), (7), (8)) AS v(label))"""


def claims(spark, sf):
    o = load(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_custkey").cast("string").alias("c"))
    o = o.select("k", "c", F.explode(F.array(*[F.lit(n) for n in (1, 2, 4, 5, 6, 7, 8)])).alias("label"))
    label, verdict = F.col("label"), F.expr(VERDICT)
    return o.select(
        F.concat_ws("/", F.lit("p"), "k", "label").alias("id"),
        F.col("k").alias("doc_id"),
        label.cast("string").alias("label"),
        F.when(label.isin(2, 6), "noted").when(label == 8, "not addressed").otherwise("position").alias("state"),
        F.when(verdict.isNotNull(), F.array(verdict)).alias("verdicts"),
        F.expr(WORDS).alias("words"),
    )


def responses(spark, sf):
    o = load(spark, sf, "orders").where("o_orderkey % 11 <> 5")
    return o.select(F.col("o_orderkey").alias("doc_id"), F.expr(RESPONSE).alias("text"))


@query("position_outcomes", f"WITH {POSITION_SQL} SELECT k AS doc_id, label::VARCHAR AS label, outcome FROM p")
def position_outcomes(spark, sf):
    """Each claim against the windows of its label in a long response."""
    return positions.positions(claims(spark, sf), responses(spark, sf)).select("doc_id", "label", "outcome")


WINDOW_SQL = """SELECT o_orderkey AS doc_id, unnest(CASE w WHEN 1 THEN ['1', '2', '3'] WHEN 2 THEN ['4'] WHEN 3 THEN ['5'] WHEN 4 THEN ['7'] ELSE ['4'] END) AS label,
    CASE w WHEN 1 THEN 1 WHEN 2 THEN 3 WHEN 3 THEN 8 WHEN 4 THEN 12 ELSE 17 END AS first_line, CASE w WHEN 1 THEN 7 WHEN 2 THEN 7 WHEN 3 THEN 11 WHEN 4 THEN 16 ELSE 20 END AS last_line
  FROM orders, range(1, 6) AS g(w) WHERE o_orderkey % 11 <> 5"""


@query("position_windows", WINDOW_SQL)
def position_windows(spark, sf):
    """The lines that a response says are about each label."""
    return positions.windows(responses(spark, sf)).select("doc_id", F.explode("labels").alias("label"), "first_line", "last_line")


CASCADE_SQL = f"""{POSITION_SQL}, r AS (SELECT 'p/' || k || '/' || label AS id, outcome FROM p
    UNION ALL SELECT 'r/' || o_orderkey || '/' || label, CASE WHEN o_orderkey % 13 = 0 AND label = 7 THEN 'text not in source' ELSE 'verified' END FROM orders, (VALUES (1), (2), (4), (5), (6), (7), (8)) AS v(label)
    UNION ALL SELECT 'e/' || o_orderkey || '/' || n, 'verified' FROM orders, range(1, 4) AS g(n)),
  needs AS (SELECT 'p/' || k || '/' || label AS id, 'r/' || k || '/' || label AS on_ FROM p UNION ALL SELECT 'e/' || o_orderkey || '/1', 'p/' || o_orderkey || '/7' FROM orders
    UNION ALL SELECT 'e/' || o_orderkey || '/' || n, 'e/' || o_orderkey || '/' || (n - 1) FROM orders, range(2, 4) AS g(n) UNION ALL SELECT 'e/' || o_orderkey || '/1', 'e/' || o_orderkey || '/3' FROM orders),
  RECURSIVE_PART,
  done AS (SELECT r.id, CASE WHEN outcome = 'verified' AND f.id IS NOT NULL THEN 'rests on a row that was not verified' ELSE outcome END AS outcome FROM r LEFT JOIN (SELECT DISTINCT id FROM fallen) f ON f.id = r.id)"""
CASCADE_SQL = "RECURSIVE " + CASCADE_SQL.replace(
    "RECURSIVE_PART", "fallen AS (SELECT id FROM r WHERE outcome <> 'verified' UNION SELECT n.id FROM fallen JOIN needs n ON n.on_ = fallen.id)"
)


def published(spark, sf):
    """All rows with their outcomes, and what rests on what: positions on recommendations, evidence on
    positions, and evidence on evidence in a ring that only a failure from outside breaks."""
    found = positions.positions(claims(spark, sf), responses(spark, sf)).select("id", "outcome")
    o = load(spark, sf, "orders").select(F.col("o_orderkey").alias("k"))
    at = lambda kind, n: F.concat_ws("/", F.lit(kind), "k", n)
    label = o.select("k", F.explode(F.array(*[F.lit(n) for n in (1, 2, 4, 5, 6, 7, 8)])).alias("n"))
    recs = label.select(at("r", "n").alias("id"), F.when((F.col("k") % 13 == 0) & (F.col("n") == 7), "text not in source").otherwise("verified").alias("outcome"))
    step = o.select("k", F.explode(F.sequence(F.lit(1), F.lit(3))).alias("n"))
    rows = found.unionByName(recs).unionByName(step.select(at("e", "n").alias("id"), F.lit("verified").alias("outcome")))
    before = F.when(F.col("n") == 1, F.lit(3)).otherwise(F.col("n") - 1)
    needs = (
        label.select(at("p", "n").alias("id"), at("r", "n").alias("on"))
        .unionByName(o.select(at("e", F.lit(1)).alias("id"), at("p", F.lit(7)).alias("on")))
        .unionByName(step.select(at("e", "n").alias("id"), at("e", before).alias("on")))
    )
    return positions.cascade(rows, needs)


@query("provenance_cascade", f"WITH {CASCADE_SQL} SELECT left(id, 1) AS kind, outcome, count(*) AS rows FROM done GROUP BY ALL")
def provenance_cascade(spark, sf):
    """Every outcome after failed rows took along what rests on them."""
    return published(spark, sf).groupBy(F.left("id", F.lit(1)).alias("kind"), "outcome").agg(F.count("*").alias("rows"))


@query(
    "provenance_floor",
    f"""WITH {CASCADE_SQL} SELECT left(id, 1) AS kind, count(*) AS rows, count(*) FILTER (WHERE outcome = 'verified') AS verified,
    count(*) FILTER (WHERE outcome = 'verified') >= 0.9 * count(*) AS publish FROM done GROUP BY 1""",
)
def provenance_floor(spark, sf):
    """Per kind of row, whether nine in ten are verified: below that the check is broken, not the rows."""
    return positions.floor(published(spark, sf).withColumn("kind", F.left("id", F.lit(1))), by=["kind"])


# --- tables against each other ------------------------------------------------------------------

INDEX_SQL = """ix AS (SELECT DISTINCT l_orderkey AS doc, l_linenumber AS label, CASE WHEN l_orderkey % 211 = 7 AND l_linenumber = 1 THEN '' WHEN l_orderkey % 307 = 11 THEN 'http://register.example/' || l_orderkey
    ELSE 'https://register.example/' || l_orderkey END AS url FROM lineitem),
  pos AS (SELECT doc, label, CASE WHEN (doc + label) % 3 = 0 THEN 'position' ELSE 'noted' END AS state, CASE WHEN (doc + label) % 3 <> 0 OR doc % 173 = 9 THEN '' WHEN (doc + label) % 9 = 0 THEN 'accepted'
      WHEN (doc + label) % 9 = 3 THEN 'in part or in principle' ELSE 'not accepted' END AS verdict FROM ix WHERE NOT (doc % 151 = 3 AND label = 1)
    UNION ALL SELECT doc, label + 90, 'noted', '' FROM ix WHERE doc % 167 = 5 AND label = 1),
  built AS (SELECT doc, count(*) FILTER (WHERE state = 'position') AS stated, count(*) FILTER (WHERE verdict = 'accepted') AS accepted, count(*) FILTER (WHERE verdict = 'in part or in principle') AS part,
      count(*) FILTER (WHERE verdict = 'not accepted') AS refused FROM pos GROUP BY doc),
  cov AS (SELECT doc, CAST(stated + CASE WHEN doc % 191 = 4 THEN 1 ELSE 0 END AS BIGINT) AS stated, accepted, part, refused FROM built WHERE doc % 199 <> 6)"""


def index_rows(spark, sf):
    l = load(spark, sf, "lineitem").select(F.col("l_orderkey").alias("doc"), F.col("l_linenumber").alias("label")).distinct()
    there = F.concat(F.lit("//register.example/"), F.col("doc").cast("string"))
    url = F.when((F.col("doc") % 211 == 7) & (F.col("label") == 1), "").when(F.col("doc") % 307 == 11, F.concat(F.lit("http:"), there)).otherwise(F.concat(F.lit("https:"), there))
    return l.withColumn("url", url)


def stated_rows(index):
    """One row per index row as the step behind it left them, with some lost, some added, some without a verdict."""
    n = F.col("doc") + F.col("label")
    state = F.when(n % 3 == 0, "position").otherwise("noted")
    verdict = (
        F.when((n % 3 != 0) | (F.col("doc") % 173 == 9), "").when(n % 9 == 0, "accepted").when(n % 9 == 3, "in part or in principle").otherwise("not accepted")
    )
    kept = index.where("NOT (doc % 151 = 3 AND label = 1)").select("doc", "label", state.alias("state"), verdict.alias("verdict"))
    added = index.where("doc % 167 = 5 AND label = 1").select("doc", (F.col("label") + 90).alias("label"), F.lit("noted").alias("state"), F.lit("").alias("verdict"))
    return kept.unionByName(added)


def coverage_of(pos):
    verdict = lambda v: F.count_if(F.col("verdict") == v)
    return pos.groupBy("doc").agg(
        F.count_if(F.col("state") == "position").alias("stated"),
        verdict("accepted").alias("accepted"),
        verdict("in part or in principle").alias("part"),
        verdict("not accepted").alias("refused"),
    )


@query(
    "index_against_positions",
    f"""WITH {INDEX_SQL} SELECT coalesce(ix.doc, pos.doc) AS doc, coalesce(ix.label, pos.label) AS label, CASE WHEN pos.doc IS NULL THEN 'left only' ELSE 'right only' END AS outcome
    FROM ix FULL JOIN pos ON ix.doc = pos.doc AND ix.label = pos.label WHERE ix.doc IS NULL OR pos.doc IS NULL""",
)
def index_against_positions(spark, sf):
    """Two tables with one row per item each, compared by ranges of keys."""
    index = index_rows(spark, sf)
    return compare.differences(index.select("doc", "label"), stated_rows(index).select("doc", "label"), ["doc", "label"], [])


GATE_SQL = f"""WITH {INDEX_SQL},
  reg AS (SELECT o_orderkey AS id, o_orderpriority AS body, CASE WHEN o_orderkey % 101 = 2 THEN o_orderkey + 1 ELSE o_orderkey END AS report FROM orders),
  rep AS (SELECT o_orderkey AS report, 'Joint Committee on ' || o_orderpriority AS body FROM orders),
  held AS (SELECT o_orderstatus AS register, count(*) + CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS claimed, count(*) AS listed FROM orders GROUP BY 1)
  SELECT 'no https link' AS rule, doc || '/' || label AS key FROM ix WHERE url NOT LIKE 'https://%'
  UNION ALL SELECT 'index row without a position', ix.doc || '/' || ix.label FROM ix LEFT JOIN pos ON ix.doc = pos.doc AND ix.label = pos.label WHERE pos.doc IS NULL
  UNION ALL SELECT 'position without an index row', pos.doc || '/' || pos.label FROM pos LEFT JOIN ix ON ix.doc = pos.doc AND ix.label = pos.label WHERE ix.doc IS NULL
  UNION ALL SELECT 'stated position without a verdict', doc || '/' || label FROM pos WHERE state = 'position' AND verdict = ''
  UNION ALL SELECT 'verdicts do not add up', doc::VARCHAR FROM cov WHERE accepted + part + refused <> stated
  UNION ALL SELECT 'coverage of another build', coalesce(cov.doc, built.doc)::VARCHAR FROM cov FULL JOIN built ON cov.doc = built.doc WHERE cov.doc IS NULL OR built.doc IS NULL OR cov.stated <> built.stated
  UNION ALL SELECT 'link to a document of another body', reg.id::VARCHAR FROM reg JOIN rep ON rep.report = reg.report WHERE rep.body <> 'Joint Committee on ' || reg.body
  UNION ALL SELECT 'removals counted and listed differ', register FROM held WHERE claimed <> listed"""


@query("gate_publish_tables", GATE_SQL)
def gate_publish_tables(spark, sf):
    """Index, positions, coverage and registers against each other: a row for whatever does not agree."""
    index = index_rows(spark, sf)
    pos = stated_rows(index)
    built = coverage_of(pos)
    cov = built.where("doc % 199 <> 6").withColumn("stated", F.col("stated") + F.when(F.col("doc") % 191 == 4, 1).otherwise(0))
    o = load(spark, sf, "orders")
    register = o.select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("body"), F.when(F.col("o_orderkey") % 101 == 2, F.col("o_orderkey") + 1).otherwise(F.col("o_orderkey")).alias("report"))
    reports = o.select(F.col("o_orderkey").alias("report"), F.concat(F.lit("Joint Committee on "), "o_orderpriority").alias("body"))
    listed = o.groupBy(F.col("o_orderstatus").alias("register")).agg(F.count("*").alias("listed"))
    claimed = listed.select("register", (F.col("listed") + F.when(F.col("register") == "P", 1).otherwise(0)).alias("stated"))
    return gates.publish_tables(index, pos, cov, built, register, reports, o.withColumnRenamed("o_orderstatus", "register"), claimed)


# --- figures in texts against metrics -----------------------------------------------------------

CLAIM_ROWS = (
    (0, "lists {} reports, of which {} are answered", ["reports", "answered"]),
    (1, "{} per cent are not", ["open share%"]),
    (2, "leaves {} open", ["reports - answered"]),
    (3, "and {} of them late", ["late"]),
    (4, "lists {} reports", ["reports", "answered"]),
    (5, "a rise of {}", ["reports"]),
)


@query(
    "claims_metrics",
    f"""WITH {derived.OB}, m AS (SELECT party AS brief, count(*) AS n, count(answered) AS a FROM ob GROUP BY party),
    s AS (SELECT *, n - a AS u, CASE brief % 5 WHEN 2 THEN round_even(100.0 * (n - a) / n, 1) + 0.3 ELSE round_even(100.0 * (n - a) / n, 1) END AS p FROM m)
    SELECT brief, claim, figure, said, should, outcome FROM (
      SELECT brief, 0 AS claim, 1 AS figure, format('{{:,}}', n + CASE WHEN brief % 5 = 1 THEN 1 ELSE 0 END) AS said, CAST(n AS DOUBLE) AS should, CASE WHEN brief % 5 = 1 THEN 'moved' ELSE 'agrees' END AS outcome FROM s
      UNION ALL SELECT brief, 0, 2, a::VARCHAR, a, 'agrees' FROM s
      UNION ALL SELECT brief, 1, 1, printf('%.1f', p), round_even(100.0 * u / n, 1), CASE WHEN brief % 5 = 2 THEN 'moved' ELSE 'agrees' END FROM s
      UNION ALL SELECT brief, 2, 1, u::VARCHAR, u, 'agrees' FROM s
      UNION ALL SELECT brief, 3, 1, '7', NULL, 'unknown metric' FROM s
      UNION ALL SELECT brief, 4, NULL, NULL, NULL, 'figures and keys differ in number' FROM s
      UNION ALL SELECT brief, 5, NULL, NULL, NULL, 'not said' FROM s)""",
)
def claims_metrics(spark, sf):
    """A brief per party with claims as rows: agreeing, moved, a difference, an unknown metric, a wrong count, one not said."""
    m = derived.obligations(spark, sf).groupBy(F.col("party").alias("brief")).agg(F.count("*").alias("n"), F.count("answered").alias("a"))
    share = F.bround(F.lit(100.0) * (F.col("n") - F.col("a")) / F.col("n"), 1)
    printed = F.format_string("%.1f", F.when(F.col("brief") % 5 == 2, share + 0.3).otherwise(share))
    said = F.format_string("%,d", F.col("n") + F.when(F.col("brief") % 5 == 1, 1).otherwise(0))
    text = F.concat(
        F.lit("The register lists "), said, F.lit(" reports,\n of which "), F.col("a").cast("string"), F.lit(" are answered; "), printed, F.lit(" per cent are not. That leaves "),
        (F.col("n") - F.col("a")).cast("string"), F.lit(" open and 7 of them late."),
    )
    briefs = m.select("brief", F.col("brief").alias("scope"), text.alias("text"))
    pairs = F.array(*[F.struct(F.lit(k).alias("metric"), v.cast("double").alias("value")) for k, v in (("reports", F.col("n")), ("answered", F.col("a")), ("open share", (F.col("n") - F.col("a")) / F.col("n")))])
    metrics = m.select(F.col("brief").alias("scope"), F.inline(pairs))
    rows = F.array(*[F.struct(F.lit(k).alias("claim"), F.lit(p).alias("pattern"), F.array(*[F.lit(x) for x in keys]).alias("keys")) for k, p, keys in CLAIM_ROWS])
    return gates.claims_table(briefs, m.select("brief", F.inline(rows)), metrics)
