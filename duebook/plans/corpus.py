"""Whole-text queries over documents, labels, benchmark passages and response documents."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from duebook.functions import text as tx, wording
from duebook.functions.wording import Rules
from duebook.operators import corpus, merge, scans, segments
from duebook.operators.fence import staged
from duebook.plans.derived import _SAID, FOUND, answers
from duebook.plans.registry import query
from duebook.sources import load
from duebook.sources.tables import first_file

# The rule set suited to the documents table: a boilerplate line closes a text, licence lines
# and a phrase accept it.
RULES = Rules(
    template=r"(?is)the and attion to thanedble.{0,240}?(?:anea|eriner)",
    notes=r"(?i) is the ",
    accepts=r"(?im)^(?:licensed under|released under|this work is licensed)| by the ",
    anchor=r"(?i)and ornd|thanedble",
    all_of=("eriner", "the"),
    one_of=("thanea", "reedes"),
)
LOOSE = r"(?i)attion to than|therhean is the"


def counts_sql(expr: str, pattern: str) -> str:
    return f"CAST(len(regexp_extract_all({expr}, '{pattern}')) AS INTEGER)"


SCATTER_SQL = """pieces AS (SELECT doc_id, text, string_split_regex(text, '(?i)and ornd|thanedble') AS s, regexp_extract_all(text, '(?i)and ornd|thanedble') AS m FROM documents),
spots AS (SELECT doc_id, lower(substr(text, 1 + CAST(list_sum(list_transform(s[1:i], lambda x: length(x))) AS BIGINT) + coalesce(CAST(list_sum(list_transform(m[1:i - 1], lambda x: length(x))) AS BIGINT), 0), 700)) AS w
  FROM pieces, range(1, 2000) AS g(i) WHERE i <= len(m)),
scattered AS (SELECT DISTINCT doc_id FROM spots WHERE contains(w, 'eriner') AND contains(w, 'the') AND (contains(w, 'thanea') OR contains(w, 'reedes')))"""
CLASS_SQL = f"""{SCATTER_SQL}, counted AS (
  SELECT doc_id, lang, source, text, {counts_sql('text', RULES.template)} AS t0, {counts_sql('text', RULES.notes)} AS n0, {counts_sql('text', RULES.accepts)} AS a0,
    doc_id IN (SELECT doc_id FROM scattered) AS sc, length(regexp_replace(text, '^\\s+|\\s+$', '', 'g')) >= 40 AS readable FROM documents),
classed AS (SELECT doc_id, lang, source, text, CASE WHEN readable THEN CASE WHEN t0 > 0 THEN t0 WHEN sc THEN 1 ELSE 0 END ELSE 0 END AS template_hits,
    CASE WHEN readable THEN n0 ELSE 0 END AS notes, CASE WHEN readable THEN a0 ELSE 0 END AS accepts, readable, t0, a0, sc FROM counted),
c AS (SELECT *, CASE WHEN NOT readable THEN 'unreadable' WHEN template_hits > 0 AND accepts = 0 THEN 'proforma_closure' WHEN template_hits > 0 THEN 'partial_proforma' ELSE 'substantive' END AS class FROM classed)"""


def classified(spark, sf):
    return corpus.classify(load(spark, sf, "documents"), RULES)


@query("classify_documents", f"WITH {CLASS_SQL} SELECT doc_id, class, template_hits, notes, accepts FROM c")
def classify_documents(spark, sf):
    return classified(spark, sf).select("doc_id", "class", "template_hits", "notes", "accepts")


@query(
    "class_shares",
    f"""WITH {CLASS_SQL} SELECT lang, class, count(*) AS documents, CAST(sum(template_hits) AS BIGINT) AS template_hits, CAST(sum(notes) AS BIGINT) AS notes, count(*) FILTER (WHERE accepts > 0) AS accepting,
      count(*) / sum(count(*)) OVER (PARTITION BY lang) AS share FROM c GROUP BY lang, class""",
)
def class_shares(spark, sf):
    per = (
        classified(spark, sf)
        .groupBy("lang", "class")
        .agg(
            F.count("*").alias("documents"),
            F.sum("template_hits").alias("template_hits"),
            F.sum("notes").alias("notes"),
            F.count_if(F.col("accepts") > 0).alias("accepting"),
        )
    )
    # A few rows per language are left.
    return per.withColumn("share", F.col("documents") / F.sum("documents").over(Window.partitionBy("lang")))


@query("scattered_terms", f"WITH {SCATTER_SQL} SELECT doc_id FROM scattered")
def scattered_terms(spark, sf):
    return load(spark, sf, "documents").where(wording.scattered(F.col("text"), RULES)).select("doc_id")


@query(
    "classifier_drift",
    f"""WITH {CLASS_SQL} SELECT doc_id FROM c WHERE (regexp_matches(text, '{LOOSE}') OR sc) AND t0 = 0 AND a0 = 0""",
)
def classifier_drift(spark, sf):
    return load(spark, sf, "documents").where(wording.drifted(F.col("text"), LOOSE, RULES)).select("doc_id")


@query(
    "corpus_first_file",
    """WITH f AS (SELECT md5(split_part(text, chr(10), 1)) AS doc, lpad(doc_id::VARCHAR, 12, '0') || '.txt' AS file_name, text FROM documents)
    SELECT doc, min(file_name) AS file_name, md5(arg_min(text, file_name)) AS text_md5, count(*) AS files FROM f GROUP BY doc""",
)
def corpus_first_file(spark, sf):
    """The first file in name order stands for its document; files share a document here when
    they share their first line, so copies make hot groups and are reduced on the map side."""
    f = load(spark, sf, "documents").select(
        F.md5(F.substring_index("text", "\n", 1)).alias("doc_id"),
        F.concat(F.lpad(F.col("doc_id").cast("string"), 12, "0"), F.lit(".txt")).alias("file_name"),
        "text",
    )
    files = f.groupBy("doc_id").agg(F.count("*").alias("files"))
    return first_file(f).join(files, "doc_id").select(
        F.col("doc_id").alias("doc"), "file_name", F.md5("text").alias("text_md5"), "files"
    )


@query(
    "pick_whole_file",
    """WITH f AS (SELECT md5(split_part(text, chr(10), 1)) AS doc, doc_id, length(text) AS chars,
      CASE WHEN regexp_matches(text, '(?i)licensed|released') THEN 0 WHEN regexp_matches(text, '(?i)all rights|[|]') THEN 2 ELSE 1 END AS rank FROM documents)
    SELECT doc, arg_min(doc_id, rank * 1e12 + chars * 1e6 + doc_id) AS doc_id, min(rank) AS rank FROM f GROUP BY doc""",
)
def pick_whole_file(spark, sf):
    """The best candidate of each group: whole before unknown before chapter, then the shortest name."""
    rank = F.when(F.col("text").rlike("(?i)licensed|released"), 0).when(F.col("text").rlike("(?i)all rights|[|]"), 2).otherwise(1)
    f = load(spark, sf, "documents").select(
        F.md5(F.substring_index("text", "\n", 1)).alias("doc"), "doc_id", F.length("text").alias("chars"), rank.alias("rank")
    )
    return merge.first_wins(f, ["doc"], [], ["rank", "chars", "doc_id"]).select("doc", "doc_id", "rank")


TIDY_SQL = r"regexp_replace(regexp_replace({0}, '(?i)(?:\s+(?:Response|Government\s+response|Australian\s+Government\s+response)\s*:?\s*|\s+[0-9]{{1,3}})\s*$', ''), '^[ .:;\-—–•]+|[ .:;\-—–•]+$', '', 'g')"


def tidy_sql(e: str) -> str:
    s = rf"regexp_replace(regexp_replace({e}, '\s+', ' ', 'g'), '^[ .:;\-—–•]+|[ .:;\-—–•]+$', '', 'g')"
    s = rf"regexp_replace(regexp_replace({s}, '^[0-9]{{1,2}}[.][0-9]{{1,3}}\s+', ''), '^[0-9]{{1,3}}(?:[.][0-9]{{1,3}})?\s*[:.]\s+', '')"
    for _ in range(3):
        s = TIDY_SQL.format(s)
    return s


DRESSED = "CASE doc_id % 4 WHEN 0 THEN '3.14  ' || text || ' 12 Response:' WHEN 1 THEN ' • 7: ' || text || ' Australian Government response 4 12' ELSE text END"


@query(
    "tidy_text",
    f"WITH t AS (SELECT doc_id, {tidy_sql(DRESSED)} AS tidied FROM documents) SELECT doc_id, length(tidied) AS chars, md5(tidied) AS tidied_md5 FROM t",
)
def tidy_text(spark, sf):
    d = load(spark, sf, "documents").select("doc_id", tx.tidy(F.expr(DRESSED)).alias("tidied"))
    return d.select("doc_id", F.length("tidied").alias("chars"), F.md5("tidied").alias("tidied_md5"))


@query(
    "cut_at_sentence",
    r"""WITH w AS (SELECT doc_id, regexp_replace(regexp_replace(text, '\s+', ' ', 'g'), '^\s+|\s+$', '', 'g') AS whole FROM documents),
    h AS (SELECT doc_id, length(whole) > 900 AS more, substr(whole, 1, 900) AS head FROM w),
    s AS (SELECT *, regexp_extract(head, '^(.*[.!?][”’")\]]?)(?:\s+["“(A-Z0-9].*|)$', 1) AS stop, regexp_extract(head, '^(.*) ', 1) AS word FROM h),
    t AS (SELECT *, regexp_replace(substr(head, length(stop) + 1), '^\s+|\s+$', '', 'g') AS tail FROM s),
    k AS (SELECT doc_id, more, CASE WHEN length(stop) > 1 AND tail <> '' AND more AND length(tail) > 300 THEN word WHEN length(stop) > 1 AND tail <> '' AND (more OR length(tail) <= 120) THEN stop ELSE head END AS kept FROM t)
    SELECT doc_id, md5(regexp_replace(kept, '^\s+|\s+$', '', 'g')) AS kept_md5, length(regexp_replace(kept, '^\s+|\s+$', '', 'g')) AS chars, CASE WHEN more THEN 'yes' ELSE '' END AS more_follows FROM k""",
)
def cut_at_sentence(spark, sf):
    kept, more = tx.cut_at_sentence(F.col("text"))
    d = load(spark, sf, "documents").select("doc_id", kept.alias("kept"), more.alias("more_follows"))
    return d.select("doc_id", F.md5("kept").alias("kept_md5"), F.length("kept").alias("chars"), "more_follows")


@query(
    "snippets",
    r"""WITH p AS (SELECT doc_id, text, string_split_regex(text, 'thanea|edonre') AS s, regexp_extract_all(text, 'thanea|edonre') AS m FROM documents),
    o AS (SELECT doc_id, i, text, m[i] AS hit, CAST(list_sum(list_transform(s[1:i], lambda x: length(x))) AS BIGINT) + coalesce(CAST(list_sum(list_transform(m[1:i - 1], lambda x: length(x))) AS BIGINT), 0) AS at
      FROM p, range(1, 4) AS g(i) WHERE i <= len(m))
    SELECT doc_id, CAST(i AS INTEGER) AS place, regexp_replace(regexp_replace(substr(text, CAST(greatest(at - 130, 0) + 1 AS BIGINT), CAST(at - greatest(at - 130, 0) + length(hit) + 130 AS BIGINT)), '\s+', ' ', 'g'), '^\s+|\s+$', '', 'g') AS snippet FROM o""".replace(" AS at\n", " AS pos\n").replace("at - 130", "pos - 130").replace("CAST(at - greatest", "CAST(pos - greatest"),
)
def snippets(spark, sf):
    d = load(spark, sf, "documents").select("doc_id", tx.snippets(F.col("text"), "thanea|edonre").alias("s"))
    return d.select("doc_id", F.posexplode("s").alias("place", "snippet")).withColumn("place", F.col("place") + 1)


@query(
    "mangled_text",
    r"""WITH a AS (SELECT doc_id, lang, text, regexp_replace(regexp_replace(text, '([:;,.•·])\s+[oe](\s+[A-Za-z0-9_])', '\1 \2', 'g'), '^\s*[oe](\s+[A-Za-z0-9_])', ' \1') AS x FROM documents),
    b AS (SELECT doc_id, lang, text, regexp_replace(x, '(^|[^A-Za-z0-9_''’])\(?[a-h]\)?[.)]', '\1 ', 'g') AS y FROM a),
    c AS (SELECT doc_id, lang, text, regexp_replace(y, '([^A-Za-z0-9_''’])', '\1\1', 'g') AS z FROM b)
    SELECT doc_id, lang FROM c WHERE regexp_matches(text, '[.…]{6,}') OR len(regexp_extract_all(z, '(?:^|[^A-Za-z0-9_''’])[B-HJ-Zb-hj-z](?:[^A-Za-z0-9_''’]|$)')) >= 2""",
)
def mangled_text(spark, sf):
    return load(spark, sf, "documents").where(tx.mangled(F.col("text"))).select("doc_id", "lang")


@query(
    "page_furniture",
    r"""WITH w AS (SELECT doc_id, text, string_split_regex(regexp_replace(regexp_replace(text, '\s+', ' ', 'g'), '^ | $', '', 'g'), ' ') AS words FROM documents),
    d AS (SELECT doc_id, lower(array_to_string(words[1:3], ' ')) AS stem, array_to_string(words[1:4], ' ') AS head, string_split(text, chr(10)) AS ls FROM w WHERE len(words) >= 4),
    l AS (SELECT doc_id, stem, unnest(list_concat(list_transform(ls, lambda x: x), list_transform(range(1, len(ls) + 1), lambda i: 'The ' || head || '  ' || i))) AS raw FROM d),
    n AS (SELECT doc_id, stem, regexp_replace(regexp_replace(regexp_replace(regexp_replace(raw, '\s+', ' ', 'g'), '^\s+|\s+$', '', 'g'), '^\s*[0-9]{1,4}\s+|\s+[0-9]{1,4}\s*$', '', 'g'), '^\s+|\s+$', '', 'g') AS line FROM l)
    SELECT doc_id, line, count(*) AS times FROM n WHERE length(line) <= 120 AND line NOT LIKE '%.' AND (starts_with(lower(line), stem) OR starts_with(regexp_replace(lower(line), '^(?:the |australian )', ''), stem))
    GROUP BY doc_id, line HAVING count(*) >= 3""",
)
def page_furniture(spark, sf):
    """The documents print no running heads, so each line is given one with a page number."""
    words = F.split(tx.squeeze(F.col("text")), " ")
    head = F.array_join(F.slice(words, 1, 4), " ")
    d = load(spark, sf, "documents").where(F.size(words) >= 4).select("doc_id", "text", head.alias("title"))
    paged = F.array_join(
        F.transform(F.split("text", "\n"), lambda l, i: F.concat(l, F.lit("\nThe "), F.col("title"), F.lit("  "), (i + 1).cast("string"))),
        "\n",
    )
    return corpus.furniture(d.select("doc_id", "title", paged.alias("text")))


@query(
    "scope_exclusion",
    r"""WITH x AS (SELECT doc_id, CASE WHEN toxic = 1 THEN 'toxic' ELSE 'low quality' END AS reason FROM labels WHERE toxic = 1 OR quality = 0)
    SELECT coalesce(reason, CASE WHEN regexp_matches(text, '(?i)licensed|rights reserved') THEN 'by title' ELSE 'in scope' END) AS reason, lang, count(*) AS documents FROM documents LEFT JOIN x USING (doc_id) GROUP BY ALL""",
)
def scope_exclusion(spark, sf):
    """Documents outside the claim's scope, each with its reason: a listed exclusion, or its wording."""
    l = load(spark, sf, "labels")
    listed = l.where("toxic = 1 OR quality = 0").select(
        "doc_id", F.when(F.col("toxic") == 1, "toxic").otherwise("low quality").alias("listed")
    )
    worded = F.when(F.col("text").rlike("(?i)licensed|rights reserved"), "by title").otherwise("in scope")
    d = load(spark, sf, "documents").select("doc_id", "lang", worded.alias("worded"))
    return (
        d.join(listed, "doc_id", "left")
        .groupBy(F.coalesce("listed", "worded").alias("reason"), "lang")
        .agg(F.count("*").alias("documents"))
    )


@query(
    "doc_threshold",
    """WITH l AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: x <> '') AS ls FROM documents),
    f AS (SELECT doc_id, len(ls) AS total, len(list_filter(ls, lambda x: length(x) < 120)) AS flagged FROM l)
    SELECT doc_id, flagged, total, flagged / total AS share FROM f WHERE flagged >= 3 AND flagged / total >= 0.5""",
)
def doc_threshold(spark, sf):
    """Documents with at least three flagged rows that are at least half of their rows; both
    counts are read inside the document's own row."""
    lines = F.filter(F.split("text", "\n"), lambda x: x != "")
    d = load(spark, sf, "documents").select("doc_id", lines.alias("ls"))
    d = staged(d, total=F.size("ls"), flagged=F.size(F.filter("ls", lambda x: F.length(x) < 120)))
    return (
        d.select("doc_id", "flagged", "total", F.try_divide("flagged", "total").alias("share"))
        .where((F.col("flagged") >= 3) & (F.col("share") >= 0.5))
    )


SEARCH = "in the tha ere"
TERMS_SQL = " AND ".join(rf"regexp_matches({{0}}, '(?i)(?:^|[^\pL\pN_]){t}')" for t in ("tha", "ere"))
HITS_SQL = f"""h AS (SELECT doc_id, lang, source, n_chars, {TERMS_SQL.format('split_part(text, chr(10), 1)')} AS in_title, CASE WHEN quality IS NULL THEN 0 WHEN toxic = 1 THEN 1 WHEN quality = 0 THEN 2 ELSE 3 END AS stage
  FROM documents LEFT JOIN labels USING (doc_id) WHERE {TERMS_SQL.format('text')} AND lang = 'en')"""


def hits(spark, sf):
    terms = corpus.search_terms(SEARCH)
    stage = F.when(F.col("quality").isNull(), 0).when(F.col("toxic") == 1, 1).when(F.col("quality") == 0, 2).otherwise(3)
    d = load(spark, sf, "documents").where("lang = 'en'").where(corpus.matches_all(F.col("text"), terms))
    return d.join(load(spark, sf, "labels"), "doc_id", "left").select(
        "doc_id",
        "source",
        "n_chars",
        corpus.matches_all(F.substring_index("text", "\n", 1), terms).alias("in_title"),
        stage.alias("stage"),
    )


@query(
    "topic_search",
    f"WITH {HITS_SQL} SELECT doc_id, in_title, stage FROM h",
)
def topic_search(spark, sf):
    """All results of a topic, with what a reader's view sorts by."""
    return hits(spark, sf).select("doc_id", "in_title", "stage")


@query(
    "topic_summary",
    f"WITH {HITS_SQL} SELECT count(*) AS hits, count(*) FILTER (WHERE in_title) AS in_title, count(*) FILTER (WHERE stage = 0) AS waiting, count(DISTINCT source) AS sources, CAST(sum(n_chars) AS BIGINT) AS chars FROM h",
)
def topic_summary(spark, sf):
    return hits(spark, sf).agg(
        F.count("*").alias("hits"),
        F.count_if("in_title").alias("in_title"),
        F.count_if(F.col("stage") == 0).alias("waiting"),
        F.countDistinct("source").alias("sources"),
        F.sum("n_chars").alias("chars"),
    )


QUIET_SQL = "q AS (SELECT d.*, EXISTS (SELECT 1 FROM documents o JOIN labels USING (doc_id) WHERE md5(o.text) = md5(d.text)) AS read_elsewhere FROM documents d WHERE doc_id NOT IN (SELECT doc_id FROM labels))"


def quiet(spark, sf):
    """Documents with nothing indexed of their own, and whether a copy of them is."""
    d, l = load(spark, sf, "documents"), load(spark, sf, "labels").select("doc_id")
    own = d.join(l, "doc_id", "left_anti").withColumn("h", F.md5("text"))
    indexed = d.join(l, "doc_id", "left_semi").select(F.md5("text").alias("h")).distinct().withColumn("read_elsewhere", F.lit(True))
    return own.join(indexed, "h", "left").na.fill({"read_elsewhere": False})


@query(
    "quiet_documents",
    f"WITH {QUIET_SQL} SELECT lang, count(*) AS quiet, count(*) FILTER (WHERE read_elsewhere) AS read_elsewhere FROM q GROUP BY lang",
)
def quiet_documents(spark, sf):
    return quiet(spark, sf).groupBy("lang").agg(
        F.count("*").alias("quiet"), F.count_if("read_elsewhere").alias("read_elsewhere")
    )


@query(
    "quiet_search",
    f"WITH {QUIET_SQL} SELECT doc_id, read_elsewhere FROM q WHERE {TERMS_SQL.format('text')}",
)
def quiet_search(spark, sf):
    terms = corpus.search_terms(SEARCH)
    return (
        quiet(spark, sf)
        .where(corpus.matches_all(F.col("text"), terms))
        .select("doc_id", "read_elsewhere")
    )


@query(
    "stratified_sample",
    """WITH s AS (SELECT doc_id, lang, CASE WHEN quality = 1 AND toxic = 1 THEN 'targeted' WHEN quality IS NULL THEN 'unread' ELSE 'quality ' || quality END AS stratum FROM documents LEFT JOIN labels USING (doc_id)),
    r AS (SELECT doc_id, lang, stratum, CAST(row_number() OVER (PARTITION BY lang, stratum ORDER BY md5(doc_id || ':1')) AS INTEGER) AS place FROM s)
    SELECT doc_id, lang, stratum, place FROM r WHERE place <= 8 OR stratum = 'targeted'""",
)
def stratified_sample(spark, sf):
    """Eight of each stratum, and the targeted stratum whole."""
    stratum = (
        F.when((F.col("quality") == 1) & (F.col("toxic") == 1), "targeted")
        .when(F.col("quality").isNull(), "unread")
        .otherwise(F.concat(F.lit("quality "), F.col("quality").cast("string")))
    )
    s = load(spark, sf, "documents").select("doc_id", "lang").join(load(spark, sf, "labels"), "doc_id", "left")
    s = s.select("doc_id", "lang", stratum.alias("stratum"))
    drawn = corpus.exact_sample(s.where("stratum <> 'targeted'"), ["lang", "stratum"], F.col("doc_id"), 1, 8)
    whole = s.where("stratum = 'targeted'").withColumn("_d", F.md5(F.concat(F.col("doc_id").cast("string"), F.lit(":1"))))
    # The whole stratum keeps its draw order too: a rank over every row of it, by bucketed counts.
    b = whole.withColumn("_b", F.substring("_d", 1, 3))
    inner = b.withColumn("_i", F.row_number().over(_by("lang", "_b").orderBy("_d")))
    offset = b.groupBy("lang", "_b").agg(F.count("*").alias("_n"))
    offset = offset.withColumn("_o", F.coalesce(F.sum("_n").over(_by("lang").orderBy("_b").rowsBetween(-(1 << 31), -1)), F.lit(0)))
    ranked = inner.join(offset.select("lang", "_b", "_o"), ["lang", "_b"]).select(
        "doc_id", "lang", "stratum", (F.col("_i") + F.col("_o")).cast("int").alias("place")
    )
    return drawn.select("doc_id", "lang", "stratum", "place").unionByName(ranked)


def _by(*cols):
    return Window.partitionBy(*cols)


# --- response documents -----------------------------------------------------------------------


@query(
    "dated_commitments",
    """SELECT o_orderkey AS doc_id, CAST(count(*) AS BIGINT) AS sentences FROM orders, range(1, 7) AS g(i)
    WHERE i <= o_orderkey % 6 + 1 AND (o_orderkey + o_custkey + 5 * i) % 15 = 3 GROUP BY 1""",
)
def dated_commitments(spark, sf):
    """Sentences with a future verb and a date, counted within each document's own row."""
    s = F.split(tx.squeeze(F.col("text")), r"(?<=[.!?])\s+")
    dated = F.filter(s, lambda x: x.rlike(wording.WHEN) & x.rlike(wording.FUTURE))
    d = answers(spark, sf).select("doc_id", dated.alias("s"))
    return staged(d, sentences=F.size("s").cast("bigint")).where("sentences > 0").select("doc_id", "sentences")


def indexed(spark, sf):
    return segments.best_per_label(segments.candidates(answers(spark, sf), "doc_id", "text")).select("doc_id", "label", "asked")


SOURCE_LABEL = r"(?i)Recommendation\s*(?:no\.?\s*)?(\d{1,3}(?:\.\d{1,3})?)"


@query(
    "provenance_check",
    f"""WITH {FOUND} SELECT CASE WHEN doc_id % 10 = 3 THEN 'text not in source' WHEN doc_id % 10 = 7 THEN 'label does not match' ELSE 'verified' END AS outcome, count(*) AS rows FROM found GROUP BY 1""",
)
def provenance_check(spark, sf):
    """Every quotation against its source, with planted faults: a changed word, a wrong label."""
    return faulty(spark, sf).groupBy("outcome").agg(F.count("*").alias("rows"))


def faulty(spark, sf):
    docs = answers(spark, sf)
    rows = indexed(spark, sf).withColumn(
        "asked", F.when(F.col("doc_id") % 10 == 3, F.regexp_replace("asked", "program", "programme")).otherwise(F.col("asked"))
    ).withColumn(
        "label", F.when(F.col("doc_id") % 10 == 7, F.concat(F.lit("9"), F.col("label"))).otherwise(F.col("label"))
    )
    return corpus.provenance(rows, docs, SOURCE_LABEL)


@query(
    "verified_share",
    f"""WITH {FOUND}, v AS (SELECT doc_id % 10 NOT IN (3, 7) AS ok FROM found)
    SELECT count(*) AS rows, count(*) FILTER (WHERE ok) AS verified, count(*) FILTER (WHERE ok) >= 0.5 * count(*) AS believable FROM v""",
)
def verified_share(spark, sf):
    """The floor under the check itself: with less than half verified, the check is what is broken."""
    return corpus.verified_share(faulty(spark, sf), 0.5)


@query(
    "negative_control",
    f"""WITH {FOUND}, f AS (SELECT *, asked LIKE '%. Dissenting report' AS sfx, r IS NULL AS green, dense_rank() OVER (ORDER BY doc_id) AS place FROM found),
    d AS (SELECT DISTINCT doc_id, dissents, p FROM body_item)
    SELECT CAST(s AS INTEGER) AS step, count(*) AS rows,
      count(*) FILTER (WHERE a.p = b.p AND CASE WHEN b.green THEN (SELECT dissents FROM d WHERE d.doc_id = a.doc_id)
        ELSE a.r IS NOT NULL AND (NOT b.sfx OR a.sfx) END) AS still_pass
    FROM f a, (VALUES (1), (37)) AS t(s) JOIN f b ON b.place = a.place + s AND b.label = a.label GROUP BY s""",
)
def negative_control(spark, sf):
    """Each row with its neighbour's quotation: a check that passes these checks nothing."""
    docs, rows = answers(spark, sf), indexed(spark, sf)
    # documents are counted off, so that gaps between their ids lose no pair
    order = scans.global_position(rows.select("doc_id", F.floor(F.col("doc_id") / (1 << 24)).alias("part")).distinct(), "part", "doc_id", "place")
    placed = rows.join(order.select("doc_id", "place"), "doc_id")
    swapped = (
        scans.neighbours(placed, ["label"], "place", ["asked"], [1, 37], "other_")
        .where("other_asked IS NOT NULL")
        .select("doc_id", "label", F.col("other_asked").alias("asked"), "step")
    )
    checked = corpus.provenance(swapped, docs, SOURCE_LABEL)
    return checked.groupBy("step").agg(
        F.count("*").alias("rows"), F.count_if(F.col("outcome") == "verified").alias("still_pass")
    )


ANSWER_DOCS = """doc AS (SELECT doc_id, trim(regexp_replace('Government response to the ' || any_value(body) || ' Committee report '
      || CASE WHEN doc_id % 4 = 0 THEN 'Summary Recommendation 1 ........ 4 Recommendation 2 ........ 5 ' ELSE '' END || string_agg('Recommendation ' || i || CASE WHEN r = 12 THEN ' Supported ' ELSE ' ' END
      || CASE r WHEN 13 THEN 'The committee recommends that the G overnment f und program ' || p || ' as a matter of urgency now' WHEN 14 THEN 'Funding of program ' || p || ' was considered at length by members in the course of hearings'
           ELSE 'The committee recommends that the Australian Government fund program ' || p || ' for ' || i || ' further years and report to the parliament' END || '. ' || {said} || ' ', '' ORDER BY i)
      || CASE WHEN bool_or(dissents) THEN 'Dissenting report Recommendation 1 The Australian Greens recommend that the Australian Government double the funding of program ' || any_value(p) || ' without any delay.' ELSE '' END, '\\s+', ' ', 'g')) AS doc
    FROM item GROUP BY doc_id)""".format(said="CASE r " + " ".join(f"WHEN {r} THEN '{said}'" for r, said in _SAID.items()) + " ELSE '' END")


@query(
    "answer_context",
    f"""WITH {FOUND}, {ANSWER_DOCS}, n AS (SELECT doc_id, label, said, doc, strpos(doc, said) AS spot FROM found JOIN doc USING (doc_id) WHERE said <> '')
    SELECT doc_id, label, CAST(length(said) AS INTEGER) AS needle, CAST((length(doc) - length(replace(doc, said, ''))) / length(said) AS INTEGER) AS places,
      substr(doc, greatest(spot - 400, 1), spot - greatest(spot - 400, 1)) AS above FROM n""",
)
def answer_context(spark, sf):
    """Where each answer stands: the words it is found by, at how many places, and what is printed above the first."""
    best = segments.best_per_label(segments.candidates(answers(spark, sf), "doc_id", "text"))
    return corpus.answer_context(best.select("doc_id", "label", "said"), answers(spark, sf))


@query(
    "provenance_positions",
    """WITH i AS (SELECT o_orderkey AS doc_id, i, (o_orderkey + i) % 4 AS v, o_orderkey % 9 = 0 AND i = 2 AS planted FROM orders, range(1, 6) g(i))
    SELECT doc_id, i::VARCHAR AS label, CASE v WHEN 0 THEN 'Accept' WHEN 1 THEN CASE WHEN planted THEN 'Accept' ELSE 'Accept in principle' END WHEN 2 THEN 'Note' ELSE 'Accept' END AS claimed,
      CASE WHEN planted AND v = 1 THEN 'does not state that verdict' WHEN v = 3 AND i = 4 THEN 'does not state that verdict' ELSE 'verified' END AS outcome FROM i""",
)
def provenance_positions(spark, sf):
    """Is the verdict a row claims the whole verdict stated under its own label?

    The claim must follow a colon, and what follows it may not continue it in lower
    case: "Accept" is not what "Accept in principle" says.
    """
    key = F.col("o_orderkey")
    o = load(spark, sf, "orders").select(key.alias("doc_id"), F.explode(F.sequence(F.lit(1), F.lit(5))).alias("i"))
    v = (F.col("doc_id") + F.col("i")) % 4
    planted = (F.col("doc_id") % 9 == 0) & (F.col("i") == 2)
    said = F.when(v == 0, "Accept").when(v == 1, "Accept in principle").when(v == 2, "Note").otherwise(
        F.when(F.col("i") == 4, "Under consideration").otherwise("Accept")
    )
    claimed = F.when(v == 0, "Accept").when(v == 1, F.when(planted, "Accept").otherwise("Accept in principle")).when(v == 2, "Note").otherwise("Accept")
    rows = o.select("doc_id", F.col("i").cast("string").alias("label"), claimed.alias("claimed"))
    docs = o.select(
        "doc_id", "i",
        F.concat(F.lit("Response to Recommendation "), F.col("i").cast("string"), F.lit("\nResponse: "), said, F.lit("\nThe program continues.\n")).alias("part"),
    ).groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "part"))), lambda x: x["part"]), "").alias("text"))
    marks = segments.marked(docs, "doc_id", "text", r"Response to Recommendation (\d{1,3}(?:\.\d{1,3})?)\n", look_back=14)
    j = rows.join(marks.select("doc_id", "label", "segment"), ["doc_id", "label"], "left")
    stated = F.regexp_extract("segment", r":\s*([A-Z][^:\n]*?)\s*(?:\n[A-Z]|\n*$)", 1)
    return j.select(
        "doc_id", "label", "claimed",
        F.when(F.col("segment").isNull(), "no window for the label").when(stated == F.col("claimed"), "verified").otherwise("does not state that verdict").alias("outcome"),
    )


# --- reports ----------------------------------------------------------------------------------


def reports(spark, sf):
    """Report texts per order, one item for every way a report ends an item, some with a dissent."""
    key, p = F.col("o_orderkey"), F.col("o_custkey").cast("string")
    endings = F.array(
        *[
            F.lit(e)
            for e in (
                "\nThanks\n1.5 The next paragraph begins here.",
                "\n12 Footnote text of the page.",
                "\nSenator Jane Doe\nChair\nThanks to all.",
                "\nChapter 2\nMore text.",
                "26",
                "\nCommittee View\nThe committee is content.",
            )
        ]
    )

    def item(i):
        return F.concat(
            F.lit("\nRecommendation "),
            i.cast("string"),
            F.lit("\n1."),
            i.cast("string"),
            F.lit(" The committee recommends that program "),
            p,
            F.lit(" be extended by "),
            i.cast("string"),
            F.lit(" years."),
            F.element_at(endings, ((key + i) % 6 + 1).cast("int")),
            F.lit("\n"),
        )

    tail = F.when(
        key % 3 == 0,
        F.concat(F.lit("\nDissenting Report - Senator Jane Roe\n\nRecommendation 8\nThat the funding of program "), p, F.lit(" be doubled at once.\n\nRecommendation 9\nAustralian Greens recommend that program "), p, F.lit(" be closed now.\n")),
    ).when(
        key % 3 == 1,
        F.concat(F.lit("\nRecommendation 8\nI recommend that program "), p, F.lit(" be closed without delay.\nMs Kate Lane MP\nIndependent Member for Curtin\n")),
    ).otherwise("")
    body = F.concat(
        F.lit("Chapter 1\nIntroduction.\n"),
        F.array_join(F.transform(F.sequence(F.lit(1), (key % 4 + 1).cast("int")), item), ""),
        tail,
    )
    return load(spark, sf, "orders").select(key.alias("doc_id"), body.alias("text"))


REPORTS_SQL = """b AS (SELECT o_orderkey AS doc_id, o_custkey AS p, i, 'The committee recommends that program ' || o_custkey || ' be extended by ' || i || ' years' AS asked, '' AS author, '' AS basis
    FROM orders, range(1, 5) g(i) WHERE i <= o_orderkey % 4 + 1),
  x AS (SELECT doc_id, i, asked, author, basis FROM b
    UNION ALL SELECT o_orderkey, 8, 'That the funding of program ' || o_custkey || ' be doubled at once', 'Dissenting Report', 'section' FROM orders WHERE o_orderkey % 3 = 0
    UNION ALL SELECT o_orderkey, 9, 'Australian Greens recommend that program ' || o_custkey || ' be closed now', 'Australian Greens', 'named' FROM orders WHERE o_orderkey % 3 = 0
    UNION ALL SELECT o_orderkey, 8, 'I recommend that program ' || o_custkey || ' be closed without delay', 'Ms Kate Lane', 'signed' FROM orders WHERE o_orderkey % 3 = 1)"""


@query("segment_bounded", f"WITH {REPORTS_SQL} SELECT doc_id, i::VARCHAR AS label, asked FROM x")
def segment_bounded(spark, sf):
    return segments.report_segments(reports(spark, sf), "doc_id", "text").where("why = ''").select("doc_id", "label", "asked")


@query(
    "segment_author",
    f"WITH {REPORTS_SQL} SELECT doc_id, i::VARCHAR AS label, author, basis AS author_basis FROM x WHERE author <> ''",
)
def segment_author(spark, sf):
    s = segments.report_segments(reports(spark, sf), "doc_id", "text")
    return s.where("author <> ''").select("doc_id", "label", "author", "author_basis")


@query(
    "best_report_label",
    f"""WITH {REPORTS_SQL}, again AS (SELECT o_orderkey AS doc_id, 1 AS i, 'The Nationals recommend program ' || o_custkey || ' go and that it must' AS asked, 'Nationals' AS author, 'named' AS basis FROM orders WHERE o_orderkey % 5 = 0
      UNION ALL SELECT o_orderkey, 20, CASE WHEN o_orderkey % 2 = 0 THEN 'That program ' || o_custkey || ' must be kept for some years' ELSE 'That program ' || o_custkey || ' must be kept for many more years' END, '', '' FROM orders WHERE o_orderkey % 3 = 2),
    u AS (SELECT * FROM x UNION ALL SELECT * FROM again)
    SELECT doc_id, i::VARCHAR AS label, asked, author, basis AS author_basis FROM u QUALIFY row_number() OVER (PARTITION BY doc_id, i ORDER BY author <> '', length(asked)) = 1""",
)
def best_report_label(spark, sf):
    """The reports with a label that restarts under a party, and one printed twice."""
    key, p = F.col("o_orderkey"), F.col("o_custkey").cast("string")
    orders = load(spark, sf, "orders").select(key.alias("doc_id"), F.col("o_custkey").cast("string").alias("p"))
    more = F.concat(
        F.when(
            F.col("doc_id") % 3 == 2,
            F.concat(
                F.lit("\nRecommendation 20\nThat program "), F.col("p"), F.lit(" must be kept for many more years\nChapter 3\n"),
                F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("\nRecommendation 20\nThat program "), F.col("p"), F.lit(" must be kept for some years\nChapter 4\n"))).otherwise(""),
            ),
        ).otherwise(""),
        F.when(F.col("doc_id") % 5 == 0, F.concat(F.lit("\nRecommendation 1\nThe Nationals recommend program "), F.col("p"), F.lit(" go and that it must.\n"))).otherwise(""),
    )
    docs = reports(spark, sf).join(orders, "doc_id").select("doc_id", F.concat("text", more).alias("text"))
    return segments.best_report_label(segments.report_segments(docs, "doc_id", "text"))


PROSE_SAID = {
    0: "The Government agrees-in-principle to this recommendation. Work on program {p} is under way.",
    1: "The Government notes this recommendation. All of program {p} will be implemented with regard to the recommendations of the review.",
    3: "The Government accepts this recommendation. As noted in the response to\nrecommendation 2, on program {p}, work goes on.",
    4: "The Government does not support this recommendation.",
}


def prose(spark, sf):
    """Responses in prose, one per order: answers, bare mentions, a heading in the contents, a page's own line."""
    key, party = F.col("o_orderkey"), F.col("o_custkey").cast("string")

    def item(i):
        form, n = listed(i), i.cast("string")
        said = F.lit("")
        for f, words in PROSE_SAID.items():
            before, *after = words.split("{p}")
            said = F.when(form == f, F.concat(F.lit(before), *([party, F.lit(after[0])] if after else []))).otherwise(said)
        return F.concat(
            F.lit("Recommendation "), n, F.when(form == 0, F.concat(F.lit(": Program "), party)).otherwise(""), F.lit("\n"),
            F.when(form == 2, "This recommendation is contained in the confidential interim report.\n").otherwise(
                F.concat(F.lit("That the program be funded.\n\n"), said, F.lit("\nGovernment Response Review "), n, F.lit("\n"))
            ),
        )

    def listed(i):
        return (key + F.col("o_custkey") + i) % 6

    items = F.sequence(F.lit(1), (key % 4 + 3).cast("int"))
    contents = F.transform(F.filter(items, lambda i: listed(i) == 5), lambda i: F.concat(F.lit("Recommendation "), i.cast("string"), F.lit(" ........ 7\n")))
    body = F.array_join(F.concat(contents, F.transform(F.filter(items, lambda i: listed(i) != 5), item)), "")
    return load(spark, sf, "orders").select(key.alias("doc_id"), F.lit("Government Response Review").alias("title"), body.alias("text"))


@query(
    "prose_answers",
    """WITH i AS (SELECT o_orderkey AS doc_id, i, o_custkey AS p, (o_orderkey + o_custkey + i) % 6 AS f FROM orders, range(1, 7) g(i) WHERE i <= o_orderkey % 4 + 3)
    SELECT doc_id, i::VARCHAR AS label, CASE WHEN f IN (1, 2) THEN 'noted' ELSE 'position' END AS state, CASE f WHEN 0 THEN 'in part or in principle' WHEN 3 THEN 'accepted' WHEN 4 THEN 'not accepted' ELSE '' END AS verdict,
      CASE f WHEN 0 THEN 'The Government agrees-in-principle' WHEN 3 THEN 'The Government accepts' WHEN 4 THEN 'The Government does not support' ELSE '' END AS stated,
      CASE f WHEN 0 THEN 'The Government agrees-in-principle to this recommendation. Work on program ' || p || ' is under way.'
        WHEN 1 THEN 'The Government notes this recommendation. All of program ' || p || ' will be implemented with regard to the recommendations of the review.'
        WHEN 3 THEN 'The Government accepts this recommendation. As noted in the response to recommendation 2, on program ' || p || ', work goes on.'
        WHEN 4 THEN 'The Government does not support this recommendation.' ELSE '' END AS said,
      CASE f WHEN 2 THEN 'named in the response, and no position on it is stated' ELSE '' END AS note
    FROM i WHERE f <> 5""",
)
def prose_answers(spark, sf):
    docs = prose(spark, sf)
    return segments.prose_answers(docs, "doc_id", "text", corpus.furniture(docs, times=1).select("doc_id", "line"))


LONG_LABEL = r"(?m)^[ \t]*Recommendation[ \t]+(\d{1,3}\.\d{1,3})[ \t]*:?"


@query(
    "segment_shortest",
    """WITH i AS (SELECT o_orderkey AS doc_id, o_custkey AS p, i, o_orderkey % 4 + 1 AS n FROM orders, range(1, 5) g(i) WHERE i <= o_orderkey % 4 + 1)
    SELECT doc_id, '2.' || i AS label, CASE WHEN (doc_id + i) % 7 = 0 THEN '' ELSE 'Fund program ' || p || ' for ' || i || ' years with a review after each of them' END AS asked,
      CASE WHEN (doc_id + i) % 7 = 0 THEN 'listed in the contents and nowhere else' ELSE '' END AS note, CAST(CASE WHEN (doc_id + i) % 7 = 0 THEN 1 ELSE 3 END AS BIGINT) AS occurrences FROM i""",
)
def segment_shortest(spark, sf):
    """Long reports print an item in the contents, in a list and in the body."""
    key, p = F.col("o_orderkey"), F.col("o_custkey").cast("string")
    n = F.sequence(F.lit(1), (key % 4 + 1).cast("int"))
    kept = F.filter(n, lambda i: (key + i) % 7 != 0)

    def lines(which, make):
        return F.array_join(F.transform(which, make), "")

    def words(i):
        return F.concat(F.lit("Fund program "), p, F.lit(" for "), i.cast("string"), F.lit(" years with a review after each of them."))

    def head(i):
        return F.concat(F.lit("Recommendation 2."), i.cast("string"))

    body = F.concat(
        F.lit("Contents\n"),
        lines(n, lambda i: F.concat(head(i), F.lit(" Funding ........ "), i.cast("string"), F.lit("\n"))),
        F.lit("Glossary\nTerms are listed here.\n"),
        lines(kept, lambda i: F.concat(head(i), F.lit(": "), words(i), F.lit("\nNext steps\n"))),
        F.lit("Chapter 2\nMore text.\n"),
        lines(kept, lambda i: F.concat(head(i), F.lit("\n"), words(i), F.lit(" It should\nalso be published. (Chapter 9: Money)\n6.54. The report goes on.\n"))),
    )
    docs = load(spark, sf, "orders").select(key.alias("doc_id"), body.alias("text"))
    return segments.shortest_usable(docs, "doc_id", "text", LONG_LABEL).drop("pos")


@query(
    "named_not_answered",
    """SELECT o_orderkey AS doc_id, i::VARCHAR AS label, 'The Government response notes these items, which are addressed to the states alone.' AS caption
    FROM orders, range(1, 9) g(i) WHERE i <= o_orderkey % 8 + 1 AND i <> 3 AND (o_orderkey % 8 + 1 - CASE WHEN o_orderkey % 8 + 1 >= 3 THEN 1 ELSE 0 END) >= 5""",
)
def named_not_answered(spark, sf):
    key = F.col("o_orderkey")
    n = F.sequence(F.lit(1), (key % 8 + 1).cast("int"))
    body = F.concat(
        F.lit("Preface.\nThe Government response notes these items,\nwhich are addressed to the states alone.\nList\n"),
        F.array_join(F.transform(n, lambda i: F.concat(i.cast("string"), F.lit(" Title of item\n"))), ""),
    )
    unanswered = F.transform(F.filter(n, lambda i: i != 3), lambda i: i.cast("string"))
    docs = load(spark, sf, "orders").select(key.alias("doc_id"), body.alias("text"), unanswered.alias("u"))
    return corpus.named_in_a_list(docs, "u")
