"""The registered queries of the operators, and the SQL of those that SQL can express."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duebook.llm import ann, exact_dedup, html_extract, langid, near_dedup, packing, quality, secrets, sentencepiece_codec, suffix_dedup, variants, warc, word_runs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def op1_probminhash(spark, sf_dir):
    found = near_dedup.classes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "copies", (F.col("doc_id") == F.col("class_id")).alias("kept"))


@query
def op2_exact_dedup(spark, sf_dir):
    return exact_dedup.report(table(spark, sf_dir, "documents"))


@query
def op3_packing(spark, sf_dir):
    p = packing.pack(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))
    return p.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query
def op4_quality(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held = langid.held_out(F.col("doc_id"), 4, 2)
    net = quality.learned(docs, labels.where(~held))
    scored = quality.score(docs.select("doc_id", held.alias("held_out"), "text"), net)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query
def op5_secrets(spark, sf_dir):
    found = secrets.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"), "spans", "n_live", "n_copied", "owners", "repos")


@query
def op6_warc(spark, sf_dir):
    return warc.archive(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "urlkey", "captured")


@query
def op7_langid(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held = langid.held_out(F.col("doc_id"), 3, 1)
    model = langid.learned(docs.where(~held))
    return langid.identify(docs.select("doc_id", held.alias("held_out"), "text"), model).select("doc_id", "held_out", "lang_pred", "score", "cross_entropy", "accepted")


@query
def op8_html(spark, sf_dir):
    return html_extract.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


@query
def op9_ann(spark, sf_dir):
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query
def op10_sentencepiece(spark, sf_dir):
    path = tokenizer("piece_bpe_32k.model")
    ids = sentencepiece_codec.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), path).drop("text")
    ids = ids.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"))
    return sentencepiece_codec.decode(ids, path).select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op11_variants(spark, sf_dir):
    return variants.group(variants.vocabulary(table(spark, sf_dir, "documents")))


def replayed(doc_id, words: list[bytes]) -> list[bytes]:
    """One document in ten goes round in its own words from a place on; a null id is none of them."""
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if doc_id is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * ((n - a) // p + 1))[: n - a]


@query
def op12_word_runs(spark, sf_dir):
    found = word_runs.detect(table(spark, sf_dir, "documents").select("doc_id", "text"), prepare=replayed)
    top = F.array_min(F.transform("runs", lambda r: F.struct((-r.length).alias("less"), r.start.alias("start"), r.period.alias("period"))))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n")))
    return found.withColumn("top", top).select(
        "doc_id", "n_runs", "top.start", (-F.col("top.less")).alias("length"), "top.period",
        F.floor(-1000 * F.col("top.less") / F.col("top.period")).alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query
def op13_suffix_dedup(spark, sf_dir):
    out = suffix_dedup.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


ORACLES["op2_exact_dedup"] = """
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(translate(coalesce(text, ''), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) AS text_sha256
  FROM documents
)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = first_value(doc_id) OVER w AS kept, text_sha256
FROM d
WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id)
"""

ORACLES["op6_warc"] = """
WITH p AS (
  SELECT page_id, url, encode(coalesce(html, '')) AS raw FROM pages
), d AS (
  SELECT page_id, url, octet_length(raw) AS payload_bytes, sha1(raw) AS payload_digest FROM p
), m AS (
  SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS holder FROM d
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN holder = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN holder <> page_id THEN holder END AS refers_to,
       array_to_string(list_reverse(string_split(regexp_replace(lower(regexp_extract(url, '://([^/?#:]*)', 1)), '^www[.]', ''), '.')), ',')
         || ')' || lower(regexp_extract(url, '://[^/?#]*([^#]*)', 1)) AS urlkey,
       strftime(TIMESTAMP '2024-01-01' + to_seconds(page_id), '%Y-%m-%dT%H:%M:%SZ') AS captured
FROM m
"""


def matched(kind: str, pattern: str, flags: str, group: int, least: int) -> str:
    """SQL of one kind's spans: gaps between matches and their lengths add up to the starts."""
    return f"""
SELECT doc_id, {secrets.ORDER.index(kind)} AS k, '{kind}' AS kind, start, start + len AS stop, value FROM (
  SELECT doc_id, i, len, value, sum(gap + len) OVER (PARTITION BY doc_id ORDER BY i) - len AS start FROM (
    SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, length(unnest(w)) AS len, unnest(v) AS value, length(unnest(g[1:len(w)])) AS gap FROM (
      SELECT doc_id, regexp_extract_all(text, '{pattern}', 0{flags}) AS w, regexp_extract_all(text, '{pattern}', {group}{flags}) AS v,
             string_split_regex(text, '{"(?i)" if flags else ""}{pattern}') AS g
      FROM t)))
WHERE length(value) >= {least}"""


def secrets_sql() -> str:
    parts = []
    for kind in secrets.ORDER:
        pattern, group, least = secrets.KINDS[kind]
        flags = ", 'i'" if pattern.startswith("(?i)") else ""
        parts.append(matched(kind, pattern.removeprefix("(?i)").replace("'", "''"), flags, group, least))
    return f"""
WITH t AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
s AS ({" UNION ALL ".join(parts)}),
o AS (SELECT value, count(DISTINCT source) AS owners, count(DISTINCT doc_id) AS repos FROM s JOIN t USING (doc_id) GROUP BY value),
a AS (
  SELECT doc_id, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, k) FILTER (k < 3) AS base,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, k) AS spans,
         count(*) FILTER (owners < 3 AND repos < 100) AS n_live, count(*) FILTER (owners >= 3 OR repos >= 100) AS n_copied,
         max(owners) AS owners, max(repos) AS repos
  FROM s JOIN o USING (value) GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_copied, 0) AS n_copied,
       coalesce(owners, 0) AS owners, coalesce(repos, 0) AS repos
FROM t LEFT JOIN a USING (doc_id)
"""


ORACLES["op5_secrets"] = secrets_sql()
