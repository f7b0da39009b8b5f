"""Secret scans, native: DataFrame functions only.

Candidates are found by pattern and set against the whole corpus. Each candidate's value is
hashed; the hashes are counted by distinct repositories and distinct owners with partial
aggregation. A value that many owners carry, or very many repositories of a few, is an example that
was copied about; a value that one owner keeps in some repositories looks live. The count never
gathers a group: a value that a third of the table carries is one partial row per task, and the
counts of the few values that many spans carry go back by broadcast.

A private key is the block from its BEGIN line to its END line, or without one to the end of its
base64 lines, and its value is the base64 of the body, however that is wrapped, quoted or escaped. A
header that no key follows is its own value.

Positions are code points. `split` and `regexp_extract_all` walk a text alike (leftmost, not
overlapping), so the lengths of the pieces and matches between them add up to every start; the
running sum is a window over the matches of one text and kind, or, for the bulk of texts, over
an array that holds few of them.

Cases. Null text counts as empty and has no spans. A repeated row is scanned once per copy and
counts as one repository. A null repository or owner counts as one of its own. Ties between
spans at one start go by the order of the kinds. An empty table gives an empty result. `scan`
returns columns of its own only; `redact` keeps all others, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duebook.llm import common

#: kind: (pattern, group of the value, least length of the value). Fixed values for the first
#: three; `vendor` is the method's own: key formats that state what they are.
KINDS = {
    "assign": ("(?i)(password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 8),
    "access": ("AKIA[A-Z0-9]+", 0, 16),
    "hex": ("[0-9a-f]+", 0, 32),
    "vendor": (
        "gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{20,}|sk_live_[A-Za-z0-9]{20,}|AIza[A-Za-z0-9_-]{35}"
        "|eyJ[A-Za-z0-9_-]{8,}\\.eyJ[A-Za-z0-9_-]{8,}\\.[A-Za-z0-9_-]{16,}|-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----",
        0,
        16,
    ),
}
ORDER = list(KINDS)

#: The header as `vendor` has it, its footer, what stands between the lines of a key, and its lines.
HEADER, FOOTER = (f"-----{side} (?:[A-Z]+ )?PRIVATE KEY-----" for side in ("BEGIN", "END"))
BETWEEN = "(?:[\\s\"'`,;#*>|+/]|\\\\+[rnt]?)"
LINE_END = "(?=[\\x20\\t]*+(?:[\\r\\n\"'`\\\\]|\\z))"
LINE = f"(?:[A-Za-z0-9+/=]{{40,}}+|[A-Za-z0-9+/=]{{16,}}+{LINE_END})"
#: What may stand before the body: breaks, and fields such as Proc-Type and DEK-Info.
FIELDS = f"{BETWEEN}*+(?:[A-Z][A-Za-z-]*+:\\x20*+[^\\s\\\\\"']++{BETWEEN}*+)*+"
#: The whole key: to its footer, or to the end of its lines, of which the last may be short.
KEY = (
    f"{HEADER}(?:{FIELDS}[A-Za-z0-9+/=]{{16,}}+[^-]*+(?:-(?!----)[^-]*+)*+{FOOTER}"
    f"|{FIELDS}{LINE}(?:{BETWEEN}++{LINE})*+(?:(?=[\\x20\\t\"'`+,]*+[\\r\\n\\\\]){BETWEEN}++[A-Za-z0-9+/=]++{LINE_END})?+)?+"
)


def key_body(value: Column) -> Column:
    """The base64 of a private key; other values, and headers without a key, as they are."""
    body = F.regexp_replace(value, f"{HEADER}|{FOOTER}|\\\\+[rnt]?|[\"'`]\\s*\\+\\s*[\"'`]", "")
    body = F.regexp_replace(body, "[^A-Za-z0-9+/=]", "")
    return F.when(value.startswith("-----BEGIN") & (F.length(body) >= KINDS["vendor"][2]), body).otherwise(value)


def matches(text: Column, kind: str) -> Column:
    """The matches of a kind, in order: (length of the text since the last one, own length, value)."""
    pattern, group, least = KINDS[kind]
    if kind == "hex":  # the same spans as runs of any length with the short ones dropped, in fewer pieces
        pattern = "[0-9a-f]{%d,}" % least
    if kind == "vendor":
        pattern = pattern.replace(HEADER, KEY)
    p = F.lit(pattern)
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    whole = F.transform(F.regexp_extract_all(text, p, F.lit(0)), F.length)
    zipped = F.arrays_zip(gaps.alias("gap"), whole.alias("len"), F.regexp_extract_all(text, p, F.lit(group)).alias("value"))
    found = F.filter(zipped, lambda m: m["len"].isNotNull())  # the piece behind the last match has none
    if kind == "vendor":
        found = F.transform(found, lambda m: F.struct(m["gap"].alias("gap"), m["len"].alias("len"), key_body(m["value"]).alias("value")))
    return found


#: A cheap test whether a kind can occur at all; texts that fail it are not split.
HINT = {
    "assign": "(?i)(?:password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]",
    "access": "AKIA",
    "hex": "[0-9a-f]{32}",
    "vendor": "gh[pousr]_|xox[abprs]-|sk_live_|AIza|eyJ|PRIVATE KEY",
}


def row_key(doc_id: Column, text: Column) -> Column:
    """What tells two rows apart when spans go back to texts: the id and two hashes of the text."""
    return F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("-")), F.hex(F.xxhash64(text)), F.hex(F.xxhash64(F.lit(7), text)))


def candidates(docs: DataFrame, id_col: str, text_col: str, repo_col: str, owner_col: str) -> DataFrame:
    """One narrow row per row of `docs`, with the matches of each kind that has any. Written once."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    by_kind = [
        F.when(text.contains(HINT[kind]) if kind == "access" else text.rlike(HINT[kind]), F.struct(F.lit(k).alias("kind"), matches(text, kind).alias("m")))
        for k, kind in enumerate(ORDER)
    ]
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("doc_id"),
        F.col(repo_col).cast("string").alias("repo"),
        F.col(owner_col).cast("string").alias("owner"),
        row_key(F.col(id_col), text).alias("key"),
        F.array_compact(F.array(*by_kind)).alias("kinds"),
    )
    return common.settle(rows, "candidates")


#: A value of so many spans meets its counts by broadcast: there are at most all spans / HOT of them.
HOT = 10_000


def spans(rows: DataFrame, copied_owners: int = 3, copied_repos: int = 100) -> DataFrame:
    """One row per secret among `candidates`: row, doc_id, key, kind, start, end, value_hash, owners, repos, live.

    `live` is false for a value that at least `copied_owners` owners or `copied_repos` repositories carry."""
    each = rows.select("row", "doc_id", "key", "repo", "owner", F.explode("kinds").alias("k"))
    each = each.select("row", "doc_id", "key", "repo", "owner", F.col("k.kind").alias("kind"), F.posexplode("k.m").alias("place", "m"))
    so_far = Window.partitionBy("row", "kind").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    each = each.withColumn("end", F.sum(F.col("m.gap") + F.col("m.len")).over(so_far))
    least = F.element_at(F.array(*[F.lit(KINDS[k][2]) for k in ORDER]), F.col("kind") + 1)
    each = each.where(F.length("m.value") >= least).select(
        "row", "doc_id", "key", "repo", "owner", "kind", (F.col("end") - F.col("m.len")).alias("start"), "end", F.sha2(F.col("m.value"), 256).alias("value_hash")
    )
    each = common.settle(each, "spans")
    # distinct owners and repositories as counts of distinct pairs: each step combines on the map side
    owners = each.select("value_hash", "owner").distinct().groupBy("value_hash").agg(F.count("*").alias("owners"))
    repos = each.select("value_hash", "repo").distinct().groupBy("value_hash").agg(F.count("*").alias("repos"))
    uses = each.groupBy("value_hash").agg(F.count("*").alias("uses"))
    known = common.settle(owners.join(repos, "value_hash").join(uses, "value_hash"), "ownership")
    hot = known.where(F.col("uses") > HOT)
    copied = (F.col("owners") >= copied_owners) | (F.col("repos") >= copied_repos)
    if hot.isEmpty():
        return each.join(known, "value_hash").drop("uses").withColumn("live", ~copied)
    met = each.join(F.broadcast(hot), "value_hash", "left")
    rest = met.where(F.col("uses").isNull()).select(each.columns).join(known.where(F.col("uses") <= HOT), "value_hash")
    return met.where(F.col("uses").isNotNull()).unionByName(rest).drop("uses").withColumn("live", ~copied)


def listed(only: Column | None = None) -> Column:
    """Spans as kind:start:end by start, then kind as listed, joined by commas."""
    name = F.element_at(F.array(*[F.lit(k) for k in ORDER]), F.col("kind") + 1)
    one = F.struct(F.col("start"), F.col("kind"), F.concat_ws(":", name, "start", "end").alias("s"))
    return F.array_join(F.transform(F.array_sort(F.collect_list(one if only is None else F.when(only, one))), lambda x: x["s"]), ",")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repo_col: str = "doc_id", owner_col: str = "source", copied_owners: int = 3, copied_repos: int = 100) -> DataFrame:
    """One row per row of `docs`: doc_id, n_assign .. n_vendor, n_live, n_copied, base_spans, spans, and
    the most owners and repositories that any of its values has."""
    common.ready(docs.sparkSession)
    rows = candidates(docs, id_col, text_col, repo_col, owner_col)
    # a text's spans are no more than its characters: the list of one row is bounded by its text
    per = spans(rows, copied_owners, copied_repos).groupBy("row").agg(
        *[F.count(F.when(F.col("kind") == i, 1)).alias(f"n_{k}") for i, k in enumerate(ORDER)],
        F.count(F.when(F.col("live"), 1)).alias("n_live"),
        F.count(F.when(~F.col("live"), 1)).alias("n_copied"),
        listed(F.col("kind") < 3).alias("base_spans"),
        listed().alias("spans"),
        F.max("owners").alias("owners"),
        F.max("repos").alias("repos"),
    )
    counts = [f"n_{k}" for k in ORDER] + ["n_live", "n_copied", "owners", "repos"]
    return rows.select("row", "doc_id").join(per, "row", "left").select(
        "doc_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts], *[F.coalesce(c, F.lit("")).alias(c) for c in ("base_spans", "spans")]
    )


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repo_col: str = "doc_id", owner_col: str = "source", copied_owners: int = 3, copied_repos: int = 100, mask: str = "[SECRET]") -> DataFrame:
    """`docs` with every live span replaced by `mask`; copied examples stay. No row is dropped."""
    common.ready(docs.sparkSession)
    rows = candidates(docs, id_col, text_col, repo_col, owner_col)
    live = spans(rows, copied_owners, copied_repos).where("live").select("key", "start", "end").distinct()
    before = Window.partitionBy("key").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    reach = F.coalesce(F.max("end").over(before), F.lit(0))
    # what stands before each span and behind all spans before it; None where a span goes on from the last
    pieces = live.select("key", "start", "end", reach.alias("reach"))
    keep = F.struct(F.col("start"), F.col("end"), F.col("reach"))
    plan = pieces.groupBy("key").agg(F.array_sort(F.collect_list(keep)).alias("__cuts"), F.max("end").alias("__end"))
    marked = docs.withColumn("__key", row_key(F.col(id_col), F.coalesce(F.col(text_col), F.lit(""))))
    text = F.col(text_col)
    parts = F.transform(
        "__cuts",
        lambda c: F.when(c["start"] >= c["reach"], F.concat(F.substring(text, (c["reach"] + 1).cast("int"), (c["start"] - c["reach"]).cast("int")), F.lit(mask))).otherwise(F.lit("")),
    )
    new = F.concat(F.array_join(parts, ""), F.substring(text, (F.col("__end") + 1).cast("int"), F.length(text)))
    joined = marked.join(plan.withColumnRenamed("key", "__key"), "__key", "left")
    return joined.withColumn(text_col, F.when(F.col("__cuts").isNull(), text).otherwise(new)).drop("__key", "__cuts", "__end")
