"""Work over whole text corpora: classes, furniture, provenance, samples, search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from duebook.functions import text as tx, wording
from duebook.functions.wording import Rules
from duebook.operators.fence import by_document, staged


def classify(docs: DataFrame, rules: Rules = Rules(), text: str = "text") -> DataFrame:
    """Add template, notes and acceptance counts and the class they make. A narrow job."""
    t = F.col(text)
    counted = staged(
        docs,
        template_hits=wording.template_hits(t, rules),
        notes=wording.hits(t, rules.notes),
        accepts=wording.hits(t, rules.accepts),
    )
    readable = F.length(tx.strip(t)) >= rules.readable
    # A text too short to read counts nothing.
    counted = counted.select(
        *[c for c in counted.columns if c not in ("template_hits", "notes", "accepts")],
        *[F.when(readable, F.col(c)).otherwise(0).alias(c) for c in ("template_hits", "notes", "accepts")],
    )
    return counted.withColumn(
        "class", wording.document_class(t, F.col("template_hits"), F.col("accepts"), rules.readable)
    )


def furniture(docs: DataFrame, title: str = "title", text: str = "text", times: int = 3, longest: int = 120) -> DataFrame:
    """Lines a document prints on page after page: its own name, as (doc_id, line, times).

    A line is furniture when it starts with the first three words of the title, is
    short, does not end a sentence, and comes back. Lines are reduced on the map side.
    """
    words = F.split(tx.squeeze(F.regexp_replace(title, r"\[.*?\]", " ")), " ")
    stem = F.lower(F.array_join(F.slice(words, 1, 3), " "))
    lines = docs.where(F.size(words) >= 3).select(
        "doc_id", stem.alias("_stem"), F.explode(F.split(text, "\n")).alias("_raw")
    )
    line = tx.strip(F.regexp_replace(tx.squeeze(F.col("_raw")), tx.PAGE_NUMBER, ""))
    lines = staged(lines, line=line)
    opened = F.regexp_replace(F.lower("line"), r"^(?:the |australian )", "")
    named = F.lower(F.col("line")).startswith(F.col("_stem")) | opened.startswith(F.col("_stem"))
    return (
        lines.where(named & (F.length("line") <= longest) & ~F.col("line").endswith("."))
        .groupBy("doc_id", "line")
        .agg(F.count("*").alias("times"))
        .where(F.col("times") >= times)
    )


SHORTEST_PROBE = 30


def quote(words: Column) -> Column:
    """Words as a pattern that matches them literally, whatever they hold."""
    return F.concat(F.lit(r"\Q"), F.replace(words, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))


def provenance(
    rows: DataFrame, sources: DataFrame, label_rx: str, look_back: int = 400, long_probe: bool = False
) -> DataFrame:
    """Is a quotation in its source, under its own label? Adds ``outcome``.

    ``rows`` has (doc_id, label, asked); ``sources`` has (doc_id, text). A probe out of
    the middle of the quotation is looked for at every place it occurs, and the
    nearest label above it must be the row's.
    """
    flat = tx.squeeze(F.col("asked"))
    r = by_document(rows.withColumn("_flat", flat), "doc_id")
    flat = F.col("_flat")
    probe = F.when(F.length(flat) > 190, F.substring(flat, 41, 160 if long_probe else 130)).otherwise(F.right(flat, F.lit(100)))
    r = staged(r, _probe=probe).drop("_flat")
    docs = by_document(sources.select("doc_id", "text"), "doc_id")
    j = r.join(docs.select("doc_id", F.regexp_replace("text", r"\s+", " ").alias("_body")), "doc_id", "left")
    quoted = quote(F.col("_probe"))
    j = staged(j, _pieces=F.split(F.coalesce("_body", F.lit("")), quoted, -1))
    # Pieces that carry the probe which precedes them, so that joining them restores the text.
    j = staged(
        j, _pieces=F.transform("_pieces", lambda p, i: F.when(i > 0, F.concat("_probe", p)).otherwise(p))
    )
    # A probe that is judged has 30 characters or more, and all pieces but the first begin with
    # it: so many of the last ones hold the look-back, however often the probe occurs.
    reach = look_back // SHORTEST_PROBE + 2
    above = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size("_pieces") - 1, F.lit(1))),
        lambda k: F.element_at(
            F.concat(
                F.array(F.lit("")),
                F.regexp_extract_all(
                    F.right(F.array_join(F.slice("_pieces", F.greatest(k - reach + 1, F.lit(1)), F.least(k, F.lit(reach))), ""), F.lit(look_back)),
                    F.lit(label_rx),
                    F.lit(1),
                ),
            ),
            -1,
        ),
    )
    j = staged(j, _above=F.transform(above, lambda x: F.regexp_replace(x, "^0+", "")))
    want = F.regexp_replace("label", "^0+", "")
    outcome = (
        F.when(F.col("_body").isNull(), "source text missing")
        .when(F.length("_probe") < SHORTEST_PROBE, "too short to verify")
        .when(F.size("_pieces") < 2, "text not in source")
        .when(F.array_contains("_above", want), "verified")
        .when(F.forall("_above", lambda x: x == ""), "no label above it")
        .otherwise("label does not match")
    )
    return j.withColumn("outcome", outcome).drop("_probe", "_body", "_pieces", "_above")


def verified_share(checked: DataFrame, floor: float) -> DataFrame:
    """Outcome totals, and whether enough is verified for the check itself to be believed."""
    return checked.agg(
        F.count("*").alias("rows"), F.count_if(F.col("outcome") == "verified").alias("verified")
    ).withColumn("believable", F.col("verified") >= floor * F.col("rows"))


def exact_sample(df: DataFrame, strata: list[str], identity: Column, seed: int, n: int) -> DataFrame:
    """Exactly n rows of each stratum (all, if fewer), the same ones for the same seed.

    Rows are ranked by a hash; the rank filter is applied in every partition before
    the shuffle (a window group limit), so a stratum sends n rows per task at most.
    """
    draw = F.md5(F.concat_ws(":", identity.cast("string"), F.lit(str(seed))))
    order = Window.partitionBy(*strata).orderBy("_draw")
    return (
        df.withColumn("_draw", draw).withColumn("place", F.row_number().over(order)).where(F.col("place") <= n).drop("_draw")
    )


def answer_context(rows: DataFrame, sources: DataFrame, needles=(400, 240, 160, 100, 60), pad: int = 400) -> DataFrame:
    """Where an answer stands in its document: the longest needle found, its places, what is above.

    ``rows`` has (doc_id, label, said); ``sources`` has (doc_id, text).
    """
    r = staged(by_document(rows, "doc_id"), _said=tx.squeeze(F.col("said"))).where("_said <> ''")
    docs = staged(by_document(sources.select("doc_id", "text"), "doc_id"), _doc=tx.squeeze(F.col("text")))
    j = r.join(docs.select("doc_id", "_doc"), "doc_id")
    found = []
    for n in needles:
        needle = F.left("_said", F.lit(n))
        full = F.length("_said") >= n
        found.append(F.when(full & F.col("_doc").contains(needle), needle))
    # An answer shorter than a needle is its own needle, whole.
    whole = F.when((F.length("_said") < needles[0]) & F.col("_doc").contains(F.col("_said")), F.col("_said"))
    j = staged(j, _needle=F.coalesce(whole, *found)).where("_needle IS NOT NULL")
    at = F.instr(F.col("_doc"), F.col("_needle"))
    places = F.size(F.split("_doc", quote(F.col("_needle")), -1)) - 1
    return j.select(
        "doc_id",
        "label",
        F.length("_needle").alias("needle"),
        places.alias("places"),
        F.substring("_doc", F.greatest(at - pad, F.lit(1)), at - F.greatest(at - pad, F.lit(1))).alias("above"),
    )


STOP = "a an and as at by for from in into is of on or the to with".split()


def search_terms(query: str) -> list[str]:
    """The words of a query that mean something; all of them where none does."""
    typed = query.split()
    return [t for t in typed if t.lower() not in STOP] or typed


def word_prefix(term: str) -> str:
    """A pattern for a word that begins with the term."""
    return r"(?i)(?:^|[^\p{L}\p{N}_])\Q" + term.replace(r"\E", "") + r"\E"


def matches_all(text: Column, terms: list[str]) -> Column:
    out = F.lit(True)
    for t in terms:
        out = out & text.rlike(word_prefix(t))
    return out


def named_in_a_list(docs: DataFrame, unanswered: str, text: str = "text", least: int = 5) -> DataFrame:
    """Unanswered labels a document only lists, with the caption above the list.

    Read within the row: a label opens a line, at least ``least`` of them do, and one of
    the three lines above the first of them ends a sentence. The caption is that
    sentence, as many as four lines while they open in lower case.
    """
    d = docs.select("doc_id", F.col(unanswered).alias("_u"), F.split(text, "\n").alias("_lines"))
    hits = F.filter(
        F.transform(
            "_lines",
            lambda l, i: F.struct(F.regexp_extract(l, r"^[ \t]*(\d{1,3}(?:\.\d{1,3})?)[ \t]*[:.]?[ \t]+\S", 1).alias("label"), i.alias("i")),
        ),
        lambda h: F.array_contains("_u", h["label"]),
    )
    d = staged(d, _hits=hits)
    d = staged(
        d,
        _named=F.array_distinct(F.transform("_hits", lambda h: h["label"])),
        _first=F.array_min(F.transform("_hits", lambda h: h["i"])),
    ).where(F.size("_named") >= least)

    def line(i: Column) -> Column:
        return F.coalesce(tx.strip(F.get("_lines", i)), F.lit(""))

    end = F.coalesce(
        *[
            F.when((F.col("_first") >= k) & line(F.col("_first") - k).rlike(r"[.!?]$"), F.col("_first") - k)
            for k in (1, 2, 3)
        ]
    )
    d = staged(d, _end=end).where("_end IS NOT NULL")
    start = F.coalesce(
        *[F.when((F.col("_end") >= k) & ~line(F.col("_end") - k).rlike("^[a-z]"), F.col("_end") - k) for k in (0, 1, 2)],
        F.greatest(F.col("_end") - 3, F.lit(0)),
    )
    d = staged(d, _start=start)
    caption = tx.squeeze(F.array_join(F.slice("_lines", F.col("_start") + 1, F.col("_end") - F.col("_start") + 1), " "))
    d = staged(d, caption=caption).where(F.length("caption") >= 40)
    return d.select("doc_id", F.explode("_named").alias("label"), "caption")
