"""Quality gates. Each returns rows of what is wrong, none when all is well."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from duebook.operators import compare


def violations(df: DataFrame, rules: dict[str, Column], key: Column) -> DataFrame:
    """Rows that break row-level rules, one output row per rule broken, in one pass."""
    broken = F.filter(
        F.array(*[F.when(cond, F.lit(name)) for name, cond in rules.items()]), lambda r: r.isNotNull()
    )
    return df.select(F.explode(broken).alias("rule"), key.cast("string").alias("key"))


def budget(df: DataFrame, rule: str, failing: Column, most: float) -> DataFrame:
    """One row when the failing share of a table is above its budget."""
    return (
        df.agg(F.count_if(failing).alias("bad"), F.count("*").alias("n"))
        .where(F.col("bad") > most * F.col("n"))
        .select(
            F.lit(rule).alias("rule"),
            F.concat_ws("/", F.col("bad").cast("string"), F.col("n").cast("string")).alias("key"),
        )
    )


def duplicates(df: DataFrame, rule: str, key: list[str | Column], label: Column) -> DataFrame:
    """One row per key held more than once."""
    named = [F.col(k).alias(f"_k{i}") if isinstance(k, str) else k.alias(f"_k{i}") for i, k in enumerate(key)]
    return (
        df.select(*named, label.alias("_label"))
        .groupBy(*[f"_k{i}" for i in range(len(named))])
        .agg(F.count("*").alias("n"), F.min("_label").alias("_label"))
        .where("n > 1")
        .select(F.lit(rule).alias("rule"), F.col("_label").cast("string").alias("key"))
    )


def stated_totals(df: DataFrame, stated: DataFrame, source: str, rule: str) -> DataFrame:
    """Rows per source against the total the source states."""
    got = df.groupBy(source).agg(F.count("*").alias("got"))
    return (
        stated.join(got, source, "full_outer")
        .where(F.coalesce("got", F.lit(0)) != F.coalesce("stated", F.lit(0)))
        .select(
            F.lit(rule).alias("rule"),
            F.concat(
                F.col(source), F.lit(": "), F.coalesce("got", F.lit(0)).cast("string"),
                F.lit(" read, "), F.coalesce("stated", F.lit(0)).cast("string"), F.lit(" stated"),
            ).alias("key"),
        )
    )


def not_shrunk(before: DataFrame, after: DataFrame, name: str) -> DataFrame:
    """A table never shrinks: (table, before, after, verdict)."""
    both = before.select(F.lit(0).alias("_side")).unionByName(after.select(F.lit(1).alias("_side")))
    counts = both.agg(F.count_if(F.col("_side") == 0).alias("before"), F.count_if(F.col("_side") == 1).alias("after"))
    return counts.select(
        F.lit(name).alias("table"),
        "before",
        "after",
        F.when(F.col("after") < F.col("before"), "shrank").otherwise("ok").alias("verdict"),
    )


def expect(rule: str, df: DataFrame, holds: Column, detail: Column) -> DataFrame:
    """A rule over one row of totals, with its outcome."""
    return df.select(
        F.lit(rule).alias("rule"), F.coalesce(holds, F.lit(False)).alias("holds"), detail.cast("string").alias("detail")
    )


def volume(df: DataFrame, key: str, held: str, seen: str, new: str, least_share: float = 0.9, most_new: int = 200, least: int = 40) -> DataFrame:
    """Implausible volumes per key: fewer than a share of what is held, too much new, too few."""
    return violations(
        df,
        {
            f"fewer than {least_share:.0%} of held": F.col(seen) < least_share * F.col(held),
            f"more than {most_new} new": F.col(new) > most_new,
            f"fewer than {least} rows": F.col(seen) < least,
        },
        F.col(key),
    )


def guessed(removed: DataFrame, rows: DataFrame, by: str, basis: str = "title match", least: int = 2, share: float = 0.1) -> DataFrame:
    """A register whose removals rest on matching words alone more often than is plausible.

    Any number of removals may rest on a link or a hand entry. ``removed`` has (by, basis),
    ``rows`` (by); one row per register that breaks the rule."""
    weak = removed.where(F.col("basis") == basis).groupBy(by).agg(F.count("*").alias("weak"))
    held = rows.groupBy(by).agg(F.count("*").alias("held"))
    return weak.join(held, by).where(F.col("weak") > F.greatest(F.lit(least), F.floor(F.col("held") * share))).select(
        F.lit("removals that rest on a title alone").alias("rule"), F.concat_ws("/", F.col(by).cast("string"), "weak", "held").alias("key")
    )


def claims(briefs: DataFrame, patterns: list[tuple[str, list[Column]]], text: str = "text", places: int = 10) -> DataFrame:
    """Figures a text prints against the metrics on its row, at the precision it prints.

    A pattern has ``{}`` where a figure stands, and one column per figure. One output
    row per figure: the claim's number, what is said, what it should read, the outcome.
    """
    flat = F.regexp_replace(text, r"\s+", " ")
    out = []
    for n, (pattern, wants) in enumerate(patterns):
        rx = r"([\d,]+(?:\.\d+)?)".join(re.escape(part) for part in pattern.split("{}"))
        for i, want in enumerate(wants, 1):
            said = F.regexp_extract(flat, rx, i)
            got = F.regexp_replace(said, ",", "").try_cast("double")
            digits = F.length(F.regexp_extract(said, r"\.(\d+)$", 1))
            w, g = want.cast("double"), got  # more digits than `places` are compared as they are
            for p in range(places, -1, -1):
                w = F.when(digits == p, F.bround(want.cast("double"), p)).otherwise(w)
                g = F.when(digits == p, F.bround(got, p)).otherwise(g)
            out.append(
                F.struct(
                    F.lit(n).alias("claim"),
                    F.lit(i).alias("figure"),
                    said.alias("said"),
                    F.when(said == "", "not said").when(w == g, "agrees").otherwise("moved").alias("outcome"),
                )
            )
    return briefs.select("id", F.explode(F.array(*out)).alias("c")).select("id", "c.*")


def at_precision(value: Column, digits: Column, places: int = 10) -> Column:
    """A figure at the precision it is printed with; more digits than `places` are compared as they are."""
    out = value
    for p in range(places, -1, -1):
        out = F.when(digits == p, F.bround(value, p)).otherwise(out)
    return out


def claims_table(briefs: DataFrame, claims: DataFrame, metrics: DataFrame) -> DataFrame:
    """Figures that texts print against a long table of metrics.

    ``briefs`` has (brief, scope, text); ``claims`` (brief, claim, pattern, keys): a pattern has ``{}``
    where a figure stands, and a key for each says what it is: a metric, ``a - b`` for a
    difference, ``a%`` for a share as a percentage. ``metrics`` has (scope, metric, value). One row
    per key, or per claim that cannot be read: (brief, claim, figure, said, should, outcome).
    Claims, operands and metrics meet by equi joins, so a brief may claim any number of them."""
    flat = briefs.select("brief", "scope", F.trim(F.regexp_replace("text", r"\s+", " ")).alias("_text"))
    literal = lambda p: F.concat(F.lit(r"\Q"), F.replace(p, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))
    parts = F.split(F.trim(F.regexp_replace("pattern", r"\s+", " ")), r"\{\}", -1)
    rx = F.array_join(F.transform(parts, literal), r"([\d,]+(?:\.\d+)?)")
    keys = F.filter(F.transform("keys", lambda k: F.trim(k)), lambda k: k != "")
    c = claims.select("brief", "claim", rx.alias("_rx"), (F.size(parts) - 1).alias("_figures"), keys.alias("_keys"))
    j = flat.join(c, "brief")
    j = j.withColumn("_said", F.rlike("_text", F.col("_rx")))
    unread = F.when(~F.col("_said"), "not said").when(F.col("_figures") != F.size("_keys"), "figures and keys differ in number")
    j = j.withColumn("_unread", unread)
    null = F.lit(None).cast("string")
    bad = j.where("_unread IS NOT NULL").select("brief", "claim", F.lit(None).cast("int").alias("figure"), null.alias("said"), F.lit(None).cast("double").alias("should"), F.col("_unread").alias("outcome"))
    each = j.where("_unread IS NULL").select("brief", "scope", "claim", "_text", "_rx", F.posexplode("_keys").alias("_place", "_key"))
    each = each.withColumn("_difference", F.col("_key").contains(" - "))
    left = F.when(F.col("_difference"), F.trim(F.substring_index("_key", " - ", 1))).otherwise(F.col("_key"))
    right = F.when(F.col("_difference"), F.trim(F.expr("substr(_key, instr(_key, ' - ') + 3)")))
    each = each.select(
        "brief", "scope", "claim", (F.col("_place") + 1).alias("figure"), "_difference",
        F.expr("regexp_extract(_text, _rx, _place + 1)").alias("said"),
        F.regexp_replace(left, "%$", "").alias("_a"), left.endswith("%").alias("_ap"), F.regexp_replace(right, "%$", "").alias("_b"), right.endswith("%").alias("_bp"),
    )
    for side in "ab":
        own = metrics.select("scope", F.col("metric").alias(f"_{side}"), F.col("value").cast("double").alias(f"_v{side}"))
        each = each.join(own, ["scope", f"_{side}"], "left")
    value = lambda s: F.when(F.col(f"_{s}p"), F.col(f"_v{s}") * 100).otherwise(F.col(f"_v{s}"))
    should = F.when(F.col("_difference"), value("a") - value("b")).otherwise(value("a"))
    got = F.regexp_replace("said", ",", "").try_cast("double")
    digits = F.length(F.regexp_extract("said", r"\.(\d+)$", 1))
    want, said = at_precision(should, digits), at_precision(got, digits)
    outcome = F.when(should.isNull(), "unknown metric").when(want == said, "agrees").otherwise("moved")
    return each.select("brief", "claim", "figure", "said", want.alias("should"), outcome.alias("outcome")).unionByName(bad)


#: Words of a body's name that do not tell it from another (fixed values).
BODY_NOISE = "joint standing select senate house committee on the and for of into"


def body_words(name: Column) -> Column:
    """The words that tell one body from another, sorted."""
    words = F.regexp_extract_all(F.lower(F.coalesce(name, F.lit(""))), F.lit("[a-z0-9]+"), F.lit(0))
    return F.array_sort(F.array_distinct(F.array_except(words, F.array(*[F.lit(w) for w in BODY_NOISE.split()]))))


def publish_tables(
    index: DataFrame, positions: DataFrame, coverage: DataFrame, rebuilt: DataFrame, register: DataFrame, reports: DataFrame, removals: DataFrame, claimed: DataFrame
) -> DataFrame:
    """What does not agree between the tables of one build, as (rule, key).

    ``index`` (doc, label, url) and ``positions`` (doc, label, state, verdict) must hold the same items;
    ``coverage`` (doc, stated, accepted, part, refused) must be what ``rebuilt`` computes from the
    positions; a row of ``register`` (id, body, report) may only link to a document of ``reports``
    (report, body) by its own body; ``removals`` are listed by ``register`` and ``claimed``
    (register, stated) counts them. Pairs of tables meet by fingerprints of key ranges."""
    item, doc = F.concat_ws("/", "doc", "label"), F.col("doc").cast("string")
    rows = violations(index, {"no https link": ~F.coalesce("url", F.lit("")).startswith("https://")}, item)
    sides = compare.differences(index.select("doc", "label"), positions.select("doc", "label"), ["doc", "label"], [])
    names = {"left only": "index row without a position", "right only": "position without an index row"}
    side = F.coalesce(*[F.when(F.col("outcome") == k, v) for k, v in names.items()], F.lit("item held more than once"))
    unsaid = violations(positions, {"stated position without a verdict": (F.col("state") == "position") & (F.coalesce("verdict", F.lit("")) == "")}, item)
    added = violations(coverage, {"verdicts do not add up": F.col("accepted") + F.col("part") + F.col("refused") != F.col("stated")}, doc)
    stale = compare.differences(coverage, rebuilt, ["doc"], ["stated", "accepted", "part", "refused"]).select(F.lit("coverage of another build").alias("rule"), doc.alias("key"))
    linked = register.select("id", "report", body_words(F.col("body")).alias("_own")).join(reports.select("report", body_words(F.col("body")).alias("_its")), "report")
    foreign = violations(linked, {"link to a document of another body": F.col("_own") != F.col("_its")}, F.col("id"))
    listed = removals.groupBy("register").agg(F.count("*").alias("listed"))
    counted = claimed.join(listed, "register", "full_outer").where(F.coalesce("stated", F.lit(0)) != F.coalesce("listed", F.lit(0)))
    apart = counted.select(F.lit("removals counted and listed differ").alias("rule"), F.col("register").cast("string").alias("key"))
    return together([rows, sides.select(side.alias("rule"), item.alias("key")), unsaid, added, stale, foreign, apart])


def append_once(held: DataFrame, source: Column) -> DataFrame:
    """One row when rows of a source are already there, so appending again would double them."""
    return (
        held.where(source)
        .agg(F.count("*").alias("n"))
        .where("n > 0")
        .select(F.lit("already appended").alias("rule"), F.col("n").cast("string").alias("key"))
    )


def together(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def must_be_empty(found: DataFrame) -> None:
    """Refuse to publish: raise with the count per rule when a gate found anything."""
    bad = found.groupBy("rule").count().orderBy("rule").collect()  # a row per rule
    if bad:
        raise ValueError("; ".join(f"{r['rule']}: {r['count']}" for r in bad))
