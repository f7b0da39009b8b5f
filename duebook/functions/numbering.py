"""Item labels: "7", "4.10", lists and ranges of them, their order and completeness."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values.
WORDS = (
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen "
    "fifteen sixteen seventeen eighteen nineteen twenty"
).split()
LABEL = r"(?i)\brecommendation\s*(?:no\.?\s*)?(\d{1,3}(?:\.\d{1,3})?)\b"
NUMBER = r"\d{1,3}(?:\.\d{1,3})?"
SPAN = r"(?:(\d+)\.)?(\d+)\s*(?:–|—|-|\bto\b)\s*(?:(\d+)\.)?(\d+)"
SHAPES = (
    ("by chapter", r"(?m)^[ \t]*Recommendation[ \t]+(\d{1,3}\.\d{1,3})[ \t]*:?[ \t]+(?![a-z.)\],;])(?!.*[.…]{6,})\S.*$"),
    ("straight through", r"(?m)^[ \t]*Recommendation[ \t]+(\d{1,3})[ \t]*:?[ \t]+(?![a-z.)\],;])(?!.*[.…]{6,})\S.*$"),
    ("untitled", r"(?m)^[ \t]*Recommendation[ \t]+(\d{1,3})[ \t]*$"),
)
STATED_TOTAL = r"(?i)(?:list|total)\s+of\s+(\d{1,3})\s+recommendations"


def label_key(label: Column) -> Column:
    """Numeric sort key, so that 4.10 comes after 4.9."""
    return F.transform(F.split(label, r"\."), lambda p: p.try_cast("int"))


def word_number(token: Column) -> Column:
    """The number a token writes in digits or in words up to twenty; null otherwise."""
    spelled = F.array_position(F.array(*[F.lit(w) for w in WORDS]), F.lower(token))
    return F.coalesce(token.try_cast("int"), F.when(spelled > 0, (spelled - 1).cast("int")))


def numbers_in(text: Column) -> Column:
    """The item numbers a phrase names, "to" ranges expanded, as a sorted set."""
    single = F.transform(
        F.regexp_extract_all(text, F.lit(r"(?i)\d+|[a-z]+"), F.lit(0)), word_number
    )
    spans = F.transform(
        F.regexp_extract_all(text, F.lit(r"(?i)(?:\d+|[a-z]+)\s*to\s*(?:\d+|[a-z]+)"), F.lit(0)),
        lambda s: F.struct(
            word_number(F.regexp_extract(s, r"^(\d+|[A-Za-z]+?)\s*to\s*", 1)).alias("a"),
            word_number(F.regexp_extract(s, r"(?i)to\s*(\d+|[a-z]+)$", 1)).alias("b"),
        ),
    )
    ranged = F.flatten(
        F.transform(F.filter(spans, lambda s: s["a"] <= s["b"]), lambda s: F.sequence(s["a"], s["b"]))
    )
    return F.array_sort(
        F.array_distinct(F.filter(F.concat(single, ranged), lambda n: n.isNotNull()))
    )


def labels_in(heading: Column) -> Column:
    """The labels a heading names, in order: lists as written, ranges within a chapter expanded."""

    def part_labels(part: Column) -> Column:
        a, lo, b, hi = (F.regexp_extract(part, SPAN, i) for i in (1, 2, 3, 4))
        lo_n, hi_n = lo.try_cast("int"), hi.try_cast("int")
        prefix = F.when(a != "", F.concat(a, F.lit("."))).otherwise("")
        # The bounds are guarded because both branches are evaluated on every row.
        last = F.greatest(F.coalesce(lo_n, F.lit(0)), F.coalesce(hi_n, F.lit(0)))
        run = F.transform(
            F.sequence(F.coalesce(lo_n, F.lit(0)), last),
            lambda n: F.concat(prefix, n.cast("string")),
        )
        return F.when((lo_n <= hi_n) & (a == b), run).otherwise(
            F.regexp_extract_all(part, F.lit(NUMBER), F.lit(0))
        )

    return F.array_distinct(F.flatten(F.transform(F.split(heading, r",|\band\b"), part_labels)))


def completeness(labels: Column) -> tuple[Column, Column]:
    """How many labels, and whether they run 1..N, or 1..n within every chapter.

    Labels are a distinct array of strings. A document that mixes plain and
    chapter labels is never complete. A chapter is complete when its highest
    number equals its count, so one pass over the sorted set settles it: every
    label n > 1 must have its predecessor present.
    """
    chaptered = F.filter(labels, lambda s: s.contains("."))
    plain = F.filter(labels, lambda s: ~s.contains("."))

    def has_predecessor(s: Column) -> Column:
        n = F.regexp_extract(s, r"(\d+)$", 1).try_cast("int")
        prefix = F.regexp_extract(s, r"^(\d+\.)?", 0)
        return (n == 1) | F.array_contains(labels, F.concat(prefix, (n - 1).cast("string")))

    count = F.when(F.size(chaptered) > 0, F.size(chaptered)).otherwise(F.size(plain))
    unmixed = (F.size(chaptered) == 0) | (F.size(plain) == 0)
    return count, unmixed & F.forall(labels, has_predecessor)


def shape_votes(text: Column) -> list[Column]:
    """Distinct labels found by each numbering shape, in order."""
    return [
        F.size(F.array_distinct(F.regexp_extract_all(text, F.lit(rx), F.lit(1)))) for _, rx in SHAPES
    ]


def shape(text: Column) -> Column:
    """The numbering shape with most distinct labels; the earlier shape wins a tie."""
    votes = shape_votes(text)
    top = F.greatest(*votes)
    out = F.when(top == 0, "none")
    for (name, _), n in zip(SHAPES, votes):
        out = out.when(n == top, name)
    return out


def stated_total(text: Column) -> tuple[Column, Column]:
    """The total a document states; null with a note where it states two."""
    found = F.array_distinct(F.regexp_extract_all(text, F.lit(STATED_TOTAL), F.lit(1)))
    n = F.size(found)
    return (
        F.when(n == 1, F.get(found, F.lit(0)).try_cast("int")),
        F.when(n == 0, "states no total").when(n > 1, "states more than one total").otherwise(""),
    )
