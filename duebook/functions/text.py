"""Text clean-up: tidy quotations, cut at a sentence, sentences, snippets, name parts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values.
PARA_NO = r"^\d{1,2}\.\d{1,3}\s+"
REPEAT_NO = r"^\d{1,3}(?:\.\d{1,3})?\s*[:.]\s+"
TRAILING = (
    r"(?i)(?:\s+(?:Response|Government\s+response|Australian\s+Government\s+response)\s*:?\s*"
    r"|\s+\d{1,3})\s*$"
)
# How a text that ends in one of those may end.
MAY_TRAIL = r"[eE:\d\s\x85\u2028\u2029]"
WHITE = " \t\n\x0b\f\r"
EDGES = " .:;-—–•"
LEADERS = r"[.…]{6,}"
LIST_MARKER = r"(?<![\w'’])\(?[a-h]\)?[.)]"
STRAY = r"[B-HJ-Zb-hj-z](?!\w)(?!['’])(?<!\w.)(?<!['’].)"
BULLET_LETTER = r"(?<=[:;,.•·])\s+[oe](?=\s+\w)|^\s*[oe](?=\s+\w)"
TRAILING_DATE = r"\s*[\[(]\s*\w+\s+\d{4}\s*[\])]\s*$"
MONTH_QUALIFIER = r"(\s*[\[(](?:[A-Z][a-z]+ )?(?:19|20)\d{2}[\])]\s*)+$"
BODY_SPLITS = (
    r"\s((?:Select Committee|Joint Select Committee|Joint Standing Committee|Joint Committee"
    r"|Parliamentary Joint Committee|Parliamentary Standing Committee|Standing Committee)"
    r"\s+(?:of|on|for)\s.+)$",
    r"\s([A-Z][A-Za-z,'’()&\- ]+?(?:References|Legislation)\s+Committee)$",
    r"\s([A-Z][A-Za-z,'’()&\- ]+?\sCommittee)$",
)
BODY_IN_TITLE = r"(?i)response(?:s)?\s+to\s+(?:the\s+)?(.*?)\s*(?:\breport\b|\binquiry\b|:|$)"
BODY_WORD = r"(?i)committee|commission"
ANSWERED_TITLES = (
    r"(?i)\b(?:report|inquiry|reports)\s*[:\-–—]\s*(.+)$",
    r"(?i)\breport\s+(?:on|into)\s+(?:the\s+)?(.+)$",
    r"(?i)\breport\s+(Report\s+\d{1,4}\b.*)$",
    r"(?i)\bresponse\s+(?:to\s+)?(?:the\s+)?(.+\bBills?\b.+)$",
)
QUOTE_EDGES = " :;,.-–—'\"“”‘’"
FOOTNOTE_TAIL = r"(?<=[a-z)])(?:i{1,3}|iv|vi{0,3}|ix|xi{0,3})$"
PAGE_NUMBER = r"^\s*\d{1,4}\s+|\s+\d{1,4}\s*$"
SENTENCE_STOP = r"[.!?][”’\")\]]?(?=\s+[\"“(A-Z0-9]|$)"
ANSWER_CHARS = 900
TRAILING_HEADING = 120
TRAILING_SENTENCE = 300


def bind(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` reads it."""
    return F.get(F.transform(F.array(value), lambda v: use(v)), F.lit(0))


def strip(text: Column, edges: str = WHITE) -> Column:
    """Take a set of characters off both ends."""
    return F.btrim(text, F.lit(edges))


def squeeze(text: Column) -> Column:
    """One space for every run of white space, none at the ends."""
    return strip(F.regexp_replace(text, r"\s+", " "))


TAIL = 150


def trimmed(text: Column, edges: str = EDGES) -> Column:
    """A quotation without the page's paragraph numbers, its labels at the end still there."""
    s = strip(F.regexp_replace(text, r"\s+", " "), edges)
    return F.ltrim(F.regexp_replace(F.regexp_replace(s, PARA_NO, ""), REPEAT_NO, ""), F.lit(edges))


def unlabelled(s: Column, edges: str = EDGES) -> Column:
    """What ``trimmed`` gives, without dangling labels: it is read more than once, so it is a column that stands.

    Its last character is no edge, so that where none can trail there is nothing to take off."""

    def shorten(t: Column) -> Column:
        for _ in range(3):
            t = F.rtrim(F.regexp_replace(t, TRAILING, ""), F.lit(edges))
        return t

    t = shorten(F.right(s, F.lit(TAIL)))
    long = F.length(s) > TAIL
    shortened = (
        F.when(long & (F.length(t) > TAIL // 2), F.concat(F.substring(s, F.lit(1), F.length(s) - TAIL), t))
        .when(long, shorten(s))
        .otherwise(t)
    )
    return F.when(F.right(s, F.lit(1)).rlike(MAY_TRAIL), shortened).otherwise(s)


def tidy(text: Column, edges: str = EDGES) -> Column:
    """A quotation without the page's paragraph numbers, page numbers and dangling labels.

    Labels are taken off the end up to three times. They are looked for in the last
    characters only, which hold all of them unless hardly any text is left there; then
    the whole text is read.
    """
    return bind(trimmed(text, edges), lambda s: unlabelled(s, edges))


def mangled(text: Column) -> Column:
    """Dot leaders, or two stray single letters once list markers are gone."""
    bare = F.regexp_replace(F.regexp_replace(text, BULLET_LETTER, " "), LIST_MARKER, " ")
    # what is taken out has no letter beside it, so no letter strays that did not before
    strays = F.when(F.regexp_count(text, F.lit(STRAY)) < 2, False).otherwise(F.regexp_count(bare, F.lit(STRAY)) >= 2)
    return text.rlike(LEADERS) | strays


def cut_at_sentence(text: Column, limit: int = ANSWER_CHARS) -> tuple[Column, Column]:
    """The words up to a sentence end within the limit, and whether more follows.

    The part after the last stop is a heading when short, and goes; when the
    limit fell inside a long sentence the words end at a word instead.
    """
    whole = squeeze(text)
    more = F.length(whole) > limit
    head = F.left(whole, F.lit(limit))
    to_stop = F.regexp_extract(head, rf"^(.*(?:{SENTENCE_STOP}))", 1)
    tail = strip(F.substring(head, F.length(to_stop) + 1, limit))
    has_stop = (F.length(to_stop) > 1) & (F.length(tail) > 0)
    to_word = F.regexp_extract(head, r"^(.*) ", 1)
    kept = (
        F.when(has_stop & more & (F.length(tail) > TRAILING_SENTENCE), to_word)
        .when(has_stop & (more | (F.length(tail) <= TRAILING_HEADING)), to_stop)
        .otherwise(head)
    )
    return strip(kept), F.when(more, "yes").otherwise("")


def sentences(text: Column, boundary: str = r"\.") -> Column:
    """Sentences as an array, trimmed, blanks left out."""
    return F.filter(
        F.transform(F.split(text, boundary), lambda s: strip(s)), lambda s: F.length(s) > 0
    )


def snippets(text: Column, pattern: str, around: int = 130, at_most: int = 3) -> Column:
    """The first few places a pattern is found, with their surroundings, as an array.

    The limit is the feature: a reviewer is shown at most this many per pattern.
    """
    mark = "\u0001"
    pieces = F.split(F.regexp_replace(text, f"({pattern})", mark + "$1"), mark, at_most + 2)
    out, at = [], F.length(F.get(pieces, F.lit(0)))
    for k in range(1, at_most + 1):
        piece = F.get(pieces, F.lit(k))
        hit = F.regexp_extract(piece, f"^(?:{pattern})", 0)
        start = F.greatest(at - around, F.lit(0))
        out.append(
            F.when(piece.isNotNull(), squeeze(F.substring(text, start + 1, at - start + F.length(hit) + around)))
        )
        at = at + F.coalesce(F.length(piece), F.lit(0))
    return F.filter(F.array(*out), lambda x: x.isNotNull())


def split_title_body(line: Column) -> tuple[Column, Column]:
    """A merged "title body" line, split before the body's name by the first rule that fits."""
    flat = strip(line)
    body = F.coalesce(
        *[F.nullif(F.regexp_extract(line, rx, 1), F.lit("")) for rx in BODY_SPLITS], F.lit("")
    )
    cut = F.length(F.rtrim(line)) - F.length(body)
    title = F.when(body != "", strip(F.substring(line, F.lit(1), cut))).otherwise(flat)
    return title, strip(body)


def body_from_title(title: Column, longest: int = 120) -> Column:
    """The body a response title names, or blank."""
    name = strip(
        F.regexp_replace(F.regexp_extract(title, BODY_IN_TITLE, 1), r"\s+", " "), " ,:–—-"
    )
    return F.when(name.rlike(BODY_WORD) & (F.length(name) <= longest), name).otherwise("")


def answered_title(title: Column) -> Column:
    """The report title inside a response's own title, by the first rule that fits."""
    t = squeeze(F.coalesce(title, F.lit("")))
    found = F.coalesce(
        *[F.nullif(F.regexp_extract(t, rx, 1), F.lit("")) for rx in ANSWERED_TITLES], F.lit("")
    )
    return strip(F.regexp_replace(found, TRAILING_DATE, ""), QUOTE_EDGES)


def without_month(title: Column) -> Column:
    """A title without the bracketed month a register adds; other brackets stay."""
    return strip(F.regexp_replace(strip(title), MONTH_QUALIFIER, ""))


def clean_body(name: Column) -> Column:
    """A body's name without a roman footnote mark glued to it."""
    return strip(F.regexp_replace(strip(name), FOOTNOTE_TAIL, ""))


def percent(part: Column, whole: Column, places: int = 0) -> Column:
    """A share in per cent, half to even; null where there is no whole."""
    return F.bround(F.try_divide(F.lit(100) * part, whole), places)
