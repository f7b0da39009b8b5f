"""Spelling variants, by one-edit neighbourhoods over a reduced alphabet.

Letters are hashed to `SYMBOLS` symbols. Two words one edit apart have reduced words at most one
edit apart, and a reduced word's neighbourhood is small: itself, a symbol left out, a symbol
replaced by each other one. (A symbol put in is the same meeting seen from the longer word, so
it is generated there, as one left out, and the link is entered for both.) The neighbourhoods
are joined with the reduced vocabulary, and what meets is verified on the original strings.

Neighbourhoods hold 64-bit hashes; equal hashes cost a comparison, never a link. Two words meet
once at most, as a word's neighbourhood is a set and the other's reduced word one value of it.

Everything is a Column function; nothing is gathered but the neighbourhood of one word. Counts
are combined before the shuffle, so a word of a third of all rows is a row a task.

Cases. Null and empty texts have no words. A null id is written as nothing before the colon. A
repeated row counts once per copy. An empty table gives an empty result. Other columns of the
input are not read, so their names cannot clash. Words of one letter only, or longer than any
other, are handled like all; a word without near words has n_near 0 and is its own root.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duebook.llm import common

#: Letters of words: a to z, and U+00C0 to U+00FF.
LETTERS = "".join(map(chr, [*range(0x61, 0x7B), *range(0xC0, 0x100)]))
#: Symbols of the reduced alphabet. More make larger neighbourhoods and fewer false meetings.
SYMBOLS = 6
#: A run of letters loses one where this divides its hash.
DAMAGE = 199
#: Least letters of a word, least occurrences, and how much more frequent its form is.
LEAST_LETTERS, LEAST_COUNT, TIMES = 6, 5, 5


def damaged(doc_id: Column, run: Column) -> Column:
    """The run without one code point, where its hash with the document's id says so."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run))
    at = F.pmod(h, F.length(run)).cast("int")
    return F.when(h % DAMAGE == 0, F.concat(F.substring(run, F.lit(1), at), F.substr(run, at + 2))).otherwise(run)


def vocabulary(docs: DataFrame, least: int = LEAST_LETTERS, least_count: int = LEAST_COUNT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, n: runs of letters with A to Z lower-cased, as `damaged` leaves them, and their counts."""
    upper = "".join(map(chr, range(0x41, 0x5B)))
    lower = F.translate(F.col(text_col), upper, upper.lower())
    # a shorter run cannot become a word
    runs = docs.select(F.col(id_col).alias("id"), F.explode(F.regexp_extract_all(lower, F.lit("[a-zÀ-ÿ]{%d,}" % least), F.lit(0))).alias("run"))
    words = runs.select(damaged(F.col("id"), F.col("run")).alias("word")).where(F.length("word") >= least)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


def symbol(letter: str, symbols: int) -> str:
    """A letter's symbol: the high part of its code times the golden ratio."""
    return "0123456789abcdef"[(ord(letter) * 0x9E3779B1 & 0xFFFFFFFF) * symbols >> 32]


def reduced(word: Column, symbols: int) -> Column:
    return F.translate(word, LETTERS, "".join(symbol(c, symbols) for c in LETTERS))


def neighbourhood(r: Column, symbols: int) -> Column:
    """Hashes of a reduced word and of all that one symbol left out or replaced makes of it."""
    places = F.sequence(F.lit(1), F.length(r))

    def at(i: Column) -> Column:
        before, own, behind = F.substr(r, F.lit(1), i - 1), F.substr(r, i, F.lit(1)), F.substr(r, i + 1)
        others = F.array(*[F.lit("0123456789abcdef"[s]) for s in range(symbols)], F.lit(""))
        return F.transform(F.filter(others, lambda s: s != own), lambda s: F.xxhash64(F.concat(before, s, behind)))

    return F.array_distinct(F.concat(F.array(F.xxhash64(r)), F.flatten(F.transform(places, at))))


def links(vocab: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """word, near, near_n: every ordered pair of different words that one edit makes equal.

    `vocab` has word and n, each word once."""
    r = reduced(F.col("word"), symbols)
    keys = vocab.select("word", "n", F.explode(neighbourhood(r, symbols)).alias("key"))
    held = vocab.select(F.col("word").alias("near"), F.col("n").alias("near_n"), F.xxhash64(r).alias("key"))
    met = keys.join(held.hint("shuffle_hash"), "key").where(F.levenshtein("word", "near", 1) == 1)
    one = F.struct("word", "near", "near_n")
    back = F.struct(F.col("near").alias("word"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    # words of one length meet from both sides, others from the longer alone
    both = F.when(F.length("word") == F.length("near"), F.array(one)).otherwise(F.array(one, back))
    return met.select(F.inline(both))


def rooted(forms: DataFrame, times: int = TIMES) -> DataFrame:
    """`forms` (word, n, form, ...) with `root`: the last word along the forms.

    A form is `times` as frequent as its word, so chains are short and never closed: each round
    doubles the steps that a root stands for, and the largest count bounds the rounds."""
    most = forms.agg(F.max("n")).first()[0] or 1
    steps, longest = 1, 0
    while most >= times:
        most, longest = most // times, longest + 1
    root = forms.select("word", F.coalesce("form", "word").alias("root"))
    while steps < longest:
        on = root.select(F.col("word").alias("root"), F.col("root").alias("__next"))
        root = common.settle(root.join(on, "root").select("word", F.col("__next").alias("root")), "roots")
        steps *= 2
    return forms.join(root, "word")


def group(vocab: DataFrame, symbols: int = SYMBOLS, times: int = TIMES) -> DataFrame:
    """word, form, root, n, n_near, form_n for a vocabulary of word and n, each word once.

    A word's form is its near word of largest n, the first in code-point order of equals, where
    that n is `times` its own or more."""
    vocab = common.settle(vocab.select("word", "n"), "words")
    best = links(vocab, symbols).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    strong = -F.col("best.less") >= times * F.col("n")
    forms = vocab.join(best, "word", "left").select(
        "word", "n", F.when(strong, F.col("best.near")).alias("form"), F.when(strong, -F.col("best.less")).alias("form_n"), F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near")
    )
    return rooted(common.settle(forms, "forms"), times).select("word", "form", "root", "n", "n_near", "form_n")
