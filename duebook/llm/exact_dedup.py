"""Exact dedup with the frequent digests split off.

Texts are equal when they are identical after every character of [\\x20\\x09-\\x0D] is deleted.
One pass writes the narrow rows (id, digest, length). A Misra-Gries summary of each partition
holds at most `counters` digests; the summaries add up to at most `counters` candidates, which
one exact count verifies. The winners of the verified digests are broadcast and settle their
rows where they lie, so the rows of a digest that a third of the table has never meet in a
task. What remains has fewer than 2 n / counters rows a digest and goes through an ordinary
shuffle.

Cases. Null text counts as empty, and empty texts are equal to each other. A repeated row
(same id, same text) is one more member of its group: the rows of the smallest id with the most
code points are all marked as kept by `members`, and `dedup` drops all but one of them. A null
id loses every tie. An empty table gives an empty result. Columns other than the two named are
carried by `dedup` untouched, whatever their names; `members` returns its own columns only.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duebook.llm import common

#: The characters deleted before texts are compared (fixed values).
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One narrow row per document: its id, the SHA-256 of its normalised text, its code points."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.unhex(F.sha2(F.encode(F.translate(text, BLANKS, ""), "UTF-8"), 256)).alias("digest"),
        F.length(text).cast("long").alias("n"),
    )


def misra_gries(keys: list, counts: dict, counters: int) -> None:
    """Count keys into `counts`, which never holds more than `counters` of them for long.

    A batch is added whole; when too many keys stand, the (counters + 1)-th largest count is
    taken off all, which is the summary's decrement done for many keys at once."""
    for k in keys:
        counts[k] = counts.get(k, 0) + 1
    if len(counts) > counters:
        cut = sorted(counts.values(), reverse=True)[counters]
        for k in [k for k, c in counts.items() if c <= cut]:
            del counts[k]
        for k in counts:
            counts[k] -= cut


def summaries(counters: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict = {}
        for b in batches:
            misra_gries(b.column("digest").to_pylist(), counts, counters)
        if counts:
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["digest", "least"])

    return run


def best():
    """Most code points first, then the smallest id; a null id comes last."""
    return F.min(F.struct((-F.col("n")).alias("m"), F.col("doc_id").isNull().alias("z"), F.col("doc_id").alias("id")))


def members(narrow: DataFrame, counters: int = 1024) -> DataFrame:
    """doc_id, digest, n, keep_id, group_size of every row of `digests`."""
    common.ready(narrow.sparkSession)
    narrow = common.settle(narrow, "digests")
    found = narrow.select("digest").mapInArrow(summaries(counters), "digest binary, least long")
    # a digest with f rows keeps at least f - n / counters; no more than `counters` digests can
    # reach n / counters together, so this list is bounded whatever the table holds
    likely = found.groupBy("digest").agg(F.sum("least").alias("least")).orderBy(F.desc("least"), "digest").limit(counters)
    total = narrow.count()
    verified = (
        narrow.join(F.broadcast(likely.select("digest")), "digest")
        .groupBy("digest")
        .agg(best().alias("w"), F.count("*").alias("size"))
        .where(F.col("size") * counters > total)
        .select("digest", F.col("w.id").alias("heavy_id"), F.col("size").alias("heavy_size"))
    )
    winners = F.broadcast(common.settle(verified, "winners"))
    split = narrow.join(winners, "digest", "left")
    heavy = split.where("heavy_size is not null").select("doc_id", "digest", "n", F.col("heavy_id").alias("keep_id"), F.col("heavy_size").alias("group_size"))
    light = split.where("heavy_size is null").select("doc_id", "digest", "n")
    groups = light.groupBy("digest").agg(best().alias("w"), F.count("*").alias("group_size"))
    rest = light.join(groups, "digest").select("doc_id", "digest", "n", F.col("w.id").alias("keep_id"), "group_size")
    return heavy.unionByName(rest)


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = 1024) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row per document, dropped ones too."""
    m = members(digests(docs, id_col, text_col), counters)
    return m.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = 1024) -> DataFrame:
    """The rows of `docs` that stay, one per group of equal texts, with their own columns.

    Rows that share an id and yet differ are told apart by their digest; of rows equal in both
    one is kept."""
    m = members(digests(docs, id_col, text_col), counters)
    lost = m.where(~F.col("doc_id").eqNullSafe(F.col("keep_id"))).select(row_key(F.col("doc_id"), F.col("digest")).alias("__key")).distinct()
    own = F.unhex(F.sha2(F.encode(F.translate(F.coalesce(F.col(text_col), F.lit("")), BLANKS, ""), "UTF-8"), 256))
    single = docs.withColumn("__key", row_key(F.col(id_col), own)).dropDuplicates(["__key"])  # the join reuses this shuffle
    return single.join(lost, "__key", "left_anti").drop("__key")


def row_key(doc_id, digest):
    """What tells two rows apart: id and digest. A null id is a value of its own."""
    return F.concat(F.coalesce(doc_id.cast("string"), F.lit("-")), F.lit(":"), F.hex(digest))
