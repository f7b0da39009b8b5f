"""Packing by powers of two: no sequence crosses documents.

A document's ids, with the end id behind, are cut into pieces whose lengths are the powers of
two of its length: as many of `longest` as fit, then one per set bit, longest first. Each piece
is one whole sequence of its own length, so there is no padding at all, and sequences of equal
length form the buckets that batches are drawn from: their numbers begin with the bucket, and the
pieces of a batch leave it bucket by bucket. Tokenising happens in one pass without a shuffle, and a
task holds one Arrow batch.

The ids are those of the tokenizer file, by its own vocabulary and merges read as ranks. That is
exact where the pre-tokens are certain: texts whose characters all lie below U+0370, whose
classes no version of Unicode has moved. Other texts, those with the string of an added token, and
words of thousands of characters, go through the tokenizer itself.

Cases. Null and empty texts are documents of the end id alone. A repeated row is packed once per
copy. A null id is carried. An empty table gives an empty result. Result columns are the
operator's own, so others in the input cannot clash with them.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duebook.llm import common

SCHEMA = "doc_id {id}, start long, length long, doc_tokens long, ids binary"

#: The pre-tokens of the byte-level vocabulary (fixed value).
PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_encoders: dict = {}


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        ranks = byte_ranks(path)
        self.ranked = tiktoken.Encoding("ranks", pat_str=PRE_TOKENS, mergeable_ranks=ranks, special_tokens={})
        # characters whose classes are in doubt, a word too long for merging pair by pair, or the
        # string of an added token, which the library reads as that token
        added = "".join(f"|{re.escape(t)}" for t in added_tokens(path))
        self.hard = re.compile(f"[^\x00-\u036f]|[^ \n]{{2000}}{added}").search

    def __call__(self, text: str) -> bytes:
        if self.hard(text):
            return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return self.ranked.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False).tobytes()


def byte_ranks(path: str) -> dict[bytes, int]:
    """The vocabulary of a byte-level tokenizer file, its tokens as bytes.

    Such files write each byte as a printable character: itself if it is one, else the next
    free one from U+0100 on."""
    with open(path, encoding="utf-8") as f:
        table = json.load(f)["model"]["vocab"]
    shown = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
    hidden = [b for b in range(256) if b not in set(shown)]
    byte_of = {chr(b): b for b in shown} | {chr(0x100 + k): b for k, b in enumerate(hidden)}
    return {bytes(byte_of[c] for c in t): i for t, i in table.items() if all(c in byte_of for c in t)}


def added_tokens(path: str) -> list[str]:
    with open(path, encoding="utf-8") as f:
        return [t["content"] for t in json.load(f).get("added_tokens") or []]


def encoder(path: str) -> Encoder:
    """One per worker process and file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def cut(n: int, longest: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of n ids."""
    out = [(s, longest) for s in range(0, n - n % longest, longest)]
    at, rest = n - n % longest, n % longest
    while rest:
        size = 1 << (rest.bit_length() - 1)
        out.append((at, size))
        at, rest = at + size, rest - size
    return out


def pieces_of(path: str, end_id: int, longest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        end = np.asarray([end_id], "<u4").tobytes()
        for b in batches:
            ids_in = b.column("doc_id")
            source, starts, sizes, totals, blobs = [], [], [], [], []
            for i, text in enumerate(common.strings(b, "text")):
                blob = encode(text) + end
                n = len(blob) // 4
                for start, size in cut(n, longest):
                    source.append(i)
                    starts.append(start)
                    sizes.append(size)
                    totals.append(n)
                    blobs.append(blob[4 * start : 4 * (start + size)])
            columns = [ids_in.take(pa.array(source, pa.int32())), pa.array(starts, pa.int64()), pa.array(sizes, pa.int64()), pa.array(totals, pa.int64()), pa.array(blobs, pa.binary())]
            bucketed = pa.array(np.argsort(np.asarray(sizes, np.int64), kind="stable"))
            yield pa.RecordBatch.from_arrays([c.take(bucketed) for c in columns], names=["doc_id", "start", "length", "doc_tokens", "ids"])

    return run


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = 1, longest: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per sequence: doc_id, start, length, doc_tokens, ids, sequence_id, offset.

    `ids` are little-endian unsigned 32-bit. `length` is the bucket. sequence_id is distinct per row
    and ascends by bucket: its exponent stands above 59 bits that tell the rows of a bucket apart."""
    if longest & (longest - 1):
        raise ValueError("longest must be a power of two")
    if longest > 1 << 15:
        raise ValueError("a sequence number holds exponents up to 15")
    common.ready(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    out = narrow.mapInArrow(pieces_of(tokenizer_path, end_id, longest), SCHEMA.format(id=kind))
    bucket = F.shiftleft(F.log2("length").cast("long"), 59)
    return out.withColumn("sequence_id", bucket + F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))


def write(sequences: DataFrame, path: str) -> None:
    """Store sequences with those of equal length together, in a folder of each length."""
    sequences.write.partitionBy("length").parquet(path)
