"""Passages that stand twice, by merging the Burrows-Wheeler transforms of shards.

A byte goes if a string of `LENGTH` bytes that covers it also starts earlier: in a smaller
document, or before in the same one. What is wanted is the order of all suffixes to a depth of
`LENGTH`, merged over all shards, cut where neighbours share less.

Which suffixes. Each string of `LENGTH` bytes has an anchor, the `GRAM` bytes in it of least hash
(the first of equals), so equal strings have equal anchors at one offset. Only anchors that stand
twice in the corpus go on; a document sends their hashes, and gets back which of its own do.

Shards. A shard, some documents of one task, takes the text around its anchors (the strings that
have this anchor), drops what it holds twice itself but the earliest, and sends the rest to the
bucket of the anchor. So a passage in a third of all documents is a row a shard.

Merge. In a bucket, the rows of all shards start as one block. Round by round the next symbol, of
eight bytes, refines the interleave of each block that still holds more than one row; a round that
parts two neighbours gives their common prefix. That orders the suffixes at the anchors. Those
before them follow without sorting any again: the character before each (its entry in the
transform) takes the rows, in the order they have, one step to the left, `LENGTH - GRAM` times.
An interval whose rows agree in the characters taken so far, and share the rest of `LENGTH` bytes
to the right, is a repeated string; all of it but the earliest is marked.

All comparisons are on bytes; hashes only choose anchors and buckets. Buckets follow the size of
the input, a bucket's rows are held in one task, the texts move once and are read twice.

Cases. Null and empty texts have nothing to remove. Of rows with one id, texts are ordered by
their hash; of rows equal in id and text one is the first and the others go whole (if they have
`LENGTH` bytes). A null id comes behind all others. An empty table gives an empty result. Other
columns of the input are kept; those with a result's name are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duebook.llm import common

#: Bytes of a repeated string, and of an anchor in it.
LENGTH, GRAM = 100, 32
#: Strings of one anchor, by where it stands in them.
PLACES = LENGTH - GRAM + 1
#: Bytes of text to a bucket of anchors, and to one of rows; bytes hashed at a time; anchors and rows
#: a shard holds. A document's anchors come back as a row a bucket, so their buckets are the larger.
ANCHOR_BUCKET, BUCKET, CHUNK, ANCHORS, ROWS = 160 << 20, 48 << 20, 1 << 20, 1_000_000, 250_000

#: Symbols of the merge, of eight bytes: the text from an anchor on, and before it.
RIGHT, LEFT = -(-LENGTH // 8), -(-(PLACES - 1) // 8)

PACK = "bucket int, known boolean, ids array<long>, hashes array<long>, counts array<int>, keys array<long>, at array<int>, left binary, right binary, body binary"
SPOTS = "doc long, hash long, spots binary"

_powers: list = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """B ** i and B ** -i modulo 2 ** 64."""
    if not _powers or len(_powers[0]) < n:
        base = 0x9E3779B97F4A7C15
        own = [np.full(max(n, CHUNK + 1), x, np.uint64) for x in (base, pow(base, -1, 1 << 64))]
        for p in own:
            p[0] = 1
            np.cumprod(p, out=p)
        _powers[:] = own
    return _powers[0][:n], _powers[1][:n]


def gram_hashes(buf: np.ndarray) -> np.ndarray:
    """A hash of the GRAM bytes from each place on."""
    up, down = powers(len(buf))
    total = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum((buf.astype(np.uint64) + np.uint64(77)) * up, out=total[1:])
    h = (total[GRAM:] - total[:-GRAM]) * down[: len(buf) - GRAM + 1]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    return h


def anchors(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, place, most and least bytes of a string before it, hash) of the anchors of texts."""
    sizes = np.asarray([len(t) for t in texts], np.int64)
    start = np.cumsum(sizes) - sizes
    buf = np.frombuffer(b"".join(texts), np.uint8)
    n = np.maximum(sizes - LENGTH + 1, 0)
    if not n.any():
        return tuple(np.zeros(0, k) for k in (np.int64, np.int64, np.uint8, np.uint8, np.uint64))
    h = gram_hashes(buf)
    low = np.uint64(0xFFFFFFFF)
    least = (h & ~low) | np.arange(len(h), dtype=np.uint64)  # with its place: the first of equals
    size = 1
    while 2 * size <= PLACES:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    least = np.minimum(least[: len(least) - (PLACES - size)], least[PLACES - size :])
    j = np.arange(n.sum()) + np.repeat(start - (np.cumsum(n) - n), n)
    anchor = (least[j] & low).astype(np.int64)
    cut = np.flatnonzero(np.diff(anchor, prepend=-1))
    place = anchor[cut]
    text = np.repeat(np.arange(len(texts)), n)[cut]
    last = j[np.append(cut[1:], len(j)) - 1]
    return text, place - start[text], (place - j[cut]).astype(np.uint8), (place - last).astype(np.uint8), h[place]


def chunks(texts: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    """Some texts at a time, with the number of the first."""
    first = size = 0
    for k, t in enumerate(texts):
        size += len(t)
        if size >= CHUNK:
            yield first, texts[first : k + 1]
            first, size = k + 1, 0
    if first < len(texts):
        yield first, texts[first:]


def packed(bucket: np.ndarray, known: np.ndarray, doc: np.ndarray, hashes: np.ndarray, cols: dict[str, np.ndarray], bodies: np.ndarray | None = None, sizes: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
    """One row a bucket and kind: documents, how many entries each has, and the entries."""
    order = np.lexsort((cols["at"], hashes, doc, known, bucket))
    group = np.flatnonzero(np.diff(bucket[order] * 2 + known[order], prepend=-1))
    for a, b in zip(group.tolist(), [*group[1:].tolist(), len(order)]):
        own = order[a:b]
        d, x = doc[own], hashes[own]
        new = np.flatnonzero(parts(d, x))
        row = {
            "bucket": pa.array([int(bucket[own[0]])], pa.int32()),
            "known": pa.array([bool(known[own[0]])]),
            "ids": listed(d[new], pa.int64()),
            "hashes": listed(x[new], pa.int64()),
            "counts": listed(np.diff(np.append(new, len(own))).astype(np.int32), pa.int32()),
            "keys": listed(cols["keys"][own].view(np.int64) if "keys" in cols else np.zeros(0, np.int64), pa.int64()),
            "at": listed(cols["at"][own].astype(np.int32), pa.int32()),
            "left": pa.array([cols["left"][own].tobytes()], pa.binary()),
            "right": pa.array([cols["right"][own].tobytes()], pa.binary()),
            "body": pa.array([bodies[own][sizes[own]].tobytes() if bodies is not None and not known[own[0]] else b""], pa.binary()),
        }
        yield pa.RecordBatch.from_arrays(list(row.values()), names=list(row))


def listed(values: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values, kind))


def unpacked(table: pa.Table, known: bool) -> dict[str, np.ndarray]:
    """The entries of the rows of one kind, one after the other."""
    t = table.filter(pa.compute.equal(table["known"], known)).combine_chunks()

    def flat(name: str, kind) -> np.ndarray:
        parts = [np.asarray(c.flatten()) for c in t[name].chunks]
        return np.concatenate([np.zeros(0, kind), *parts]).astype(kind, copy=False)

    def raw(name: str) -> np.ndarray:
        return np.frombuffer(b"".join(t[name].to_pylist()), np.uint8)

    counts = flat("counts", np.int64)
    out = {"doc": np.repeat(flat("ids", np.int64), counts), "hash": np.repeat(flat("hashes", np.int64), counts)}
    return out | {"keys": flat("keys", np.int64), "at": flat("at", np.int32), "left": raw("left"), "right": raw("right"), "body": raw("body")}


def spots(doc: np.ndarray, hashes: np.ndarray, values: np.ndarray) -> pa.Table:
    """A row a document of the values (n x k of 32 bits) that are its own."""
    order = np.lexsort((hashes, doc))
    d, x, raw = doc[order], hashes[order], np.ascontiguousarray(values[order], "<i4").tobytes()
    new = np.flatnonzero(parts(d, x))
    offsets = np.append(new, len(d)).astype(np.int64) * 4 * values.shape[1]
    blobs = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(new), [None, pa.py_buffer(offsets), pa.py_buffer(raw)]).cast(pa.binary())
    return pa.table({"doc": pa.array(d[new], pa.int64()), "hash": pa.array(x[new], pa.int64()), "spots": blobs})


# anchors that stand twice


def sent(buckets: int):
    """Of the documents of a task: one place of each anchor, and all of those it holds twice itself."""

    def out(held: list, turn: int) -> Iterator[pa.RecordBatch]:
        doc, hashes, at, left, right, key = map(np.concatenate, zip(*held))
        order = np.argsort(key, kind="stable")
        k = key[order]
        first = np.r_[True, k[1:] != k[:-1]]
        twice = ~first | np.r_[~first[1:], False]
        # those that stand twice are known to; the first of them also tells the others
        for own, known in ((order[first], False), (order[twice], True)):
            if len(own):
                bucket = np.full(len(own), turn % buckets) if known else ((key[own] >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
                cols = {"keys": key[own] if not known else np.zeros(len(own), np.uint64), "at": at[own], "left": left[own], "right": right[own]}
                yield from packed(bucket, np.full(len(own), known), doc[own], hashes[own], cols)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, turn = [], 0, 0
        for b in batches:
            texts = b.column("bytes").to_pylist()
            ids, hs = np.asarray(b.column("doc")), np.asarray(b.column("hash"))
            for k, some in chunks(texts):
                text, at, left, right, key = anchors(some)
                held.append((ids[k + text], hs[k + text], at, left, right, key))
                n += len(key)
                turn = turn or int(hs[k]) & 0xFFFFFF
            if n > ANCHORS:
                yield from out(held, turn)
                held, n, turn = [], 0, turn + 1
        if n:
            yield from out(held, turn)

    return run


def standing_twice(table: pa.Table) -> pa.Table:
    """Places of one bucket's anchors that more than one shard holds, and of those known before."""
    one, many = unpacked(table, False), unpacked(table, True)
    order = np.argsort(one["keys"], kind="stable")
    k = one["keys"][order]
    same = k[1:] == k[:-1]
    own = order[np.append(same, False) | np.append(False, same)] if len(k) else order

    def rows(x: dict, i) -> np.ndarray:
        return np.stack([x["at"][i], x["left"][i].astype(np.int32) << 8 | x["right"][i]], 1)

    every = slice(None)
    return spots(np.concatenate([one["doc"][own], many["doc"]]), np.concatenate([one["hash"][own], many["hash"]]), np.concatenate([rows(one, own), rows(many, every)]))


# the text around anchors, and its merge


def symbols(body: np.ndarray) -> np.ndarray:
    """Rows of bytes as rows of 64-bit symbols, in the order of the bytes."""
    return body.view(">u8").astype(np.uint64)


def interleave(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of rows of symbols, and the bytes each has in common with the one before it.

    Round t refines the blocks of rows that agree in t symbols, and leaves alone those of one row."""
    n, rounds = words.shape
    order, common_bytes = np.arange(n), np.full(n, 8 * rounds)
    new = np.zeros(n, bool)
    new[:1], common_bytes[:1] = True, 0
    for t in range(rounds):
        at = np.flatnonzero(~new | ~np.append(new[1:], True))  # in blocks of more than one row
        if not len(at):
            break
        rows, block = order[at], np.cumsum(new)[at]
        w = words[rows, t]
        s = np.lexsort((w, block)) if t else np.argsort(w, kind="stable")
        order[at], w = rows[s], w[s]
        parted = np.flatnonzero((w[1:] != w[:-1]) & (block[1:] == block[:-1])) + 1
        x = w[parted] ^ w[parted - 1]
        alike = sum((x < np.uint64(1 << 8 * (8 - k))).astype(np.int64) for k in range(1, 8))
        common_bytes[at[parted]] = 8 * t + alike
        new[at[parted]] = True
    return order, common_bytes


def bodies(before: np.ndarray, behind: np.ndarray) -> np.ndarray:
    """Which bytes of a row are text: before the anchor (the nearest first), and from it on."""
    a = np.arange(8 * LEFT) < before[:, None]
    return np.concatenate([a, np.arange(8 * RIGHT) < (LENGTH - behind.astype(np.int64))[:, None]], 1)


def around(buckets: int):
    """The rows of a task's documents for the merge, without those that an earlier one equals."""

    def out(held: list, turn: int) -> Iterator[pa.RecordBatch]:
        doc, hashes, at, left, right, body, key = map(np.concatenate, zip(*held))
        order = np.lexsort((at, hashes, doc))  # in the order of the corpus, each place once
        order = order[parts(doc[order], hashes[order], at[order])]
        doc, hashes, at, left, right, body, key = (v[order] for v in (doc, hashes, at, left, right, body, key))
        extent = left.astype(np.uint64) << np.uint64(8) | right
        own, alike = interleave(np.concatenate([symbols(body), extent[:, None]], 1))
        whole = alike >= body.shape[1] + 8  # equal to the row before, and the interleave keeps their order
        first = np.flatnonzero(~whole)
        least = np.minimum.reduceat(own, first)
        known = np.ones(len(own), bool)
        known[least] = False
        bucket = np.where(known, turn % buckets, (key % np.uint64(buckets)).astype(np.int64))
        yield from packed(bucket, known, doc, hashes, {"at": at, "left": left, "right": right}, body, bodies(left, right))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, turn = [], 0, 0
        for b in batches:
            ids, hs = np.asarray(b.column("doc")), np.asarray(b.column("hash"))
            texts, lists = b.column("bytes").to_pylist(), b.column("spots").to_pylist()
            for k, some in chunks(texts):
                got = [np.frombuffer(b"".join(x or []), "<i4").reshape(-1, 2) for x in lists[k : k + len(some)]]
                count = np.asarray([len(x) for x in got])
                if not count.sum():
                    continue
                own = np.concatenate(got).astype(np.int64)
                text = np.repeat(np.arange(len(some)), count)
                # the rows are cut out of the texts with room for bytes that are not theirs
                room = max(8 * LEFT, 8 * RIGHT)
                sizes = np.asarray([len(t) for t in some], np.int64)
                buf = np.frombuffer(bytes(room) + b"".join(some) + bytes(room), np.uint8)
                place = own[:, 0] + (np.cumsum(sizes) - sizes)[text] + room
                left, right = own[:, 1] >> 8, own[:, 1] & 255
                reach = np.concatenate([-1 - np.arange(8 * LEFT), np.arange(8 * RIGHT)])
                body = buf[place[:, None] + reach]
                body *= bodies(left, right)
                key = gram_hashes(np.ascontiguousarray(body[:, 8 * LEFT : 8 * LEFT + GRAM]).reshape(-1))[::GRAM]
                held.append((ids[k + text], hs[k + text], own[:, 0], left.astype(np.uint8), right.astype(np.uint8), body, key >> np.uint64(32)))
                n += len(own)
                turn = turn or int(hs[k]) & 0xFFFFFF
                if n > ROWS:
                    yield from out(held, turn)
                    held, n, turn = [], 0, turn + 1
        if n:
            yield from out(held, turn)

    return run


def parts(*cols: np.ndarray) -> np.ndarray:
    """Which rows differ from the one before in any column; the first does."""
    new = np.zeros(len(cols[0]), bool)
    new[:1] = True
    for c in cols:
        new[1:] |= c[1:] != c[:-1]
    return new


def marked(body: np.ndarray, left: np.ndarray, right: np.ndarray, when: np.ndarray) -> np.ndarray:
    """n x PLACES: strings with so many bytes before the anchor that an earlier row has too.

    `body` holds the bytes before each anchor, the nearest first, and those from it on; `left` and
    `right` the most and least bytes before it; `when` the row's turn in the corpus."""
    order, shared = interleave(symbols(np.ascontiguousarray(body[:, 8 * LEFT :])))
    left, right, when = left[order], right[order], when[order]
    out = np.zeros((len(order), PLACES), bool)
    gram = np.cumsum(shared < GRAM)
    row, block = np.arange(len(order)), np.zeros(len(order), np.int64)

    def beside(block: np.ndarray, row: np.ndarray) -> np.ndarray:
        new = parts(block, gram[row])
        return ~(new & np.append(new[1:], True))

    for before in range(PLACES):
        some = beside(block, row)  # a row alone in its block stays alone
        row, block = row[some], block[some]
        if not len(row):
            break
        own = (right[row] <= before) & (before <= left[row])
        if own.any():
            r = row[own]
            new = parts(block[own], np.cumsum(shared < LENGTH - before)[r])  # intervals of equal strings
            earliest = np.minimum.reduceat(when[r], np.flatnonzero(new))
            out[order[r], before] = when[r] > earliest[np.cumsum(new) - 1]
        more = left[row] > before
        row, block = row[more], block[more]
        char = body[order[row], before]
        step = np.argsort(char, kind="stable")  # each row goes to its character's part, in the order it has
        row, char, block = row[step], char[step], block[step]
        block = np.cumsum(parts(char, block))
    return out


def merged(table: pa.Table) -> pa.Table:
    """First and last starts of strings to remove, from the rows of one bucket."""
    x, known = unpacked(table, False), unpacked(table, True)
    n = len(x["at"])
    has = bodies(x["left"], x["right"])
    body = np.zeros(has.shape, np.uint8)
    body[has] = x["body"]
    order = np.lexsort((x["at"], x["hash"], x["doc"]))
    when = np.empty(n, np.int64)
    when[order] = np.cumsum(parts(*(x[c][order] for c in ("doc", "hash", "at"))))  # one place has one turn
    m = np.zeros((n, PLACES + 2), np.int8)
    if n:
        m[:, 1:-1] = marked(body, x["left"], x["right"], when)
    edge = np.diff(m, axis=1)
    row, far = np.nonzero(edge == 1)
    _, near = np.nonzero(edge == -1)
    found = np.stack([x["at"][row] - near + 1, x["at"][row] - far], 1)
    own = np.stack([known["at"] - known["left"].astype(np.int32), known["at"] - known["right"].astype(np.int32)], 1)
    return spots(np.concatenate([x["doc"][row], known["doc"]]), np.concatenate([x["hash"][row], known["hash"]]), np.concatenate([found, own]))


# what is left


def removed(size: int, starts: np.ndarray) -> np.ndarray:
    """(start, end) of the maximal runs of bytes that strings with these first and last starts cover."""
    starts = starts[np.argsort(starts[:, 0], kind="stable")]
    end = np.maximum.accumulate(starts[:, 1] + LENGTH)
    new = np.r_[True, starts[1:, 0] > end[:-1]]
    return np.stack([starts[new, 0], end[np.append(np.flatnonzero(new)[1:], len(end)) - 1]], 1)


def cut(schema_names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()  # rows of one id and text share a partition
        for b in batches:
            texts, lists = b.column("bytes").to_pylist(), b.column("spots").to_pylist()
            kept, spans = [], []
            for t, x, key in zip(texts, lists, zip(b.column("doc").to_pylist(), b.column("hash").to_pylist())):
                if key in seen and len(t) >= LENGTH:
                    own = np.asarray([[0, len(t)]], np.int64)
                elif x:
                    own = removed(len(t), np.frombuffer(b"".join(x), "<i4").reshape(-1, 2).astype(np.int64))
                else:
                    own = np.zeros((0, 2), np.int64)
                seen.add(key)
                spans.append(own)
                at, rest = 0, []
                for s, e in own.tolist():
                    rest.append(t[at:s])
                    at = e
                kept.append(b"".join([*rest, t[at:]]) if len(own) else t)
            flat = np.concatenate([np.zeros((0, 2), np.int64), *spans])
            offsets = np.append(0, np.cumsum([len(s) for s in spans])).astype(np.int32)
            pairs = pa.StructArray.from_arrays([pa.array(flat[:, 0]), pa.array(flat[:, 1])], names=["start", "end"])
            n = pa.array([len(t) for t in texts], pa.int64())
            gone = pa.array([int((s[:, 1] - s[:, 0]).sum()) for s in spans], pa.int64())
            rest = [b.column(c) for c in schema_names]
            yield pa.RecordBatch.from_arrays(
                [*rest, n, gone, pa.array([len(s) for s in spans], pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pairs), pa.array(kept, pa.binary())],
                names=[*schema_names, "n_bytes", "n_removed", "n_spans", "removed", "kept"],
            )

    return run


RESULT = T.StructType(
    [T.StructField(f, T.LongType()) for f in ("n_bytes", "n_removed", "n_spans")]
    + [T.StructField("removed", T.ArrayType(T.StructType([T.StructField(f, T.LongType()) for f in ("start", "end")]))), T.StructField("kept", T.BinaryType())]
)


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The columns of `docs` but the text, with n_bytes, n_removed, n_spans, removed (start and end
    of each run, in bytes) and kept (the bytes that stay: a run may begin or end inside a character)."""
    spark = common.ready(docs.sparkSession)
    rest = [c for c in docs.columns if c not in (text_col, *RESULT.names)]
    aside = {c: f"__{k}" for k, c in enumerate(rest)}  # no name of theirs is one of those used here
    text = F.coalesce(F.encode(F.col(text_col), "utf-8"), F.lit(b""))
    own = [F.coalesce(F.col(id_col).cast("long"), F.lit((1 << 63) - 1)).alias("doc"), F.xxhash64(text).alias("hash"), text.alias("bytes")]
    total = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    few, many = (max(4, -(-total // size)) for size in (ANCHOR_BUCKET, BUCKET))

    told = docs.select(*own).mapInArrow(common.unhurried(sent(few)), PACK).groupBy("bucket").applyInArrow(standing_twice, SPOTS)
    places = told.groupBy("doc", "hash").agg(F.collect_list("spots").alias("spots"))
    # both joins read one exchange of the texts
    dealt = docs.select(*[F.col(c).alias(a) for c, a in aside.items()], *own).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "doc", "hash")
    rows = dealt.join(places.hint("shuffle_hash"), ["doc", "hash"]).mapInArrow(common.unhurried(around(many)), PACK)
    goes = rows.groupBy("bucket").applyInArrow(merged, SPOTS).groupBy("doc", "hash").agg(F.collect_list("spots").alias("spots"))
    final = dealt.join(goes.hint("shuffle_hash"), ["doc", "hash"], "left")
    schema = T.StructType([T.StructField(a, docs.schema[c].dataType) for c, a in aside.items()] + RESULT.fields)
    out = final.mapInArrow(common.unhurried(cut(list(aside.values()))), schema)
    return out.select(*[F.col(a).alias(c) for c, a in aside.items()], *RESULT.names)
