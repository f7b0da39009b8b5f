"""Near-duplicates by ProbMinHash.

A document is its distinct word shingles of five words (lower case, cut at white space), each
weighted 1 + ln(times it occurs). Every shingle sends points of a Poisson process whose rate is its
weight; each point falls on one of bands * rows registers, and a register keeps the shingle of
its earliest point. Two documents agree in a register with the probability of their probability
Jaccard similarity, which is the plain Jaccard similarity where no shingle repeats. A document
stops when all its registers hold points earlier than any that can follow. `rows` registers make
a band; documents that agree in a band meet, and every pair that counts is verified by the exact
similarity of its texts.

Equal texts are one node. In a band's bucket the nodes are set against the smallest one, its
leader; that is linear whatever a bucket's size, and it settles a family of copies. A bucket that
then still holds nodes of other components is dealt out in blocks, each of which compares the
registers of its nodes in one task and returns only the pairs whose estimate reaches `threshold`
- 0.1 (four standard deviations), from the first band in which the two agree. So a crowd of
documents that share a passage costs comparisons, not rows, and links are lost by chance alone:
(1 - 0.8^rows)^bands, 5e-6, and 5e-5 for the estimate, at a similarity of just 0.8. Classes are
the connected components.

Cases. Null, empty and blank texts are a class each. Texts of fewer than five words are one
shingle. Repeated rows share a class, as do rows of one id. A row with a null id is in no class
and is kept. Ties take the smallest id. Ids are long integers. An empty table gives an empty
result. Other columns do not take part; `dedup` keeps them, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duebook.llm import common
from duebook.llm.components import components

SHINGLE, THRESHOLD, BANDS, ROWS = 5, 0.8, 40, 6
#: How far below the threshold an estimate may lie; nodes of a block that are open, and that they meet.
SLACK, OPEN, MET = 0.1, 256, 2048
_U = np.uint64
_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _rng.integers(0, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
_PLACE = _rng.integers(0, 2**63, 64, dtype=np.uint64) * _U(2) + _U(1)
_BASE = _U(0x9E3779B97F4A7C15)
_INVERSE = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits whose output bits all depend on all input bits."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def powers(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, _INVERSE)):
            p = np.full(2 * n, base, np.uint64)
            p[0] = 1
            _powers[k] = np.multiply.accumulate(p)
    return _powers


def shingles(texts: list[str], width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """doc, shingle hash, count of the distinct shingles of each text, sorted by neither."""
    words = [t.lower().split() for t in texts]
    n = np.array([len(w) for w in words], np.int64)
    if not n.sum():
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    raw = np.frombuffer((" ".join([" ".join(w) for w in words if w]) + " ").encode("utf-8", "replace"), np.uint8)
    up, down = powers(len(raw) + 1)
    ends = np.flatnonzero(raw == 32)
    sums = np.cumsum(_BYTE[raw] * up[: len(raw)])
    at = np.concatenate([[0], ends[:-1] + 1])
    before = np.where(at > 0, sums[at - 1], _U(0))
    word = mix((sums[ends - 1] - before) * down[at])
    doc = np.repeat(np.arange(len(texts)), n)
    place = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
    h = np.zeros(len(doc), np.uint64)
    for k in range(width):
        inside = len(doc) - k
        if inside > 0:
            h[:inside] += np.where(doc[k:] == doc[:inside], word[k:] * _PLACE[k], _U(0))
    start = (place + width <= n[doc]) | (place == 0)
    doc, h = doc[start], mix(h[start])
    _, first, count = np.unique(h ^ mix(doc.astype(np.uint64) + _U(1)), return_index=True, return_counts=True)
    return doc[first], h[first], count


def weights(count: np.ndarray) -> np.ndarray:
    return 1.0 + np.log(count)


def registers(docs: int, doc: np.ndarray, h: np.ndarray, w: np.ndarray, m: int) -> np.ndarray:
    """The shingle of the earliest point in each of m registers of each document."""
    earliest, holder = np.full(docs * m, np.inf), np.zeros(docs * m, np.uint64)
    t, k = np.zeros(len(doc)), 1
    while len(doc):
        many = int(np.clip(20_000 // len(doc), 1, 64))  # points at once, when few shingles still send
        seed = mix(h[:, None] + np.arange(k, k + many, dtype=np.uint64) * _BASE)
        gap = -np.log(((seed >> _U(11)).astype(np.float64) + 1) * 2.0**-53) / w[:, None]
        at = t[:, None] + np.cumsum(gap, axis=1)
        slot = (doc[:, None] * m + (mix(seed ^ _PLACE[7]) % _U(m)).astype(np.int64)).ravel()
        flat, who = at.ravel(), np.repeat(h, many)
        np.minimum.at(earliest, slot, flat)
        won = flat == earliest[slot]
        holder[slot[won]] = who[won]
        latest = earliest.reshape(docs, m).max(axis=1)
        on = at[:, -1] < latest[doc]  # a point that follows can still be the earliest somewhere
        doc, h, w, t, k = doc[on], h[on], w[on], at[on, -1], k + many
    return holder.reshape(docs, m)


def signatures(bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = common.strings(b, "text")
            doc, h, count = shingles(texts)
            w = weights(count)
            has = np.bincount(doc, minlength=len(texts)) > 0
            held = registers(len(texts), doc, h, w, bands * rows) if len(doc) else np.zeros((len(texts), bands * rows), np.uint64)
            band = (held.reshape(len(texts), bands, rows) * _PLACE[:rows]).sum(axis=2, dtype=np.uint64)
            band = mix(band + np.arange(bands, dtype=np.uint64) * _BASE).view(np.int64)
            offsets = np.concatenate([[0], np.cumsum(np.where(has, bands, 0))]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(band[has].ravel()))
            # eight bits of each register, for estimates, and 32 of each band, to tell which bands agree
            marks = pa.array([r.tobytes() + k.tobytes() for r, k in zip(mix(held).astype(np.uint8), band.astype("<u4"))], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("k1"), b.column("k2"), lists, marks], names=["doc_id", "k1", "k2", "bands", "marks"])

    return run


def similarity(a: tuple, b: tuple) -> float:
    """Exact probability Jaccard of two (sorted hashes, weights): the sum over common shingles i
    of 1 / sum over j of max(x_j / x_i, y_j / y_i)."""
    (ha, wa), (hb, wb) = a, b
    if not len(ha) or not len(hb):
        return 0.0
    both = np.union1d(ha, hb)
    x, y = np.zeros(len(both)), np.zeros(len(both))
    x[np.searchsorted(both, ha)] = wa
    y[np.searchsorted(both, hb)] = wb
    with np.errstate(divide="ignore"):
        ratio = x / y
    order = np.argsort(ratio)
    x, y, ratio = x[order], y[order], ratio[order]
    above = np.concatenate([np.cumsum(x[::-1])[::-1], [0.0]])
    upto = np.cumsum(y)
    last = np.searchsorted(ratio, ratio, side="right")
    common_ = (x > 0) & (y > 0)
    total = above[last[common_]] / x[common_] + upto[last[common_] - 1] / y[common_]
    return float((1 / total).sum())


def profile(text: str) -> tuple[np.ndarray, np.ndarray]:
    _, h, count = shingles([text])
    order = np.argsort(h)
    w = weights(count[order])
    return h[order], w / w.sum() if len(w) else w


def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ids, known, out = b.column("a").to_pylist(), {}, []
        for i, ta, tb in zip(ids, common.strings(b, "ta"), common.strings(b, "tb")):
            if i not in known:
                known[i] = profile(ta)
            out.append(similarity(known[i], profile(tb)))
        yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b"), pa.array(out, pa.float64())], names=["a", "b", "j"])


def measured(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """a, b, j of distinct pairs. The joins are by sorting at every size: texts are not broadcast."""
    pairs = common.settle(pairs.select("a", "b").distinct(), "pairs")
    ta = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("ta")).hint("merge")
    tb = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("tb")).hint("merge")
    return common.settle(pairs.join(tb, "b").join(ta, "a").select("a", "b", "ta", "tb").mapInArrow(verified, "a long, b long, j double"), "measured")


def agreeing(band: int, left: list, met: list, bands: int, least: float) -> list[tuple[int, int]]:
    """Pairs of an open node and a node of another component whose marks agree in this share, if
    `band` is the first that they share."""
    x = np.frombuffer(b"".join([r[2] for r in left]), np.uint8).reshape(len(left), -1)
    y = np.frombuffer(b"".join([r[2] for r in met]), np.uint8).reshape(len(met), -1)
    m = x.shape[1] - 4 * bands
    x, own, y, keys = x[:, :m], x[:, m:].copy().view("<u4"), y[:, :m], y[:, m:].copy().view("<u4")
    comps, nodes = np.array([r[1] for r in met]), np.array([r[0] for r in met])
    out = []
    for (node, comp, _), marks, key in zip(left, x, own):
        near = np.flatnonzero(((y == marks).mean(axis=1) >= least) & (comps != comp))
        if len(near):
            first = (keys[near] == key).argmax(axis=1)
            out += [(min(node, n), max(node, n)) for n in nodes[near[first == band]].tolist()]
    return out


def compared(bands: int, least: float):
    """a, b from rows sorted by block, the open nodes (side 0) of each block first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, sides = None, ([], [])
        for b in batches:
            out = []
            for h, seat, met, band, side, node, comp, marks in zip(*(b.column(n).to_pylist() for n in ("h", "seat", "met", "band", "side", "node", "comp", "marks"))):
                if (h, seat, met) != block:
                    if all(sides):
                        out += agreeing(at, *sides, bands, least)
                    block, sides, at = (h, seat, met), ([], []), band
                sides[side].append((node, comp, marks))
            yield pairs_out(out)
        if all(sides):
            yield pairs_out(agreeing(at, *sides, bands, least))

    return run


def pairs_out(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], names=["a", "b"])


def apart(held: DataFrame, nodes: DataFrame, bands: int, least: float) -> DataFrame:
    """a, b of one bucket and different components whose estimate reaches `least`."""
    away = F.col("comp") != F.col("lead_comp")
    sizes = held.groupBy("h").agg(F.count(F.when(away, 1)).alias("n"), F.count("*").alias("m")).where("n > 0")
    sizes = sizes.select("h", F.ceil(F.col("n") / OPEN).alias("seats"), F.ceil(F.col("m") / MET).alias("mets"))
    here = held.join(sizes, "h").join(nodes.select("node", "marks"), "node")
    upto = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1))
    seat = lambda c: F.pmod(F.xxhash64("node"), F.col(c))
    cols = ("h", "seat", "met", "band", "side", "node", "comp", "marks")
    left = here.where(away).withColumn("seat", seat("seats")).withColumn("met", upto("mets")).withColumn("side", F.lit(0)).select(*cols)
    met = here.withColumn("met", seat("mets")).withColumn("seat", upto("seats")).withColumn("side", F.lit(1)).select(*cols)
    dealt = left.union(met).repartition("h", "seat", "met").sortWithinPartitions("h", "seat", "met", "side")
    return dealt.mapInArrow(compared(bands, least), "a long, b long")


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, class_id, copies of every row with an id: class_id is the smallest id of its class,
    copies the number of rows whose words are the same."""
    common.ready(docs.sparkSession)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).where("doc_id is not null")
    words = F.trim(F.regexp_replace(F.lower("text"), "\\s+", " "))
    keyed = docs.select("doc_id", "text", F.xxhash64(words).alias("k1"), F.xxhash64(F.lit(7), words).alias("k2"))
    sig = common.settle(keyed.mapInArrow(signatures(bands, rows), "doc_id long, k1 long, k2 long, bands array<long>, marks binary"), "signatures")
    full = sig.where(F.size("bands") > 0)
    nodes = common.settle(full.groupBy("k1", "k2").agg(F.min(F.struct("doc_id", "bands", "marks")).alias("m"), F.count("*").alias("copies")).select("k1", "k2", "copies", F.col("m.doc_id").alias("node"), "m.bands", "m.marks"), "nodes")

    cells = nodes.select("node", F.posexplode("bands").alias("band", "h"))
    leaders = cells.groupBy("h").agg(F.min("node").alias("leader"), F.count("*").alias("n")).where("n > 1").drop("n")
    cells = common.settle(cells.join(leaders.hint("merge"), "h"), "cells")
    asked = cells.select(F.col("node").alias("doc_id")).distinct().hint("merge")
    texts = common.settle(docs.join(asked, "doc_id", "left_semi").dropDuplicates(["doc_id"]), "texts")
    stars = measured(cells.where("node <> leader").select(F.col("leader").alias("a"), F.col("node").alias("b")), texts)
    near = stars.where(F.col("j") >= threshold).select("a", "b")
    comps = components(near)

    # what its leader's component does not hold; a leader stands at its own side
    of = lambda name, out: comps.select(F.col("node").alias(name), F.col("comp").alias(out))
    held = cells.join(of("node", "c1"), "node", "left").join(of("leader", "c2"), "leader", "left").select(
        "h", "band", "node", F.coalesce("c1", "node").alias("comp"), F.coalesce("c2", "leader").alias("lead_comp")
    )
    held = common.settle(held, "held")
    pairs = apart(held, nodes, bands, threshold - SLACK).join(stars.select("a", "b"), ["a", "b"], "left_anti")
    more = measured(pairs, texts).where(F.col("j") >= threshold).select("a", "b")
    if not more.isEmpty():
        comps = components(near.union(more))

    reps = nodes.join(of("node", "comp"), "node", "left").select("k1", "k2", "copies", F.coalesce("comp", "node").alias("class_id"))
    grouped = full.select("doc_id", "k1", "k2").join(reps, ["k1", "k2"]).select("doc_id", "class_id", "copies")
    alone = sig.where(F.size("bands") == 0).select("doc_id", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("copies"))
    return grouped.union(alone)


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The rows of `docs` that stay: one document of each class, and rows without an id."""
    found = classes(docs, id_col, text_col, **settings)
    lost = found.where("doc_id <> class_id").select(F.col("doc_id").cast("string").alias("__key")).distinct()
    key = F.coalesce(F.col(id_col).cast("long").cast("string"), F.concat(F.lit("-"), F.hex(F.xxhash64(text_col)), F.hex(F.xxhash64(F.lit(7), F.col(text_col)))))
    return docs.withColumn("__key", key).dropDuplicates(["__key"]).join(lost, "__key", "left_anti").drop("__key")
