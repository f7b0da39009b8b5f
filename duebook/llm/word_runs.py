"""Periodic runs of words, found on a grammar of the text.

A document's words are numbered and Re-Pair replaces its most frequent pair by a new symbol until
no pair stands twice. A run (a maximal stretch of period q, at least `LEAST` words and 2 q long)
crosses the boundary between the two halves of the smallest symbol that holds it, or a boundary
of what is left on top. So runs are looked for at one boundary of each symbol, once however often
the symbol stands, and moved to all places where it was put in; pieces of one period that overlap
merge to the maximal interval, which is a run if no smaller period makes the same words.

At a boundary, a run shows as `GRAM` words that stand again a period further (a run of 12 words
or more repeats 6 of them), so candidates are the places of those six words in the symbol; each
is extended both ways on the words themselves.

Texts in which no six words stand twice have no run; they skip the grammar. Nothing shuffles,
and a task holds one Arrow batch. The cost of a document follows its own length.

Cases. Null and empty texts have no words, no run and an empty collapsed text. A repeated row is
answered once per copy. An empty table gives an empty result. Other columns are kept, one that
has a result's name is replaced.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from duebook.llm import common

#: Least words of a run, and the words that every run repeats in place.
LEAST, GRAM = 12, 6
#: Candidates looked at together.
SLICE = 1_000_000

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
RESULT = T.StructType(
    [
        T.StructField("n_runs", T.LongType()),
        T.StructField("runs", T.ArrayType(T.StructType([T.StructField(f, T.LongType()) for f in ("start", "length", "period")]))),
        T.StructField("collapsed", T.StringType()),
    ]
)


def repair(ids: list[int]) -> tuple[list[tuple[int, int, list[int]]], list[int]]:
    """(length of the left half, length, places) of each symbol that Re-Pair puts in, and the
    places of the symbols that are left on top."""
    n = len(ids)
    sym, length = list(ids), {}
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    count = {p: c for p, c in Counter(zip(ids, ids[1:])).items() if c > 1}
    places: dict = {p: [] for p in count}
    for i, p in enumerate(zip(ids, ids[1:])):
        if p in places:
            places[p].append(i)
    heap = [(-c, places[p][0], p) for p, c in count.items()]
    heapq.heapify(heap)
    fresh, out = max(ids, default=0) + 1, []
    while heap:
        c, first, pair = heapq.heappop(heap)
        now = count.get(pair, 0)
        if now < 2 or pair not in places:
            continue
        if now != -c:
            heapq.heappush(heap, (-now, first, pair))
            continue
        a, b = pair
        del count[pair]
        at, end = [], -1
        for i in sorted(places.pop(pair)):
            j = after[i]
            if i >= end and sym[i] == a and j < n and sym[j] == b:
                at.append(i)
                end = after[j]
        if len(at) < 2:
            continue
        x, fresh = fresh, fresh + 1
        left = length.get(a, 1)
        length[x] = left + length.get(b, 1)
        out.append((left, length[x], at))
        made: dict = {}
        for i in at:
            j = after[i]
            k, p = after[j], before[i]
            if p >= 0:
                old = (sym[p], a)
                if old in count:
                    count[old] -= 1
                made.setdefault((sym[p], x), []).append(p)
            if k < n:
                old = (b, sym[k])
                if old in count:
                    count[old] -= 1
                made.setdefault((x, sym[k]), []).append(i)
                before[k] = i
            sym[i], sym[j], after[i] = x, -1, k
        for new, where in made.items():
            # the neighbour may have become x itself since
            where = [i for i in where if sym[i] == new[0] and after[i] < n and sym[after[i]] == new[1]]
            if len(where) > 1:
                count[new], places[new] = len(where), where
                heapq.heappush(heap, (-len(where), where[0], new))
        if (x, x) not in count:
            where = [i for i in at if after[i] < n and sym[after[i]] == x]
            if len(where) > 1:
                count[x, x], places[x, x] = len(where), where
                heapq.heappush(heap, (-len(where), where[0], (x, x)))
    top, i = [], 0
    while i < n:
        top.append(i)
        i = after[i]
    return out, top


def grams(w: np.ndarray) -> np.ndarray:
    """A number for each six words in a row: equal where all six are."""

    def both(a, b):
        return np.unique(a * (int(b.max()) + 1) + b, return_inverse=True)[1]

    two = both(w[:-1], w[1:])
    four = both(two[:-2], two[2:])
    return both(four[: len(w) - 5], two[4:])


def extended(w: np.ndarray, t: np.ndarray, q: np.ndarray, node: np.ndarray, lo: np.ndarray, hi: np.ndarray, known: list) -> list[tuple[int, int, int, int]]:
    """(node, start, end, period) of the stretches around candidates: words at t stand again at t + q.

    `known` takes the longest ones; inside them, a period that theirs divides tells nothing new."""
    found: list = []
    left = np.argsort(q, kind="stable")

    def told(s: int, e: int, p: int) -> np.ndarray:
        return left[(q[left] % p != 0) | (t[left] < s) | (t[left] + q[left] + GRAM > e)]

    for s, e, p in known:
        left = told(s, e, p)
    while len(left):
        period = int(q[left[0]])
        size = int(np.searchsorted(q[left[: 64]], period, "right"))
        size = size if size < 64 else int(np.searchsorted(q[left], period, "right"))
        own, left = left[:size], left[size:]
        differ = np.concatenate(([-1], np.flatnonzero(w[:-period] != w[period:]), [len(w) - period]))
        i = np.searchsorted(differ, t[own])
        start = np.maximum(differ[i - 1] + 1, lo[own])
        end = np.minimum(differ[i] + period, hi[own])
        good = end - start >= max(LEAST, 2 * period)
        if good.any():
            new = set(zip(node[own][good].tolist(), start[good].tolist(), end[good].tolist(), [period] * int(good.sum())))
            found += new
            _, s, e, p = max(new, key=lambda x: x[2] - x[1])
            if len(known) < 8 or e - s > known[-1][1] - known[-1][0]:
                known[:] = sorted([*known, (s, e, p)], key=lambda x: x[0] - x[1])[:8]
                left = told(s, e, p)
    return found


def primitive(block: np.ndarray) -> bool:
    """Whether a block of words is not a smaller one several times."""
    q = rest = len(block)
    f = 2
    while rest > 1:
        if f * f > rest:
            f = rest
        if rest % f == 0:
            if (block[: q - q // f] == block[q // f :]).all():
                return False
            while rest % f == 0:
                rest //= f
        f += 1
    return True


def merged(w: np.ndarray, pieces: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, length, period) of maximal runs, from pieces (start, end, period)."""
    whole: list = []
    at = None
    for p, s, e in sorted({(p, s, e) for s, e, p in pieces}):
        if at and at[0] == p and s <= at[2] - p:  # a period in common: one stretch
            at[2] = max(at[2], e)
            continue
        at = [p, s, e]
        whole.append(at)
    return sorted((s, e - s, p) for p, s, e in whole if primitive(w[s : s + p]))


def runs(words: list) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of a list of words, by start, then period."""
    if len(words) < LEAST:
        return []
    table: dict = {}
    ids = [table.setdefault(x, len(table)) for x in words]
    w = np.asarray(ids, np.int64)
    n, g = len(w), grams(w)
    if g.max() + 1 == len(g):
        return []
    rules, top = repair(ids)
    # a boundary of each symbol at its first place, and those on top within the whole text
    own = [(at[0] + left, at[0], at[0] + size, k) for k, (left, size, at) in enumerate(rules) if size >= LEAST] + [(b, 0, n, -1) for b in top[1:]]
    b, lo, hi, node = np.asarray(own, np.int64).reshape(-1, 4).T
    key = g * (n + 1) + np.arange(len(g))
    key.sort()  # places by their six words
    many = np.bincount(g) > 1
    pieces, known, held = [], [], []

    def look() -> None:
        if held:
            pieces.extend(extended(w, *map(np.concatenate, zip(*held)), known))
            held.clear()

    # a run holds six words around the boundary that stand again: behind them, or before them
    for offset in range(-GRAM, 1):
        for ahead in (True, False):
            if offset == (0 if ahead else -GRAM):
                continue
            t = b + offset
            ok = (t >= lo) & (t + GRAM <= hi)
            ok[ok] = many[g[t[ok]]]
            if not ok.any():
                continue
            u, l, h, of = t[ok], lo[ok], hi[ok], node[ok]
            base, far = g[u] * (n + 1), (h - l) // 2
            if ahead:
                first, last = np.searchsorted(key, base + u + 1), np.searchsorted(key, base + np.minimum(h - GRAM, u + far), "right")
            else:
                first, last = np.searchsorted(key, base + np.maximum(l, u - far)), np.searchsorted(key, base + u)
            size = np.maximum(last - first, 0)
            done = 0
            total = np.cumsum(size)
            while done < len(size):  # some candidates at a time
                stop = max(done + 1, int(np.searchsorted(total, (total[done - 1] if done else 0) + SLICE, "right")))
                part, m = slice(done, stop), size[done:stop]
                done = stop
                row = np.repeat(np.arange(len(m)), m)
                if not len(row):
                    continue
                place = key[np.arange(len(row)) - np.repeat(np.cumsum(m) - m, m) + first[part][row]] % (n + 1)
                here = u[part][row]
                held.append((np.minimum(here, place), np.abs(place - here), of[part][row], l[part][row], h[part][row]))
                if sum(len(x[0]) for x in held) > SLICE:
                    look()
    look()
    moved = []
    for k, s, e, p in set(pieces):
        if k < 0:
            moved.append((s, e, p))
        else:
            at = rules[k][2]
            moved += [(s + o - at[0], e + o - at[0], p) for o in at]
    return merged(w, moved)


def repeating(texts: list[list[bytes]]) -> np.ndarray:
    """Which lists of words hold six words twice; a few that do not may be among them."""
    sizes = np.asarray([len(x) for x in texts], np.int64)
    h = np.fromiter(map(hash, chain.from_iterable(texts)), np.int64, int(sizes.sum())).view(np.uint64)
    out = np.zeros(len(texts), bool)
    if len(h) < GRAM:
        return out
    doc = np.repeat(np.arange(len(texts)), sizes)
    k = len(h) - GRAM + 1
    mixed = np.zeros(k, np.uint64)
    for i in range(GRAM):
        mixed = (mixed ^ h[i : i + k]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    whole = doc[:k] == doc[GRAM - 1 :]
    mixed, doc = mixed[whole] + doc[:k][whole].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93), doc[:k][whole]
    order = np.argsort(mixed)
    twice = mixed[order][1:] == mixed[order][:-1]
    out[doc[order[1:][twice]]] = True
    return out


def collapsed(words: list[bytes], found: list[tuple[int, int, int]]) -> bytes:
    """The words that no run repeats, one blank between them."""
    if not found:
        return b" ".join(words)
    drop = bytearray(len(words))
    for start, length, period in found:
        drop[start + period : start + length] = b"\1" * (length - period)
    return b" ".join([x for x, d in zip(words, drop) if not d])


def detected(text_col: str, id_col: str, prepare):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            # bytes are split at exactly the six blanks of ASCII
            texts = [(t or b"").split() for t in b.column(text_col).cast(pa.binary()).to_pylist()]
            if prepare:
                texts = [prepare(i, t) for i, t in zip(b.column(id_col).to_pylist(), texts)]
            may = repeating(texts)
            found = [runs(t) if m else [] for t, m in zip(texts, may)]
            flat = np.asarray(list(chain.from_iterable(found)), np.int64).reshape(-1, 3)
            offsets = np.zeros(len(found) + 1, np.int32)
            np.cumsum([len(f) for f in found], out=offsets[1:])
            each = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], fields=list(RUN))
            less = pa.array([collapsed(t, f) for t, f in zip(texts, found)], pa.binary()).cast(pa.string())
            yield common.with_columns(
                b,
                [("n_runs", pa.int64(), pa.array([len(f) for f in found], pa.int64())), ("runs", None, pa.ListArray.from_arrays(pa.array(offsets), each)), ("collapsed", None, less)],
                drop=("n_runs", "runs", "collapsed"),
            )

    return run


def detect(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", prepare: Callable[[object, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """`docs` with n_runs, runs (array of start, length, period; by start, then period) and collapsed.

    Words are what stands between blanks (U+0020, U+0009 to U+000D). `prepare` may change the
    words of a document, as UTF-8, before runs are looked for."""
    common.ready(docs.sparkSession)
    schema = T.StructType([f for f in docs.schema.fields if f.name not in RESULT.names] + RESULT.fields)
    return docs.mapInArrow(common.unhurried(detected(text_col, id_col, prepare)), schema)
