"""A byte-level convolutional network that scores quality.

Bytes become small vectors, learned filters of sixteen bytes run over the whole text in steps of
eight, so that chunks overlap, and each filter keeps its largest answer and its mean over the text.
A logistic layer makes one probability of them. Learning is gradient descent in numpy on at most
`per_class` texts of each label (those with the smallest hashes), which the driver holds: whole up to
`most_bytes`, longer ones as blocks from all over the text, one of each of as many equal stretches,
where its hash says. Scoring reads every byte of every text in one pass without a shuffle.

Cases. Null and empty texts are scored as one chunk of padding. A null label teaches nothing.
Without labels of both kinds every score is the share of label 1, or 0.5. Repeated rows are
scored once per copy. An empty table gives an empty result. Other columns are kept; one named
like the result is replaced.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duebook.llm import common

STEP, WIDE, FILTERS = 8, 4, 32  # bytes a step, numbers a byte, filters; a filter spans two steps


class Network:
    def __init__(self, seed: int = 1):
        r = np.random.default_rng(seed)
        f = lambda *s, by: (r.standard_normal(s) * by).astype(np.float32)
        self.bytes = f(257, WIDE, by=0.5)  # the last stands for padding
        self.first, self.second = (f(STEP * WIDE, FILTERS, by=(STEP * WIDE * 2) ** -0.5) for _ in range(2))
        self.bias = np.zeros(FILTERS, np.float32)
        self.out = f(2 * FILTERS, by=0.3)
        self.shift = np.zeros(1, np.float32)
        self.constant: float | None = None

    PARTS = ("bytes", "first", "second", "bias", "out", "shift")

    def blocks(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Codes in rows of STEP, at least two rows a text, and the row each text starts at."""
        sizes = np.maximum(2, -(-np.array([len(t) for t in texts]) // STEP))
        starts = np.concatenate([[0], np.cumsum(sizes)])
        codes = np.full((starts[-1], STEP), 256, np.int16)
        flat = codes.reshape(-1)
        for t, s in zip(texts, starts.tolist()):
            flat[s * STEP : s * STEP + len(t)] = np.frombuffer(t, np.uint8)
        return codes, starts

    def answers(self, codes: np.ndarray) -> np.ndarray:
        """Of each filter at each block and the next one."""
        x = self.bytes[codes].reshape(len(codes), STEP * WIDE)
        return np.maximum(x[:-1] @ self.first + x[1:] @ self.second + self.bias, 0)

    def pooled(self, texts: list[bytes], part: int = 1 << 16) -> np.ndarray:
        """Largest and mean answers of each text, over a bounded part of the batch at a time."""
        codes, starts = self.blocks(texts)
        most, total = np.zeros((len(texts), FILTERS), np.float32), np.zeros((len(texts), FILTERS))
        for a in range(0, len(codes) - 1, part):
            z = self.answers(codes[a : a + part + 1])
            b = a + len(z)
            inside = np.flatnonzero((starts[:-1] < b) & (starts[1:] - 1 > a))
            lo, hi = np.maximum(starts[inside], a) - a, np.minimum(starts[inside + 1] - 1, b) - a
            for i, x, y in zip(inside.tolist(), lo.tolist(), hi.tolist()):
                most[i] = np.maximum(most[i], z[x:y].max(axis=0))
                total[i] += z[x:y].sum(axis=0)
        return np.hstack([most, (total / (np.diff(starts) - 1)[:, None]).astype(np.float32)])

    def score(self, texts: list[bytes]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        return 1 / (1 + np.exp(-(self.pooled(texts) @ self.out + self.shift[0]).astype(np.float64)))

    def slopes(self, texts: list[bytes], y: np.ndarray, weight: np.ndarray) -> dict:
        """Gradients of the weighted log loss."""
        codes, starts = self.blocks(texts)
        x = self.bytes[codes].reshape(len(codes), STEP * WIDE)
        z = np.maximum(x[:-1] @ self.first + x[1:] @ self.second + self.bias, 0)
        n = np.diff(starts) - 1
        pooled, tops = np.empty((len(texts), 2 * FILTERS), np.float32), np.empty((len(texts), FILTERS), np.int64)
        for i, (s, k) in enumerate(zip(starts.tolist(), n.tolist())):
            part = z[s : s + k]
            tops[i] = part.argmax(axis=0) + s
            pooled[i, FILTERS:] = part.mean(axis=0)
        cols = np.arange(FILTERS)
        pooled[:, :FILTERS] = z[tops, cols]
        p = 1 / (1 + np.exp(-(pooled @ self.out + self.shift[0])))
        d = ((p - y) * weight / weight.sum()).astype(np.float32)
        g = {"out": pooled.T @ d, "shift": np.array([d.sum()], np.float32)}
        dz = np.zeros_like(z)
        np.add.at(dz, (tops, np.broadcast_to(cols, tops.shape)), d[:, None] * self.out[:FILTERS])
        spread = (d / n)[:, None] * self.out[FILTERS:]
        for s, k, row in zip(starts.tolist(), n.tolist(), spread):
            dz[s : s + k] += row
        dz *= z > 0
        g["bias"], g["first"], g["second"] = dz.sum(axis=0), x[:-1].T @ dz, x[1:].T @ dz
        dx = np.zeros_like(x)
        dx[:-1] += dz @ self.first.T
        dx[1:] += dz @ self.second.T
        flat, per = codes.reshape(-1), dx.reshape(-1, WIDE)
        g["bytes"] = np.stack([np.bincount(flat, per[:, c], 257) for c in range(WIDE)], axis=1).astype(np.float32)
        return g


def fit(texts: list[bytes], labels: list[int], share: float | None = None, rounds: int = 12, batch: int = 32, rate: float = 0.01, seed: int = 1) -> Network:
    """A network from labelled texts. `share` is that of label 1 in the whole, if the texts were
    drawn by label."""
    net, y = Network(seed), np.array(labels, np.float32)
    if len(set(labels)) < 2:
        net.constant = share if share is not None else (float(y.mean()) if len(y) else 0.5)
        return net
    share = float(y.mean()) if share is None else share
    weight = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    r, moment, square, turn = np.random.default_rng(seed), {}, {}, 0
    turns = rounds * -(-len(y) // batch)
    for _ in range(rounds):
        places = r.permutation(len(y))
        for a in range(0, len(y), batch):
            at = places[a : a + batch]
            turn += 1
            pace = rate * (1 - turn / (turns + 1)) + 1e-4
            for name, g in net.slopes([texts[i] for i in at], y[at], weight[at]).items():
                moment[name] = 0.9 * moment.get(name, 0) + 0.1 * g
                square[name] = 0.99 * square.get(name, 0) + 0.01 * g * g
                move = (moment[name] / (1 - 0.9**turn)) / (np.sqrt(square[name] / (1 - 0.99**turn)) + 1e-8)
                setattr(net, name, (getattr(net, name) - pace * move).astype(np.float32))
    return net


def spread(raw: bytes, most: int, block: int = 256) -> bytes:
    """A text of `most` bytes at most: itself, or a block of each of most / block equal stretches of
    it, from the place that a hash of the text gives, so that no part of a text is favoured."""
    if len(raw) <= most:
        return raw
    n = max(1, most // block)
    edges = np.linspace(0, len(raw), n + 1).astype(np.int64)
    room = np.maximum(np.diff(edges) - block, 0)
    seed = zlib.crc32(raw)
    at = edges[:-1] + (np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed) >> np.uint64(33)).astype(np.int64) % (room + 1)
    return b"".join(raw[a : a + block] for a in at.tolist())


def spreading(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = [spread(t.encode("utf-8", "replace"), most) for t in common.strings(b, "text")]
            yield common.with_columns(b, [("raw", pa.binary(), raw)], drop=("text",))

    return run


def learned(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", per_class: int = 1500, most_bytes: int = 16_384, **settings) -> Network:
    """A network from at most `per_class` labelled documents of each label."""
    known = labels.where(F.col(label_col).isin(0, 1)).select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("y"))
    total = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    first = Window.partitionBy("y").orderBy(F.shiftrightunsigned("h", 1), "doc_id")
    few = common.thinned(known.withColumn("h", F.xxhash64("doc_id")), "y", "h", per_class).distinct()
    # chosen before the texts are touched: a list bounded by the parameters meets the documents
    chosen = few.withColumn("n", F.row_number().over(first)).where(F.col("n") <= per_class).select("doc_id", "y")
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    common.ready(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    bounded = texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "y", "text").mapInArrow(spreading(most_bytes), f"doc_id {kind}, y int, raw binary")
    rows = bounded.orderBy(F.xxhash64("doc_id"), "doc_id", "y", "raw").limit(2 * per_class).collect()
    share = total.get(1, 0) / sum(total.values()) if total else None
    return fit([bytes(r["raw"]) for r in rows], [r["y"] for r in rows], share, **settings)


def scored(shared, text_col: str, out_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        for b in batches:
            out = net.score([t.encode("utf-8", "replace") for t in common.strings(b, text_col)]) if b.num_rows else []
            yield common.with_columns(b, [(out_col, pa.float64(), out)], drop=(out_col,))

    return run


def score(docs: DataFrame, net: Network, text_col: str = "text", out_col: str = "score") -> DataFrame:
    """`docs` with the probability of label 1."""
    spark = common.ready(docs.sparkSession)
    schema = T.StructType([f for f in docs.schema.fields if f.name != out_col] + [T.StructField(out_col, T.DoubleType())])
    return docs.mapInArrow(scored(spark.sparkContext.broadcast(net), text_col, out_col), schema)
