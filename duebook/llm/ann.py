"""Nearest neighbours by inner product, through stable projections and a kd-tree.

A largest inner product is a smallest distance once every vector carries one more number that
brings it to the largest norm. Distances survive a projection on `dims` Gaussian directions: the
squared ratio of projected to true distance follows a chi-square law. The projected vectors are
indexed by a kd-tree; its upper part, fitted on a bounded sample, cuts the space into cells that
become tasks, and inside a cell the tree goes down to leaves. A query visits leaves in the order
of their projected distance and verifies what it meets by the true product. It stops when the
chi-square law says that a vector nearer than its current k-th would have shown up by now with
the probability `sure`. The first round asks the query's own cell and gives it a k-th distance;
the second asks only those other cells that the same test leaves open.

All rows are indexed and every query can reach every cell. Cells with many rows (copies of one
vector cannot be cut apart) and cells with many queries are dealt to several tasks by a hash.

Cases. Vectors that are null, zero, of another length than most, or hold null or non-finite
numbers take no part. Ties go to the smaller id. Repeated rows of one id count
once, and no row of the query's own id is a neighbour. With fewer candidates than k all are returned. Rows without an id take
no part. An empty table gives an empty result. Other columns do not take part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from duebook.llm import common

K, DIMS, SURE = 20, 8, 0.9
#: Rows of a cell and of a task, queries of a task, rows the tree is fitted on, cells at most, rows of a leaf.
CELL, QUERIES, SAMPLE, CELLS, LEAF = 16_384, 4_096, 32_768, 4_096, 256


def chi_square_at(share: float, dims: int) -> float:
    """The point below which a chi-square variable of an even number of dimensions lies with this
    probability."""
    below = lambda x: 1 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(dims // 2))
    lo, hi = 0.0, 1e4
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if below(mid) < share else (lo, mid)
    return hi


class Space:
    """Projection, cells and stopping rule; what every task needs, of bounded size."""

    def __init__(self, width: int, norm: float, dims: int, sure: float, seed: int = 1):
        self.width, self.norm = width, norm
        self.directions = np.random.default_rng(seed).standard_normal((width + 1, dims))
        self.factor = chi_square_at(sure, dims)
        self.splits: list[tuple[np.ndarray, np.ndarray]] = []  # per level: axis and value of each node
        self.low, self.high = np.full((1, dims), -np.inf), np.full((1, dims), np.inf)

    def project(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        more = np.zeros(len(x)) if query else np.sqrt(np.maximum(self.norm**2 - (x * x).sum(axis=1), 0))
        return np.hstack([x, more[:, None]]) @ self.directions

    def fit(self, points: np.ndarray, levels: int) -> None:
        cell, dims = np.zeros(len(points), np.int64), points.shape[1]
        low, high = np.full((1, dims), -np.inf), np.full((1, dims), np.inf)
        for _ in range(levels):
            axis, value = np.zeros(len(low), np.int64), np.zeros(len(low))
            for c in range(len(low)):
                own = points[cell == c]
                if len(own):
                    axis[c] = np.argmax(own.max(axis=0) - own.min(axis=0))
                    value[c] = np.median(own[:, axis[c]])
            self.splits.append((axis, value))
            low, high = np.repeat(low, 2, axis=0), np.repeat(high, 2, axis=0)
            nodes = np.arange(len(axis))
            high[2 * nodes, axis], low[2 * nodes + 1, axis] = value, value
            cell = 2 * cell + (points[np.arange(len(points)), axis[cell]] >= value[cell])
        self.low, self.high = low, high

    def cell(self, points: np.ndarray) -> np.ndarray:
        at, rows = np.zeros(len(points), np.int64), np.arange(len(points))
        for axis, value in self.splits:
            at = 2 * at + (points[rows, axis[at]] >= value[at])
        return at

    def near_cells(self, point: np.ndarray, limit: float) -> np.ndarray:
        """Cells that hold places within a squared projected distance."""
        gap = np.maximum(np.maximum(self.low - point, point - self.high), 0)
        return np.flatnonzero((gap * gap).sum(axis=1) <= limit)


def leaves(points: np.ndarray) -> list[np.ndarray]:
    """The kd-tree's leaves below a cell, as lists of rows."""
    out, todo = [], [np.arange(len(points))]
    while todo:
        rows = todo.pop()
        spread = points[rows].max(axis=0) - points[rows].min(axis=0) if len(rows) else np.zeros(1)
        if len(rows) <= LEAF or spread.max() == 0:
            out.append(rows)
            continue
        axis, half = int(spread.argmax()), len(rows) // 2
        order = rows[np.argpartition(points[rows, axis], half)]
        todo += [order[:half], order[half:]]
    return [r for r in out if len(r)]


class Index:
    """One task's rows: leaves, their boxes, vectors and ids."""

    def __init__(self, space: Space, ids: np.ndarray, vectors: np.ndarray):
        self.space = space
        points = space.project(vectors)
        self.places = leaves(points)
        self.order = np.concatenate(self.places) if self.places else np.zeros(0, np.int64)
        self.ends = np.cumsum([len(p) for p in self.places])
        self.ids, self.vectors, self.points = ids[self.order], vectors[self.order], points[self.order]
        self.low = np.array([points[p].min(axis=0) for p in self.places])
        self.high = np.array([points[p].max(axis=0) for p in self.places])

    def search(self, own: int, q: np.ndarray, k: int, bound: float) -> tuple[np.ndarray, np.ndarray]:
        """Ids and products of the nearest met; `bound` is a product that k rows elsewhere reach."""
        if not self.places:
            return self.ids, np.zeros(0)
        space = self.space
        point = space.project(q[None], query=True)[0]
        gap = np.maximum(np.maximum(self.low - point, point - self.high), 0)
        gap = (gap * gap).sum(axis=1)
        length = float(q @ q) + space.norm**2
        ids, products, kth = np.zeros(0, np.int64), np.zeros(0), bound
        for leaf in np.argsort(gap, kind="stable").tolist():
            limit = space.factor * max(length - 2 * kth, 0.0) + 1e-9  # of the squared projected distance
            if gap[leaf] > limit:
                break
            rows = slice(self.ends[leaf] - len(self.places[leaf]), self.ends[leaf])
            away = self.points[rows] - point
            good = (np.einsum("ij,ij->i", away, away) <= limit) & (self.ids[rows] != own) & (self.vectors[rows] @ q >= kth - 1e-9)
            good = np.flatnonzero(good) + rows.start
            if not len(good):
                continue
            # row by row, so that equal vectors have equal products wherever they lie
            new = (self.vectors[good] * q).sum(axis=1)
            ids, products = np.concatenate([ids, self.ids[good]]), np.concatenate([products, new])
            if len(ids) > 4 * k:
                best = np.lexsort((ids, -products))[:k]
                ids, products = ids[best], products[best]
            if len(ids) >= k:
                kth = max(kth, float(np.partition(products, len(products) - k)[len(products) - k]))
        best = np.lexsort((ids, -products))[:k]
        return ids[best], products[best]


def matrix(column) -> np.ndarray:
    return np.array(column.to_list(), np.float64) if len(column) else np.zeros((0, 0))


def placed(shared, query: bool):
    """Rows with their cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space = shared.value
        for b in batches:
            x = np.asarray(b.column("v").flatten(), np.float64).reshape(b.num_rows, -1)
            cells = space.cell(space.project(x, query)) if b.num_rows else np.zeros(0, np.int64)
            yield common.with_columns(b, [("cell", pa.int64(), cells)], drop=("cell",))

    return run


def routed(shared):
    """Queries with the other cells that their k-th product leaves open."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space = shared.value
        for b in batches:
            x = np.asarray(b.column("v").flatten(), np.float64).reshape(b.num_rows, -1)
            source, cells = [], []
            points = space.project(x, query=True) if b.num_rows else x
            for i, (q, p, kth) in enumerate(zip(x, points, b.column("kth").to_pylist())):
                limit = np.inf if kth is None else space.factor * max(float(q @ q) + space.norm**2 - 2 * kth, 0.0) + 1e-9
                for c in space.near_cells(p, limit).tolist():
                    source.append(i)
                    cells.append(c)
            out = b.take(pa.array(source, pa.int32()))
            yield common.with_columns(out, [("cell", pa.int64(), cells)], drop=("cell",))

    return run


FOUND = "query_id long, vec_id long, score double"


def searched(shared, k: int):
    def run(data: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(data) and len(queries):
            index = Index(shared.value, data["vec_id"].to_numpy(np.int64), matrix(data["v"]))
            bounds = queries["kth"].to_numpy(np.float64) if "kth" in queries else np.full(len(queries), np.nan)
            for own, q, bound in zip(queries["vec_id"].to_numpy(np.int64).tolist(), matrix(queries["v"]), bounds.tolist()):
                ids, products = index.search(own, q, k, -np.inf if math.isnan(bound) else bound)
                out.append(pd.DataFrame({"query_id": own, "vec_id": ids, "score": products}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": pd.Series([], dtype="int64"), "vec_id": pd.Series([], dtype="int64"), "score": pd.Series([], dtype="float64")})

    return run


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v")).where("vec_id is not null and v is not null")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return rows.where(finite).where(F.exists("v", lambda x: x != 0))


def blocks(rows: DataFrame, parts: DataFrame, mine: str, others: str) -> DataFrame:
    """Rows of a cell dealt to `mine` blocks by id, once for each of the `others` blocks."""
    seat = F.pmod(F.xxhash64("vec_id"), F.col(mine)).alias("seat")
    return rows.join(parts, "cell").select(*rows.columns, seat, F.explode(F.sequence(F.lit(0).cast("long"), F.col(others) - 1)).alias("other"))


def nearest(vectors: DataFrame, is_query, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, dims: int = DIMS, sure: float = SURE) -> DataFrame:
    """query_id, rank, vec_id, score of the rows for which `is_query` (a Column of vec_id) holds."""
    spark = common.ready(vectors.sparkSession)
    rows = usable(vectors, id_col, vector_col)
    sizes = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n"), F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)).alias("square"))
    most = sizes.orderBy(F.desc("n"), "d").limit(1).collect()
    if not most:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    width, total = most[0]["d"], most[0]["n"]
    rows = rows.where(F.size("v") == width)
    space = Space(width, math.sqrt(most[0]["square"]), dims, sure)
    levels = max(0, math.ceil(math.log2(max(1, min(total / CELL, CELLS)))))
    if levels:
        taken = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).collect()
        space.fit(space.project(np.array([r["v"] for r in taken])), levels)
    shared = spark.sparkContext.broadcast(space)

    data = common.settle(rows.mapInArrow(placed(shared, False), "vec_id long, v array<double>, cell long"), "cells")
    queries = common.settle(rows.where(is_query).mapInArrow(placed(shared, True), "vec_id long, v array<double>, cell long"), "queries")
    held = data.groupBy("cell").agg(F.ceil(F.count("*") / CELL).alias("d"))
    # first round: one block of the query's own cell
    own = held.join(queries.groupBy("cell").agg(F.ceil(F.count("*") / QUERIES).alias("q")), "cell")
    key = ["cell", "seat", "other"]
    one = queries.join(own, "cell").select("vec_id", "v", "cell", F.pmod(F.xxhash64("vec_id"), F.col("d")).alias("seat"), F.pmod(F.xxhash64(F.lit(3), "vec_id"), F.col("q")).alias("other"))
    first = blocks(data, own, "d", "q").groupBy(*key).cogroup(one.groupBy(*key)).applyInPandas(searched(shared, k), FOUND)
    first = common.settle(first, "first")
    kth = first.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("kth")).where(F.col("n") >= k).select(F.col("query_id").alias("vec_id"), "kth")
    kth = common.settle(kth, "kth")
    # second round: all blocks of all cells that the bound leaves open
    asked = queries.drop("cell").join(kth, "vec_id", "left")
    asked = common.settle(asked.mapInArrow(routed(shared), "vec_id long, v array<double>, kth double, cell long"), "asked")
    parts = common.settle(held.join(asked.groupBy("cell").agg(F.ceil(F.count("*") / QUERIES).alias("q")), "cell"), "parts")
    many = asked.join(parts, "cell").select("vec_id", "v", "kth", "cell", F.pmod(F.xxhash64(F.lit(3), "vec_id"), F.col("q")).alias("other"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("d") - 1)).alias("seat"))
    found = blocks(data, parts, "d", "q").groupBy(*key).cogroup(many.groupBy(*key)).applyInPandas(searched(shared, k), FOUND)
    found = found.union(first).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    by = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
