"""What the operators share: scratch tables, whole-column access to Arrow batches, code shipping."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
import zipfile

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of one Arrow batch. A batch is the unit of memory in a Python worker.
BATCH_ROWS = 512


def ready(spark: SparkSession) -> SparkSession:
    """Small Arrow batches, and the package on every executor that cannot import it by path."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    sc = spark.sparkContext
    if not getattr(sc, "_duebook_shipped", False):
        top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        path = os.path.join(tempfile.mkdtemp(prefix="duebook-"), "duebook_code.zip")
        with zipfile.ZipFile(path, "w") as z:
            for folder, _, names in os.walk(os.path.join(top, "duebook")):
                for name in names:
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        z.write(full, os.path.relpath(full, top))
        sc.addPyFile(path)
        sc._duebook_shipped = True
    return spark


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share (spark.checkpoint.dir).

    Only a local session without that setting, as in tests, gets a folder of its own."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        sc = spark.sparkContext
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        root = sc._duebook_scratch = getattr(sc, "_duebook_scratch", None) or "file://" + tempfile.mkdtemp(prefix="duebook-scratch-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and go on from what was written."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def thinned(rows: DataFrame, group: str, hash_col: str, most: int) -> DataFrame:
    """Rows that may hold the `most` smallest hashes of their group: at any size of the group about
    4 * most different hashes of it, all of them where it has fewer.

    The bar comes from a count of the distinct hashes (a few percent off, which four times as
    many as wanted covers), so what goes on to a choice does not grow with the table. What is
    broadcast is a row a group: a label or language that a model is made for."""
    sizes = rows.groupBy(group).agg(F.approx_count_distinct(hash_col).alias("__size"))
    share = F.shiftrightunsigned(F.col(hash_col), 11) / F.lit(float(1 << 53))
    return rows.join(F.broadcast(sizes), group).where(share * F.col("__size") < 4 * most).drop("__size")


def key_of(*cols: Column) -> Column:
    """128 bits of two independent hashes, as one short string-free struct key."""
    return F.struct(F.xxhash64(*cols).alias("a"), F.xxhash64(F.lit(7), *cols).alias("b"))


def strings(batch: pa.RecordBatch, name: str) -> list[str]:
    """A text column as Python strings, null as empty."""
    return [t or "" for t in batch.column(name).to_pylist()]


class Memory:
    """A bounded memory of what was computed, in two generations: what is still asked for moves on.

    Beyond `most` it holds what one call asks for."""

    def __init__(self, most: int):
        self.half, self.young, self.old = most // 2, {}, {}

    def holding(self, asked: set, made) -> dict:
        """A dictionary that has all that is asked for; `made` computes a list of what is not known."""
        if len(self.young) >= self.half:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        missing = asked - young.keys()
        for key in missing & old.keys():
            young[key] = old[key]
        new = list(missing - old.keys())
        if new:
            young.update(zip(new, made(new)))
        return young


def unhurried(run):
    """A batch function without the cycle collector, which would walk the worker's memory again and again."""

    def inner(batches):
        gc.collect()
        gc.disable()
        try:
            yield from run(batches)
        finally:
            gc.enable()

    return inner


def with_columns(batch: pa.RecordBatch, arrays: list[tuple[str, pa.DataType, object]], drop: tuple[str, ...] = ()) -> pa.RecordBatch:
    """The batch without `drop`, and with more columns behind."""
    keep = [n for n in batch.schema.names if n not in drop]
    return pa.RecordBatch.from_arrays(
        [batch.column(n) for n in keep] + [a if isinstance(a, pa.Array) else pa.array(a, t) for _, t, a in arrays], names=keep + [n for n, _, _ in arrays]
    )
