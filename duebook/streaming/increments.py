"""Increments as streams: late data, bursts, new items, silent sources.

Every stream reads landed files with ``availableNow``, so a run takes what has landed
and stops. Its memory of what was said before is a table in the shared folder, keyed
so that a batch replayed after a lost executor writes the same rows again.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from duebook.sources import versions


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors reach: spark.checkpoint.dir, or in a local session one for its lifetime."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        base = getattr(spark.sparkContext, "_duebook_folder", None) or tempfile.mkdtemp(prefix="duebook-")
        spark.sparkContext._duebook_folder = base
    return os.path.join(base, "duebook")


def work_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder for what one call writes on its way."""
    return os.path.join(shared_folder(spark), f"{name}-{uuid.uuid4().hex}")


def state_folder(spark: SparkSession, name: str) -> str:
    """The folder of a memory that lasts: the same one on every call and run."""
    return os.path.join(shared_folder(spark), "state", name)


def landed(spark: SparkSession, folder: str, glob: str = "*.parquet", files_per_batch: int = 1000) -> DataFrame:
    """A stream over the landed parquet files of a folder; their schema is read from them once."""
    schema = spark.read.option("pathGlobFilter", glob).parquet(folder).schema
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", glob)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(folder)
    )


def drain(stream: DataFrame, folder: str, each: Callable[[DataFrame, int], None], mode: str) -> None:
    """Run a stream to the end of what has landed."""
    q = (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .foreachBatch(each)
        .start()
    )
    q.awaitTermination()


def held(spark: SparkSession, path: str, schema) -> DataFrame:
    """A table in the work folder, empty before its first write."""
    try:
        return spark.read.schema(schema).parquet(path)
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def batch_path(path: str, batch: int) -> str:
    """Each batch owns a partition folder, so a replay replaces what it wrote."""
    return f"{path}/batch={batch}"


def dedupe_late(stream: DataFrame, time: str, key: list[str], late: str = "30 days") -> DataFrame:
    """Each key once, however late its copies come within the window."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark(key)


def collect_stream(spark: SparkSession, stream: DataFrame, folder: str) -> DataFrame:
    """Append a stream to a table in the folder and read the table."""
    out = f"{folder}/rows"

    def write(df: DataFrame, batch: int) -> None:
        df.write.mode("overwrite").parquet(batch_path(out, batch))

    drain(stream, folder, write, "append")
    return held(spark, out, stream.schema).drop("batch")


def say_once(spark: SparkSession, found: DataFrame, key: list[str], folder: str, condition: Column, mode: str = "update") -> DataFrame:
    """Report each key once: the keys that meet the condition, less those said in earlier batches.

    What was said is a versioned table with a partition per batch, checked before it is used. A
    replayed batch replaces its own partition. Where no version is whole nothing is said."""
    said = f"{folder}/said"
    schema = found.select(*key).schema

    def write(df: DataFrame, batch: int) -> None:
        before, version, _ = versions.read_whole(spark, said)
        if before is None and versions.versions(spark, said):
            return
        now = df.where(condition).select(*key).distinct()
        if before is not None:
            now = now.join(before.where(F.col("batch") != batch), key, "left_anti")
        versions.publish(now.withColumn("batch", F.lit(batch).cast("long")), said, ["batch"])

    drain(found, folder, write, mode)
    rows, _, _ = versions.read_whole(spark, said)
    return spark.createDataFrame([], schema) if rows is None else rows.select(*key)


def say_new(spark: SparkSession, items: DataFrame, key: list[str], folder: str, run: str) -> tuple[DataFrame, DataFrame]:
    """Items that no earlier run has said, and notices about the memory.

    The memory is a versioned table of keys with a partition per run, checked before use. A run
    advances it once: said again under the same name it gives the same items. A damaged version
    is passed over with a notice for the last whole one; where none is whole nothing is new."""
    seen, version, notices = versions.read_whole(spark, folder)
    if seen is None:
        if versions.versions(spark, folder):
            return items.limit(0), notices
        fresh = items.select(*key).distinct()
    else:
        done = seen.where(F.col("run") == run)
        if not done.isEmpty():
            return items.join(done.select(*key), key, "left_semi"), notices
        fresh = items.select(*key).distinct().join(seen.select(*key), key, "left_anti")
    fresh = fresh.withColumn("run", F.lit(run))
    if fresh.isEmpty():
        return items.limit(0), notices
    now = versions.publish(fresh, folder, ["run"])
    return items.join(versions.read(spark, folder, now, [f"run={run}"]).select(*key), key, "left_semi"), notices


ALARM = "source string, day date, outcome string, days int"


def alarm(rows: DataFrame, period: int) -> DataFrame:
    """Raise a source that is silent for ``period`` days, once a period, and say when it is back.

    ``rows`` is a stream of (source, kind, day): kind is seen, or check for the day on which a run
    looks. Per source Spark's state store keeps the newest day seen, and when it was raised: a
    later run of the same stream goes on from there. One row of state a source."""

    def judge(key, batches, state):
        last, raised = state.get if state.exists else (None, None)
        rows = sorted((d, k != "seen", k) for b in batches for d, k in zip(b["day"], b["kind"]))
        out = []
        for day, _, kind in rows:
            at = day.toordinal()
            if kind == "seen":
                last = max(last or at, at)
                continue
            silent = None if last is None else at - last
            if silent is not None and silent < period:
                if raised is not None:
                    out.append((key[0], day, "back", silent))
                raised = None
            elif raised is None:
                out.append((key[0], day, "raised", silent))
                raised = at
            elif at - raised >= period:
                out.append((key[0], day, "raised again", silent))
                raised = at
        state.update((last, raised))
        yield pd.DataFrame(out, columns=["source", "day", "outcome", "days"]).astype({"days": "Int32"})

    return rows.groupBy("source").applyInPandasWithState(judge, ALARM, "last int, raised int", "append", "NoTimeout")


def daily_counts(stream: DataFrame, time: str, by: list[str], late: str = "30 days") -> DataFrame:
    """Tumbling one-day counts per class."""
    w = stream.withWatermark(time, late).groupBy(F.window(time, "1 day"), *by).agg(F.count("*").alias("n"))
    return w.select(F.to_date("window.start").alias("day"), *by, "n")


def last_seen(stream: DataFrame, time: str, by: list[str]) -> DataFrame:
    """The newest time per source, kept as state."""
    return stream.groupBy(*by).agg(F.max(time).alias("last"))


def stale(seen: DataFrame, as_at: Column, days: int, alerted: DataFrame, by: list[str]) -> DataFrame:
    """Sources unread for ``days``, less those raised within the last ``days``."""
    recent = alerted.where(F.datediff(as_at, F.to_date("raised")) < days).select(*by).distinct()
    silent = seen.withColumn("days", F.datediff(as_at, F.to_date("last"))).where(F.col("days") >= days)
    return silent.join(recent, by, "left_anti")


def quietly(read: Callable[[], DataFrame], otherwise: DataFrame) -> DataFrame:
    """State that cannot be read says nothing new instead of failing the build."""
    try:
        df = read()
        df.write.format("noop").mode("overwrite").save()  # reads every row and column: a broken file shows here
        return df
    except Exception:  # noqa: BLE001
        return otherwise
