"""Tables whose partitions are published one version at a time.

A version is one small commit file that names, for every live partition, the folder that holds it,
its row count and a checksum. Data is written beside everything else first; the commit file is
put in place by one rename, so a stop at any step leaves the version before it, whole. Partitions
that a publish does not bring stay as the version before had them, and old versions stay readable.

A reader checks what it reads against the commit, and goes back to the last version that is whole.
There is one writer at a time; a second one that publishes the same number is refused.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

NOTICE = "version int, partition string, outcome string"


def _store(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), at


def _folder(path: str, name: str) -> str:
    return f"{path.rstrip('/')}/{name}"


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the published versions, the oldest first."""
    _, store, at = _store(spark, _folder(path, "commits"))
    if not store.exists(at):
        return []
    names = [s.getPath().getName() for s in store.listStatus(at)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith((".", "_")))


def commit_of(spark: SparkSession, path: str, version: int) -> dict:
    """What a commit file says; raises where it cannot be read as one."""
    text = spark.read.text(_folder(path, f"commits/{version:08d}.json"), wholetext=True).first()[0]
    return json.loads(text)


def _key(by: list[str]) -> Column:
    return F.concat_ws("/", *[F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit("__null"))) for c in by])


def _summary(df: DataFrame, by: list[str]) -> DataFrame:
    """(partition, rows, checksum): the sum of row hashes, whatever the order of rows."""
    own = [F.col(c) for c in sorted(df.columns)]
    nulls = F.concat(*[F.when(c.isNull(), "0").otherwise("1") for c in own])
    return df.groupBy(_key(by).alias("partition")).agg(F.count("*").alias("rows"), F.sum(F.xxhash64(nulls, *own).cast("decimal(38,0)")).cast("string").alias("checksum"))


def _put(spark: SparkSession, path: str, version: int, commit: dict) -> None:
    name = f"{version:08d}.json"
    beside = _folder(path, f"commits/.{name}-{uuid.uuid4().hex}")
    _, store, tmp = _store(spark, beside)
    _, _, final = _store(spark, _folder(path, f"commits/{name}"))
    out = store.create(tmp, False)
    out.write(json.dumps(commit, sort_keys=True).encode())
    out.close()
    if store.exists(final) or not store.rename(tmp, final):
        store.delete(tmp, False)
        raise ValueError(f"version {version} of {path} was published by someone else")


def publish(df: DataFrame, path: str, by: list[str]) -> int:
    """Publish the partitions that ``df`` has; the others stay as they are. The new version's number."""
    spark = df.sparkSession
    known = versions(spark, path)
    live = commit_of(spark, path, known[-1])["partitions"] if known else {}
    version = known[-1] + 1 if known else 1
    folder = f"data/{version:08d}-{uuid.uuid4().hex}"
    df.write.partitionBy(*by).parquet(_folder(path, folder))
    written = spark.read.schema(df.schema).parquet(_folder(path, folder))
    # a row a partition: years, editions, runs
    new = {r["partition"]: {"folder": folder, "rows": r["rows"], "checksum": r["checksum"]} for r in _summary(written.select(*df.columns), by).collect()}
    _put(spark, path, version, {"version": version, "by": by, "schema": json.loads(df.schema.json()), "partitions": {**live, **new}})
    return version


def read(spark: SparkSession, path: str, version: int | None = None, only: list[str] | None = None) -> DataFrame:
    """The rows of a version, the newest if none is named; of ``only`` these partitions."""
    known = versions(spark, path)
    if not known:
        raise ValueError(f"nothing was published to {path}")
    commit = commit_of(spark, path, version or known[-1])
    schema = T.StructType.fromJson(commit["schema"])
    by_folder: dict[str, list[str]] = {}
    for key, p in commit["partitions"].items():
        if only is None or key in only:
            by_folder.setdefault(p["folder"], []).append(key)
    parts = [spark.read.schema(schema).parquet(_folder(path, f)).select(*schema.names).where(_key(commit["by"]).isin(keys)) for f, keys in sorted(by_folder.items())]
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], schema)


def faults(spark: SparkSession, path: str, version: int) -> list[tuple[int, str, str]]:
    """What is wrong with a version: partitions that are short, altered or unreadable."""
    try:
        commit = commit_of(spark, path, version)
        schema, stated = T.StructType.fromJson(commit["schema"]), commit["partitions"]
    except Exception:  # noqa: BLE001
        return [(version, "", "the commit cannot be read")]
    out = []
    for folder in sorted({p["folder"] for p in stated.values()}):
        own = {k: p for k, p in stated.items() if p["folder"] == folder}
        try:
            df = spark.read.schema(schema).parquet(_folder(path, folder)).select(*schema.names)
            found = {r["partition"]: r for r in _summary(df, commit["by"]).collect()}
        except Exception:  # noqa: BLE001
            out += [(version, k, "cannot be read") for k in own]
            continue
        for k, p in own.items():
            r = found.get(k)
            if r is None or r["rows"] != p["rows"]:
                out.append((version, k, "rows are missing" if r is None or r["rows"] < p["rows"] else "rows were added"))
            elif r["checksum"] != p["checksum"]:
                out.append((version, k, "rows were changed"))
    return sorted(out)


def read_whole(spark: SparkSession, path: str) -> tuple[DataFrame | None, int, DataFrame]:
    """The newest version that is whole, its number (0 if there is none), and a row for what was not.

    Every version is checked against its commit, the newest first, until one holds."""
    notices: list[tuple[int, str, str]] = []
    for version in reversed(versions(spark, path)):
        wrong = faults(spark, path, version)
        if not wrong:
            return read(spark, path, version), version, spark.createDataFrame(notices, NOTICE)
        notices += wrong
    return None, 0, spark.createDataFrame(notices, NOTICE)


def open_partitions(spark: SparkSession, path: str, wanted: list[str], changing: list[str]) -> list[str]:
    """Of the wanted partitions those to read anew: those that can still change, and those no version holds."""
    known = versions(spark, path)
    live = commit_of(spark, path, known[-1])["partitions"] if known else {}
    return [k for k in wanted if k in changing or k not in live]


def refresh(spark: SparkSession, path: str, by: str, wanted: list, changing: list, fetch: Callable[[list], DataFrame]) -> DataFrame:
    """Read the open partitions anew and publish what came; the rows of all wanted ones, with ``stale``
    on those that were open and did not come."""
    key = lambda v: f"{by}={v}"
    todo = open_partitions(spark, path, [key(v) for v in wanted], [key(v) for v in changing])
    if todo:
        publish(fetch([v for v in wanted if key(v) in todo]), path, [by])
    newest = versions(spark, path)[-1]
    commit = commit_of(spark, path, newest)
    this = commit["partitions"]
    came = [k for k in todo if k in this and this[k]["folder"].startswith(f"data/{newest:08d}-")]
    late = [k for k in todo if k not in came]
    rows = read(spark, path, newest, [key(v) for v in wanted])
    return rows.withColumn("stale", _key([by]).isin(late) if late else F.lit(False))
