"""Readers, sinks and streams on files."""

import datetime as dt

import pytest
from pyspark.sql import functions as F, types as T

from duebook.sources import read_table
from duebook.sources import sinks, tables
from duebook.streaming import increments


def test_csv_with_mark_newlines_and_bad_values(spark, tmp_path):
    p = tmp_path / "a.csv"
    p.write_text('﻿id,title,ok,day\n1,"two\nlines",True,2020-01-02\nx,,no,\n', encoding="utf-8")
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("title", T.StringType()), T.StructField("ok", T.BooleanType()), T.StructField("day", T.DateType()), T.StructField("extra", T.StringType())])
    rows = read_table(spark, str(p), schema).collect()
    assert [tuple(r) for r in rows] == [(1, "two\nlines", True, dt.date(2020, 1, 2), ""), (None, "", False, None, "")]


def test_corpus_and_typography(spark, tmp_path):
    for name, body in (("7_2.txt", "second"), ("7_1.txt", "first"), ("8_1.txt", "other")):
        (tmp_path / name).write_text(body)
    got = tables.first_file(tables.read_corpus(spark, f"{tmp_path}/*.txt")).collect()
    assert {r["doc_id"]: r["text"] for r in got} == {7: "first", 8: "other"}
    (tmp_path / "t.tsv").write_text("Calibri\t11.0\t85\tFull line\nArial\t9\tOld line\n")
    got = {r["text"]: (r["size"], r["down"]) for r in tables.read_typography(spark, f"{tmp_path}/t.tsv").collect()}
    assert got == {"Full line": (11.0, 85.0), "Old line": (9.0, -1.0)}


def test_refresh_replaces_only_its_partitions(spark, tmp_path):
    p = f"{tmp_path}/t"
    sinks.write_table(spark.createDataFrame([(1, 2019), (2, 2020)], "id int, y int"), p, ["y"])
    sinks.refresh_partitions(spark.createDataFrame([(9, 2020)], "id int, y int"), p, ["y"])
    assert sorted((r["id"], r["y"]) for r in spark.read.parquet(p).collect()) == [(1, 2019), (9, 2020)]


def test_index_export(spark, tmp_path):
    df = spark.createDataFrame([(1, None)], "id int, title string")
    out = sinks.export_index(df, {"id": "i", "title": "t"}, f"{tmp_path}/x")
    assert [tuple(r) for r in out.collect()] == [("1", "")]
    assert spark.read.json(f"{tmp_path}/x").count() == 1


def landed_days(spark, tmp_path):
    """One file per day, the second with late copies of the first."""
    rows = [(i, dt.datetime(2024, 1, 1 + i // 10, 5), "a" if i % 2 else "b") for i in range(30)]
    for n, part in enumerate((rows[:10], rows[5:20], rows[18:])):
        spark.createDataFrame(part, "id long, ts timestamp, c string").coalesce(1).write.parquet(f"{tmp_path}/in/batch{n}.parquet")
    return f"{tmp_path}/in/*"


def test_streams_equal_their_batch_twins_over_many_batches(spark, tmp_path):
    source = landed_days(spark, tmp_path)

    def stream():
        return increments.landed(spark, source, files_per_batch=1)

    once = increments.collect_stream(spark, increments.dedupe_late(stream(), "ts", ["id"]), increments.work_folder(spark, "a"))
    assert sorted(r["id"] for r in once.collect()) == list(range(30))
    counts = increments.daily_counts(stream(), "ts", ["c"])
    said = increments.say_once(spark, counts, ["day", "c"], increments.work_folder(spark, "b"), F.col("n") >= 6).collect()
    batch = spark.read.parquet(source).groupBy(F.to_date("ts").alias("day"), "c").count().where("count >= 6").collect()
    assert sorted((r["day"], r["c"]) for r in said) == sorted((r["day"], r["c"]) for r in batch) and said


def test_unreadable_state_says_nothing(spark):
    empty = spark.createDataFrame([], "id long")
    assert increments.quietly(lambda: spark.read.parquet("/nowhere/at/all"), empty).count() == 0


def test_a_failing_write_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_table(spark.range(10), path)
    bad = spark.range(10).selectExpr("CASE WHEN id = 7 THEN raise_error('no') ELSE id END AS id")
    with pytest.raises(Exception, match="no"):
        sinks.write_table(bad, path)
    assert spark.read.parquet(path).count() == 10
    sinks.write_table(spark.range(3), path)
    assert spark.read.parquet(path).count() == 3


def test_broken_state_says_nothing(spark, tmp_path):
    path = tmp_path / "state"
    spark.range(5).coalesce(1).write.parquet(str(path))
    part = next(path.glob("part-*.parquet"))
    raw = bytearray(part.read_bytes())
    raw[4:40] = bytes(36)
    part.write_bytes(bytes(raw))
    next(path.glob(".part-*.crc")).unlink()
    empty = spark.range(0)
    assert increments.quietly(lambda: spark.read.schema("id long").parquet(str(path)), empty) is empty
