"""What lasts between runs: damaged files, stopped publishes, replays, an alarm's memory."""

from __future__ import annotations

import glob
import os

import pytest
from duebook.sources import versions
from duebook.streaming import increments
from pyspark.sql import functions as F


def frame(spark, rows):
    return spark.createDataFrame(rows, "year int, id long, name string")


def ids(df):
    return sorted(r.id for r in df.collect())


def test_partitions_are_replaced_and_old_versions_stay(spark, tmp_path):
    path = str(tmp_path / "t")
    assert versions.versions(spark, path) == [] and versions.read_whole(spark, path)[:2] == (None, 0)
    with pytest.raises(ValueError):
        versions.read(spark, path)
    assert versions.publish(frame(spark, [(1, 1, "a"), (2, 2, None), (None, 3, "c")]), path, ["year"]) == 1
    assert versions.publish(frame(spark, [(2, 20, "b"), (3, 30, "")]), path, ["year"]) == 2
    assert ids(versions.read(spark, path)) == [1, 3, 20, 30] and ids(versions.read(spark, path, 1)) == [1, 2, 3]
    assert versions.read(spark, path).columns == ["year", "id", "name"]
    assert ids(versions.read(spark, path, only=["year=2"])) == [20]
    assert versions.faults(spark, path, 1) == versions.faults(spark, path, 2) == []
    assert versions.publish(frame(spark, []), path, ["year"]) == 3 and ids(versions.read(spark, path)) == [1, 3, 20, 30]


def test_a_damaged_file_falls_back_and_says_so(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.publish(frame(spark, [(1, 1, "a")]), path, ["year"])
    versions.publish(frame(spark, [(2, 2, "b")]), path, ["year"])
    new = next(f for f in glob.glob(f"{path}/data/00000002-*/year=2/*.parquet"))
    with open(new, "r+b") as f:
        f.seek(4)
        f.write(b"\0" * 40)
    if os.path.exists(crc := os.path.join(os.path.dirname(new), f".{os.path.basename(new)}.crc")):
        os.remove(crc)
    df, version, notices = versions.read_whole(spark, path)
    assert version == 1 and ids(df) == [1] and [(n.version, n.partition) for n in notices.collect()] == [(2, "year=2")]
    # a file that is gone, and a commit that is no JSON
    versions.publish(frame(spark, [(3, 3, "c"), (3, 4, "d")]), path, ["year"])
    os.remove(next(iter(glob.glob(f"{path}/data/00000003-*/year=3/*.parquet"))))
    with open(f"{path}/commits/00000004.json", "w") as f:
        f.write("{")
    df, version, notices = versions.read_whole(spark, path)
    assert version == 1 and {(n.version, n.outcome) for n in notices.collect()} >= {(4, "the commit cannot be read")}
    assert {n.version for n in notices.collect()} == {2, 3, 4}


@pytest.mark.parametrize("step", ["create", "rename"])
def test_a_publish_that_stops_leaves_the_version_before_it(spark, tmp_path, monkeypatch, step):
    path = str(tmp_path / "t")
    versions.publish(frame(spark, [(1, 1, "a")]), path, ["year"])

    class Stops:
        def __init__(self, store):
            self.store = store

        def __getattr__(self, name):
            if name == step:
                raise RuntimeError("stopped")
            return getattr(self.store, name)

    own = versions._store
    monkeypatch.setattr(versions, "_store", lambda s, p: (lambda j, f, a: (j, Stops(f), a))(*own(s, p)))
    with pytest.raises(RuntimeError):
        versions.publish(frame(spark, [(1, 9, "z"), (2, 2, "b")]), path, ["year"])
    monkeypatch.undo()
    df, version, _ = versions.read_whole(spark, path)
    assert version == 1 and ids(df) == [1]
    assert versions.publish(frame(spark, [(2, 2, "b")]), path, ["year"]) == 2 and ids(versions.read(spark, path)) == [1, 2]


def test_open_partitions_are_those_that_change_or_are_not_held(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.publish(frame(spark, [(1, 1, "a"), (2, 2, "b")]), path, ["year"])
    assert versions.open_partitions(spark, path, ["year=1", "year=2", "year=3"], ["year=2"]) == ["year=2", "year=3"]
    asked = []

    def fetch(todo):
        asked.append(todo)
        return frame(spark, [(3, 3, "new")])

    rows = versions.refresh(spark, path, "year", [1, 2, 3, 4], [2], fetch)
    assert asked == [[2, 3, 4]] and sorted((r.year, r.stale) for r in rows.collect()) == [(1, False), (2, True), (3, False)]


def test_each_run_says_only_what_is_new(spark, tmp_path):
    folder = str(tmp_path / "seen")
    items = lambda *n: spark.createDataFrame([(i, f"t{i}") for i in n], "id long, title string")
    say = lambda df, run: ids(increments.say_new(spark, df, ["id"], folder, run)[0])
    assert say(items(), "r0") == [] and say(items(1, 2), "r1") == [1, 2] and say(items(1, 2, 3, 3), "r2") == [3, 3]
    assert say(items(1, 2, 3), "r2") == [3] and len(versions.versions(spark, folder)) == 2  # a replay advances nothing
    assert say(items(1, 2, 3), "r3") == []
    # the newest memory is damaged: the one before it is used, with a notice
    newest = next(iter(glob.glob(f"{folder}/data/00000002-*/run=r2/*.parquet")))
    os.remove(newest)
    fresh, notices = increments.say_new(spark, items(1, 3, 4), ["id"], folder, "r4")
    assert ids(fresh) == [3, 4] and [n.version for n in notices.collect()] == [2]
    # no version is whole: nothing is said, and nothing is forgotten
    for f in glob.glob(f"{folder}/data/*/*/*.parquet"):
        os.remove(f)
    before = len(versions.versions(spark, folder))
    fresh, notices = increments.say_new(spark, items(1, 9), ["id"], folder, "r5")
    assert fresh.count() == 0 and notices.count() >= 1 and len(versions.versions(spark, folder)) == before


def test_the_alarm_remembers(spark, tmp_path):
    folder = str(tmp_path)

    def run(rows):
        spark.createDataFrame(rows, "source string, kind string, day string").withColumn("day", F.to_date("day")).coalesce(1).write.mode("append").parquet(f"{folder}/landed")
        out = []
        stream = increments.landed(spark, f"{folder}/landed")
        increments.drain(increments.alarm(stream, 5), folder, lambda df, batch: out.extend(df.collect()), "append")
        return sorted((r.source, str(r.day), r.outcome, r.days) for r in out)

    assert run([("a", "seen", "2024-01-01"), ("a", "check", "2024-01-07"), ("b", "check", "2024-01-07")]) == [("a", "2024-01-07", "raised", 6), ("b", "2024-01-07", "raised", None)]
    assert run([("a", "check", "2024-01-09"), ("b", "check", "2024-01-09")]) == []
    assert run([("a", "check", "2024-01-12"), ("b", "seen", "2024-01-11"), ("b", "check", "2024-01-12")]) == [("a", "2024-01-12", "raised again", 11), ("b", "2024-01-12", "back", 1)]
    assert run([("a", "seen", "2024-01-13"), ("a", "check", "2024-01-14"), ("b", "check", "2024-01-20")]) == [("a", "2024-01-14", "back", 1), ("b", "2024-01-20", "raised", 9)]


def test_folders_of_work_are_fresh_and_those_of_state_are_not(spark):
    assert increments.work_folder(spark, "x") != increments.work_folder(spark, "x")
    assert increments.state_folder(spark, "x") == increments.state_folder(spark, "x")
