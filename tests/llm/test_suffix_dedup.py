"""Repeated passages against brute force."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from duebook.llm import suffix_dedup
from duebook.llm.queries import QUERIES
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, doc string, hash int, bytes string, kept long, spots string"


def brute(rows, n=suffix_dedup.LENGTH):
    """(id, bytes, removed, spans, kept) in the given order, by a set of all strings of n bytes."""
    seen, out = set(), []
    for i, text in rows:
        b = (text or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - n + 1):
            s = b[k : k + n]
            if s in seen:
                gone[k : k + n] = b"\1" * n
            seen.add(s)
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((i, len(b), sum(gone), sum(g and not p for p, g in zip(b"\0" + gone, gone)), hashlib.sha256(kept).hexdigest()))
    return out


def result(spark, rows, partitions=3):
    docs = spark.createDataFrame([(i, t, "d", 1, "b", 2, "s") for i, t in rows], DOCS).repartition(partitions)
    out = suffix_dedup.dedup(docs)
    assert out.columns == ["doc_id", "doc", "hash", "bytes", "spots", "n_bytes", "n_removed", "n_spans", "removed", "kept"]
    got = out.withColumn("sha", F.sha2("kept", 256)).collect()
    assert all((r.doc, r.hash, r.bytes, r.spots) == ("d", 1, "b", "s") and r.n_removed == sum(s.end - s.start for s in r.removed) for r in got)
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.sha) for r in got), key=str)


def corpus(seed):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdeé") for _ in range(r.randrange(2, 6)))
    passages = [" ".join(word() for _ in range(r.randrange(8, 60))) for _ in range(6)] + ["ab" * 90, "x" * 260, "aab" * 50]
    rows = []
    for i in range(70):
        parts = []
        for _ in range(r.randrange(1, 6)):
            p = r.choice(passages)
            a = r.randrange(len(p) // 2)
            parts += [" ".join(word() for _ in range(r.randrange(20))), p[a : a + r.choice([99, 100, 101, 130, 400])]]
        rows.append((i, "".join(parts)))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_repeated_strings_equal_brute_force(spark, seed):
    rows = corpus(seed)
    assert result(spark, rows) == sorted(brute(rows), key=str)


def test_every_string_has_one_anchor():
    rows = corpus(7)
    out = suffix_dedup.anchors([t.encode() for _, t in rows])
    assert len(set(zip(out[0].tolist(), out[1].tolist()))) == len(out[0]) and (out[2] >= out[3]).all()
    # at the same offset wherever it stands
    where: dict = {}
    for text, at, most, least in zip(*(x.tolist() for x in out[:4])):
        b = rows[text][1].encode()
        for before in range(least, most + 1):
            where.setdefault(b[at - before : at - before + 100], set()).add(before)
    assert all(len(v) == 1 for v in where.values())
    assert set(where) == {b[k : k + 100] for b in (t.encode() for _, t in rows) for k in range(len(b) - 99)}


def test_odd_rows(spark):
    long = " ".join(f"w{k % 997}" for k in range(30_000))
    text = "the same hundred bytes and more " * 3 + "é" * 20
    rows = [(1, None), (2, ""), (3, "short"), (3, "short"), (4, text), (5, "before " + text + " after"), (6, text[:99]), (7, long), (8, "z" * 5000), (9, text), (9, text), (10, "中" * 40 + text[-110:])]
    assert result(spark, rows) == sorted(brute(rows), key=str)
    lost = [(4, text), (None, text), (None, "q" * 100), (-3, "q" * 100)]
    got = result(spark, lost)
    assert got == sorted(brute([lost[3], lost[0], *lost[1:3]]), key=str)
    # rows of one id: the text of the smaller hash is the first
    both = [(5, text + "A" * 60), (5, "B" * 60 + text)]
    order = [r.t for r in spark.createDataFrame(both, "i long, t string").orderBy(F.xxhash64(F.encode("t", "utf-8"))).collect()]
    assert result(spark, both) == sorted(brute([(5, t) for t in order]), key=str)
    assert suffix_dedup.dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_a_passage_of_a_third_of_all_rows(spark):
    r = random.Random(3)
    shared = " ".join(f"{r.randrange(10**6)}" for _ in range(60))
    rows = [(i, f"{r.random()} " * r.randrange(3, 9) + (shared if i % 3 == 0 else "") + f" {r.random()}" * 6) for i in range(900)]
    assert result(spark, rows, 9) == sorted(brute(rows), key=str)


def test_the_query_equals_brute_force(spark):
    import pyarrow.parquet as pq

    t = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    want = brute(sorted((d["doc_id"], d["text"]) for d in t))
    got = [tuple(x) for x in QUERIES["op13_suffix_dedup"](spark, "/root/testdata/sf0.01").collect()]
    assert sorted(got) == sorted(want) and sum(x[2] for x in want) > 10_000


def test_the_interleave_orders_rows_and_knows_what_they_share():
    r = random.Random(1)
    rows = [bytes(r.choice(b"ab") if k > 9 or r.random() < 0.1 else 97 for k in range(24)) for _ in range(300)]
    order, shared = suffix_dedup.interleave(suffix_dedup.symbols(np.frombuffer(b"".join(rows), np.uint8).reshape(-1, 24)))
    assert [rows[i] for i in order] == sorted(rows)
    for k in range(1, len(rows)):
        a, b = rows[order[k - 1]], rows[order[k]]
        assert shared[k] == next((i for i in range(24) if a[i] != b[i]), 24)
