"""Runs of words against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest
from duebook.llm import queries, word_runs

DOCS = "doc_id long, text string, runs string, collapsed long, n_runs string"


def brute(w):
    """Every stretch of words q apart that are equal, by going through all q."""
    n, best = len(w), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(12, 2 * q):
                best.setdefault((i, j + q), q)
            i = j
    return sorted((s, e - s, q) for (s, e), q in best.items())


def mixtures(r):
    kinds = r.choice([1, 2, 3, 4, 30])
    w = [str(r.randrange(kinds)) for _ in range(r.randrange(90))]
    for _ in range(r.randrange(4)):
        k, size = r.randrange(len(w) + 1), r.randrange(1, 20)
        w[k:k] = (w[k : k + size] or ["x"]) * r.randrange(1, 6)
        if r.random() < 0.5:
            w.insert(r.randrange(len(w) + 1), "y")
    return w[:400]


@pytest.mark.parametrize("seed", range(8))
def test_runs_equal_brute_force(seed):
    r = random.Random(seed)
    for _ in range(150):
        w = mixtures(r)
        assert word_runs.runs(w) == brute(w), w


def test_a_few_candidates_at_a_time(monkeypatch):
    monkeypatch.setattr(word_runs, "SLICE", 3)
    r = random.Random(99)
    for _ in range(60):
        w = mixtures(r)
        assert word_runs.runs(w) == brute(w), w


def test_regular_words():
    a, b = "a", "ab"
    for _ in range(9):
        a, b = b, b + a  # Fibonacci
    thue = "".join(str(bin(i).count("1") % 2) for i in range(256))
    for w in (b, thue, "a" * 200, "ab" * 90 + "a", "aab" * 40 + "aa" * 30, ("a" * 11 + "b") * 9):
        assert word_runs.runs(list(w)) == brute(w)
    assert word_runs.runs(["w"] * 60_000) == [(0, 60_000, 1)]
    long = [str(i) for i in range(30_000)] * 3
    assert word_runs.runs(long) == [(0, 90_000, 30_000)]


def test_the_grammar_gives_the_words_back():
    r = random.Random(4)
    for _ in range(100):
        ids = [r.randrange(3) for _ in range(r.randrange(80))]
        rules, top = word_runs.repair(ids)
        for left, size, at in rules:
            assert len(at) > 1 and 0 < left < size and len({tuple(ids[i : i + size]) for i in at}) == 1
        pieces = [tuple(ids[i:j]) for i, j in zip(top, [*top[1:], len(ids)])]
        pairs = list(zip(pieces, pieces[1:]))
        assert [x for p in pieces for x in p] == ids
        held = {p for p in pairs if any(pairs[i] == pairs[j] == p for i in range(len(pairs)) for j in range(i + 2, len(pairs)))}
        # two equal pairs on top differ in their symbols, or share one
        assert all(len(p[0]) + len(p[1]) > 2 for p in held)


def replayed(i, words):
    h = zlib.crc32(str(i).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n or i is None:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if k < a else words[a + (k - a) % p] for k, w in enumerate(words)]


def expected(i, text):
    w = replayed(i, re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    found = brute(w)
    top = min(found, key=lambda x: (-x[1], x[0], x[2]), default=None)
    drop = {k for s, n, q in found for k in range(s + q, s + n)}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    head = (*top, 1000 * top[1] // top[2]) if top else (None,) * 4
    return (i, len(found), *head, sha("".join(f"{s},{n},{q}\n" for s, n, q in found)), sha(" ".join(x for k, x in enumerate(w) if k not in drop)))


def columns(rows):
    return sorted(((r.doc_id, r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256) for r in rows), key=str)


def test_the_query_equals_brute_force(spark):
    import pyarrow.parquet as pq

    t = pq.read_table("/root/testdata/sf0.001/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    want = [expected(d["doc_id"], d["text"]) for d in t]
    assert columns(queries.op12_word_runs(spark, "/root/testdata/sf0.001").collect()) == sorted(want, key=str)
    assert sum(x[1] > 0 for x in want) >= 10


def test_odd_rows(spark, tmp_path):
    line = "one two\tthree\n"
    rows = [(1, None), (2, ""), (3, " \n\x0b"), (4, line * 9), (4, line * 9), (5, "a\x1cb é\xa0 " * 20), (None, "x " * 40), (14, "q " * 30 + "r " * 30), *((i, f"w{i} " + "p q r s t u v " * (i % 5)) for i in range(20, 90))]
    docs = spark.createDataFrame([(i, t, "r", 0, "n") for i, t in rows], DOCS)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = columns(queries.op12_word_runs(spark, str(tmp_path)).collect())
    assert got == sorted((expected(i, t) for i, t in rows), key=str)
    plain = {r.doc_id: (r.n_runs, [tuple(x) for x in r.runs], r.collapsed) for r in word_runs.detect(docs).collect()}
    assert plain[4] == (1, [(0, 27, 3)], "one two three") and plain[1] == plain[3] == (0, [], "")
    assert word_runs.detect(docs.limit(0)).count() == 0
