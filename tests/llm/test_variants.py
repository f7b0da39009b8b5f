"""Spelling variants against brute force."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest
from duebook.llm import variants
from duebook.llm.queries import QUERIES

DOCS = "doc_id long, text string, word string, n long, key long"
LETTERS = "abcdeéÀßz×"


def brute_words(rows):
    counts = Counter()
    for i, text in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for w in re.findall("[a-zÀ-ÿ]+", low):
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 199 == 0:
                k = h % len(w)
                w = w[:k] + w[k + 1 :]
            if len(w) >= 6:
                counts[w] += 1
    return {w: n for w, n in counts.items() if n >= 5}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute(vocab):
    near = {w: [v for v in vocab if v != w and abs(len(v) - len(w)) < 2 and one_edit(w, v)] for w in vocab}
    form = {w: min(vs, key=lambda v: (-vocab[v], v)) if vs else None for w, vs in near.items()}
    form = {w: f if f and vocab[f] >= 5 * vocab[w] else None for w, f in form.items()}
    out = set()
    for w in vocab:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, vocab[w], len(near[w]), vocab[form[w]] if form[w] else None))
    return out


def test_words_near_each_other_equal_brute_force(spark):
    r = random.Random(11)
    words = ["".join(r.choice(LETTERS) for _ in range(r.randrange(6, 9))) for _ in range(60)]
    for _ in range(240):
        w = list(r.choice(words))
        k = r.randrange(len(w))
        w[k : k + r.randrange(2)] = r.choice([[], [r.choice(LETTERS)], [r.choice(LETTERS)]])
        words.append("".join(w))
    rows = [(i, " ".join(r.choice(words).upper() if r.random() < 0.1 else words[min(int(r.expovariate(0.02)), len(words) - 1)] for _ in range(120))) for i in range(60)]
    rows += [(70 + k, " ".join([w] * n)) for k, (w, n) in enumerate([("chained", 2000), ("chainez", 300), ("chaxnez", 40), ("chaxnezz", 6)])]
    rows += [(None, "lost words here " * 9), (80, None), (81, ""), (82, "aaaaaa " * 6), (82, "aaaaaa " * 6), (83, "a" * 5000 + " " + "12 中 " * 3), (84, ("q" * 400 + " ") * 6)]
    vocab = brute_words(rows)
    docs = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], DOCS)
    for symbols in (1, 6):
        got = [tuple(x) for x in variants.group(variants.vocabulary(docs), symbols).collect()]
        assert len(got) == len(set(got)) == len(vocab) and set(got) == brute(vocab)
    assert any(x[2] != x[0] and x[2] != x[1] for x in got)  # a chain of two forms


def test_the_query_equals_brute_force(spark):
    import pyarrow.parquet as pq

    t = pq.read_table("/root/testdata/sf0.001/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    assert {tuple(x) for x in QUERIES["op11_variants"](spark, "/root/testdata/sf0.001").collect()} == brute(brute_words([(d["doc_id"], d["text"]) for d in t]))


def test_empty_tables_and_one_word(spark):
    empty = spark.createDataFrame([], DOCS)
    assert variants.group(variants.vocabulary(empty)).count() == 0
    alone = spark.createDataFrame([(1, "lonely " * 5, "", 0, 0)], DOCS)
    assert [tuple(x) for x in variants.group(variants.vocabulary(alone)).collect()] == [("lonely", None, "lonely", 5, 0, None)]


@pytest.mark.parametrize("symbols", [2, 6, 16])
def test_letters_share_symbols_evenly(symbols):
    kinds = Counter(variants.symbol(c, symbols) for c in variants.LETTERS)
    assert len(kinds) == symbols and max(kinds.values()) <= 2 * len(variants.LETTERS) / symbols
