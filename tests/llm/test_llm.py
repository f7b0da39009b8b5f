"""The operators for training data: brute force, round trips, held-out accuracy and odd rows."""

from __future__ import annotations

import hashlib
import itertools
import random
import zlib

import compare
import corpus_pipeline
import numpy as np
import pytest
from duebook.llm import ann, common, components, exact_dedup, html_extract, langid, near_dedup, packing, quality, secrets, sentencepiece_codec, warc
from duebook.llm.queries import ORACLES, QUERIES, tokenizer
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, text string, lang string, source string, score double, text_sha256 string, key string"


def odd(spark, texts):
    """Documents with nulls, repeated rows and columns whose names clash with results."""
    return spark.createDataFrame([(i, t, None, None, 0.0, "x", "y") for i, t in texts], COLUMNS)


def words(seed, n, kinds=400):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(kinds)}" for _ in range(n))


LONG = words(1, 60_000)
ODD = [(1, None), (2, ""), (3, " \n"), (4, "one two"), (4, "one two"), (5, "one  two"), (None, "lost id"), (6, LONG), (7, LONG + " end")]


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_rows_equal(spark, con, name):
    mine = compare.spark_rows(QUERIES[name](spark, SF))
    assert mine[1]
    assert compare.differences(mine, compare.duck_rows(con, ORACLES[name])) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"op11_variants"}))
def test_each_query_answers_for_every_row(spark, name):
    table = {"op6_warc": "pages", "op8_html": "pages", "op9_ann": "embeddings"}.get(name, "documents")
    df = spark.read.parquet(f"{SF}/{table}.parquet")
    out = QUERIES[name](spark, SF)
    key = df.columns[0] if table != "embeddings" else "query_id"
    want = df.count() if table != "embeddings" else df.where("vec_id % 20 = 0").count()
    assert out.select(key).distinct().count() == want


# exact dedup


def test_exact_dedup_keeps_the_longest_then_the_smallest(spark):
    got = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.report(odd(spark, ODD)).collect()}
    assert got == {(1, 3, 3, False), (2, 3, 3, False), (3, 3, 3, True), (4, 5, 3, False), (5, 5, 3, True), (None, None, 1, True), (6, 6, 1, True), (7, 7, 1, True)}
    kept = exact_dedup.dedup(odd(spark, ODD + [(5, "one  two")]))
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["3", "5", "6", "7", "None"] and kept.columns == odd(spark, []).columns
    assert exact_dedup.report(odd(spark, [])).count() == 0


def test_few_counters_do_not_change_the_result(spark):
    docs = odd(spark, [(i, "hot" if i % 3 else f"text {i % 40}") for i in range(600)]).repartition(5)
    rows = [sorted(map(tuple, exact_dedup.report(docs, counters=c).collect())) for c in (1, 2, 1024)]
    assert rows[0] == rows[1] == rows[2]


def test_misra_gries_never_misses_a_frequent_key():
    r = random.Random(3)
    keys = ["hot"] * 500 + [f"k{r.randrange(400)}" for _ in range(500)]
    r.shuffle(keys)
    counts: dict = {}
    for i in range(0, 1000, 100):
        exact_dedup.misra_gries(keys[i : i + 100], counts, 4)
    assert len(counts) <= 4 and 500 - 1000 / 4 <= counts["hot"] <= 500


# near-duplicates


def edited(text, places, mark):
    w = text.split()
    for p in places:
        w[p] = f"{mark}{p}"
    return " ".join(w)


def brute_classes(texts, threshold=0.8):
    p = {i: near_dedup.profile(t or "") for i, t in texts.items()}
    of = {i: i for i in texts}

    def top(x):
        while of[x] != x:
            x = of[x]
        return x

    for a, b in itertools.combinations(sorted(texts), 2):
        if near_dedup.similarity(p[a], p[b]) >= threshold and top(a) != top(b):
            of[max(top(a), top(b))] = min(top(a), top(b))
    return {i: top(i) for i in texts}


def test_near_duplicates_equal_brute_force(spark):
    base, texts = [words(s, 150) for s in range(12)], {}
    r = random.Random(5)
    for i in range(150):
        texts[i] = edited(base[i % 12], r.sample(range(150), r.randrange(6)), f"e{i}_")
    passage = words(99, 60)
    texts |= {200 + i: f"{passage} {words(300 + i, 60)}" for i in range(40)}
    got = {r.doc_id: r.class_id for r in near_dedup.classes(odd(spark, list(texts.items()))).collect()}
    assert got == brute_classes(texts)


def test_registers_estimate_the_exact_similarity():
    a, b = words(1, 400) + " x y z x y z" * 30, edited(words(1, 400), (10, 200), "q")
    doc, h, c = near_dedup.shingles([a, b])
    held = near_dedup.registers(2, doc, h, near_dedup.weights(c), 4096)
    exact = near_dedup.similarity(near_dedup.profile(a), near_dedup.profile(b))
    assert abs((held[0] == held[1]).mean() - exact) < 0.03
    sets = [set(zip(*(t.split()[k:] for k in range(5)))) for t in (words(1, 300), edited(words(1, 300), (7,), "q"))]
    assert near_dedup.similarity(near_dedup.profile(words(1, 300)), near_dedup.profile(edited(words(1, 300), (7,), "q"))) == pytest.approx(len(sets[0] & sets[1]) / len(sets[0] | sets[1]))


def test_near_dedup_odd_rows(spark):
    got = {r.doc_id: (r.class_id, r.copies) for r in near_dedup.classes(odd(spark, ODD)).collect()}
    assert got == {1: (1, 1), 2: (2, 1), 3: (3, 1), 4: (4, 3), 5: (4, 3), 6: (6, 1), 7: (6, 1)}
    kept = near_dedup.dedup(odd(spark, ODD))
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "3", "4", "6", "None"] and kept.columns == odd(spark, []).columns
    assert near_dedup.classes(odd(spark, [])).count() == 0


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    got = {r.node: r.comp for r in components.components(edges).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100}


# packing and the codec


def test_packing_restores_every_document(spark, tmp_path):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer("byte_bpe_50k.json"))
    texts = [(1, None), (2, ""), (3, "one two " * 1900), (4, "naïve <|endoftext|> 漢字 x"), (4, "naïve <|endoftext|> 漢字 x"), (5, "a" * 3000), (6, "hello <|endoftext|> world")]
    rows = packing.pack(odd(spark, texts), tokenizer("byte_bpe_50k.json")).collect()
    assert len({r.sequence_id for r in rows}) == len(rows) and all(r.length & (r.length - 1) == 0 and r.length <= 2048 and r.offset == 0 for r in rows)
    for i, text in texts:
        want = [*t.encode(text or "", add_special_tokens=False).ids, 1]
        own = sorted({(r.start, bytes(r.ids)) for r in rows if r.doc_id == i})
        assert np.frombuffer(b"".join(b for _, b in own), "<u4").tolist() == want
        assert {r.doc_tokens for r in rows if r.doc_id == i} == {len(want)}
    assert [np.frombuffer(r.ids, "<u4").tolist() for r in rows if r.doc_id == 6 and r.start == 0] == [[31373, 220, 50256, 995]]
    # sequences of one length have numbers of their own, one after the other
    by_number = [r.length for r in sorted(rows, key=lambda r: r.sequence_id)]
    assert by_number == sorted(by_number) and {r.sequence_id >> 59 for r in rows if r.length == 2048} == {11}
    path = str(tmp_path / "packed")
    packing.write(packing.pack(odd(spark, texts), tokenizer("byte_bpe_50k.json")), path)
    assert spark.read.parquet(f"{path}/length=2048").count() == by_number.count(2048)
    assert packing.pack(odd(spark, []), tokenizer("byte_bpe_50k.json")).count() == 0


def test_plain_encoding_is_the_tokenizers():
    e = packing.Encoder(tokenizer("byte_bpe_50k.json"))
    r = random.Random(2)
    for _ in range(1500):
        text = "".join(r.choice("abc  \n\t'srevlm12.!²½ªéñ\xa0\x85\x1cß<|>") for _ in range(50))
        assert np.frombuffer(e(text), "<u4").tolist() == e.tokenizer.encode(text, add_special_tokens=False).ids


def test_codec_equals_the_library(spark):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=tokenizer("piece_bpe_32k.model"))
    r = random.Random(4)
    letters = "abcdefghijklmnopqrstuvwxyz   \n\t.,<>/=(){}éüñßçАбвгд中文🤖ab▁\x00́"
    texts = [None, "", " ", "  ", " a", "a ", "a  b", " " * 77 + "x", "a" * 4000, *("".join(r.choice(letters) for _ in range(r.randrange(60))) for _ in range(800))]
    docs = odd(spark, list(enumerate(texts)) + [(1, "")])
    out = sentencepiece_codec.decode(sentencepiece_codec.encode(docs, tokenizer("piece_bpe_32k.model")), tokenizer("piece_bpe_32k.model")).collect()
    assert len(out) == len(texts) + 1
    for row in out:
        want = [*sp.encode(row.text or ""), 2]
        assert list(row.ids) == want and row.decoded == sp.decode(want)
    m = sentencepiece_codec.model(tokenizer("piece_bpe_32k.model"))
    for _ in range(1000):
        ids = [r.randrange(3, 32000) for _ in range(r.randrange(1, 8))]
        assert m.decode(ids) == sp.decode(ids)


# classifiers


def test_language_of_held_out_documents(spark):
    rows = QUERIES["op7_langid"](spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out")
    good, n, kept = rows.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*"), F.sum(F.col("accepted").cast("int"))).first()
    assert good >= 0.97 * n and kept >= 0.99 * n


def test_learning_texts_are_bounded_and_blind_to_copies(spark):
    rows = [(i, f"text number {i % 9000}", "en") for i in range(9000)] + [(i, "one copied text", "en") for i in range(9000)] + [(i, f"autre {i}", "fr") for i in range(30)] + [(1, None, "en"), (2, "x", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("h", F.xxhash64("text")).where("lang is not null and text is not null")
    few = common.thinned(docs, "lang", "h", 50)
    n = {r.lang: r.n for r in few.groupBy("lang").agg(F.count_distinct("h").alias("n")).collect()}
    assert n["fr"] == 30 and 100 <= n["en"] <= 400
    least = lambda d: [r.h for r in d.where("lang = 'en'").select("h").distinct().orderBy(F.shiftrightunsigned("h", 11)).limit(50).collect()]
    assert least(few) == least(docs)
    assert common.thinned(docs.limit(0), "lang", "h", 50).count() == 0


def brute_logp(learn, order=4):
    """Interpolated Kneser-Ney over dictionaries of strings: (language, context, character) to probability."""
    def plain(t):
        return " " + "".join(c if c.isalpha() else " " for c in t.lower())

    counts = {}
    for lang, texts in learn.items():
        top: dict = {}
        for t in texts:
            s = " ".join(plain(t).split(" "))
            s = " " + "".join(c for k, c in enumerate(s[1:]) if c != " " or (k and s[k] != " "))
            for k in range(1, len(s)):
                g = s[max(0, k - order + 1) : k + 1].rjust(order, "\0")
                top[g] = top.get(g, 0) + 1
        each = [top]
        for n in range(order - 1, 0, -1):
            low: dict = {}
            for g in each[0]:
                low[g[-n:]] = low.get(g[-n:], 0) + 1
            each.insert(0, low)
        counts[lang] = each
    alphabet = len({g for each in counts.values() for g in each[0]}) + 1

    def p(lang, context, c, n=order):
        if n == 0:
            return 1 / alphabet
        table = counts[lang][n - 1]
        once, twice = (sum(v == k for v in table.values()) for k in (1, 2))
        d = once / (once + 2 * twice) if once and twice else 0.5
        own = context[len(context) - n + 1 :]
        behind = [v for g, v in table.items() if g[:-1] == own]
        if not behind:
            return p(lang, context, c, n - 1)
        seen = table.get(own + c, 0)
        return (max(seen - d, 0) + d * len(behind) * p(lang, context, c, n - 1)) / sum(behind)

    return p


def test_cross_entropy_equals_the_formula():
    learn = {"a": ["The cat sat on the mat.", "A cat, a hat", "that is  that"], "b": ["der hund lag im bett", "Das Bett ist da", "da da da"]}
    p = brute_logp(learn)
    m = langid.modelled({k: langid.highest(v) for k, v in learn.items()})
    for text in ("the hat", "im bett lag der hund", "xyz the"):
        ce, n = m.entropies([text])
        s = " " + text
        for k, lang in enumerate("ab"):
            want = -sum(np.log(p(lang, s[max(0, i - 3) : i].rjust(3, "\1"), s[i])) for i in range(1, len(s))) / len(text)
            assert n[0] == len(text) and ce[0, k] == pytest.approx(want, rel=1e-4)


def test_counts_made_by_spark_give_the_model_of_texts_in_memory(spark):
    rows = [(i, f"{'the cat' if i % 2 else 'der hund'} {words(i, 6, 30)} " + "long " * (i * 40), "en" if i % 2 else "de") for i in range(60)]
    rows += [*rows[:9], (99, None, "en"), (98, "text", None), (97, "", "en"), (96, "ole", "es")]
    docs = spark.createDataFrame([(*r, 0.5, "x", False) for r in rows], "doc_id long, text string, lang string, score double, lang_pred string, accepted boolean")
    m = langid.learned(docs)
    assert m.languages == ["de", "en", "es"]
    out = langid.identify(docs, m)
    assert out.columns == ["doc_id", "text", "lang", "lang_pred", "score", "cross_entropy", "accepted"] and out.count() == len(rows)
    got = {r.doc_id: r for r in out.collect()}
    assert got[99].lang_pred == got[97].lang_pred == "und" and not got[99].accepted and all(got[i].lang_pred == got[i].lang and got[i].accepted for i in range(60))
    assert langid.identify(docs.limit(0), m).count() == 0
    nothing = langid.learned(docs.limit(0))
    assert {r.lang_pred for r in langid.identify(docs, nothing).collect()} == {"und"}
    # the end of a long text teaches as its beginning does
    late = spark.createDataFrame([(1, "aaa " * 3000 + "zzz zzz", "l"), (2, "bbb ccc", "m")], "doc_id long, text string, lang string")
    assert langid.identify(spark.createDataFrame([("zzz",)], "text string"), langid.learned(late)).first().lang_pred == "l"


def test_language_odd_rows():
    m = langid.fit({"a": ["the cat sat on the mat"] * 6, "b": ["der hund lag auf dem bett"] * 6})
    langs, score, _, accepted = m.predict(["", "12 !", "the cat", "hund", "漢字漢字漢字漢字漢字"])
    assert langs[:4] == ["und", "und", "a", "b"] and score[0] == 0 and not accepted[:2].any() and accepted[2:4].all() and not accepted[4]
    assert langid.fit({}).predict(["x"])[0] == ["und"]
    g = np.unique(langid.grams(langid.characters(["the cat sat"])[0]))
    alphabet = m.tables[1][0]
    follow = (g[5] >> np.uint64(16) << np.uint64(16)) | alphabet
    assert np.exp(m.logp(langid.ORDER, follow)).sum(axis=0).max() <= 1 + 1e-5  # a distribution, with mass for what was never seen


def test_quality_of_held_out_documents(spark):
    rows = QUERIES["op4_quality"](spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id").where("held_out")
    good, n = rows.agg(F.sum((F.col("predicted") == F.col("quality")).cast("int")), F.count("*")).first()
    assert good >= 0.85 * n


def test_quality_odd_rows():
    net = quality.fit([b"good words here"] * 20 + [b"#### $$$$ %%%%"] * 20, [1] * 20 + [0] * 20, rounds=10)
    s = net.score([b"", b"good words here and more", b"#### $$$$", b"a" * 700_000])
    assert s[1] > 0.5 > s[2] and ((0 <= s) & (s <= 1)).all()
    whole, parts = net.pooled([b"xyz " * 5000 + b"####"]), net.pooled([b"xyz " * 5000 + b"####"], part=64)
    assert np.allclose(whole, parts, atol=1e-4)
    assert quality.fit([], []).score([b"x"])[0] == 0.5


def plain_score(net, text):
    """The network's answer by loops over chunks and filters."""
    blocks = max(2, -(-len(text) // quality.STEP))
    codes = [*text] + [256] * (blocks * quality.STEP - len(text))
    answers = []
    for b in range(blocks - 1):
        chunk = codes[b * quality.STEP : (b + 2) * quality.STEP]
        x = np.concatenate([net.bytes[c] for c in chunk]).astype(np.float64)
        both = np.concatenate([net.first, net.second])
        answers.append([max(0.0, float(x @ both[:, f]) + float(net.bias[f])) for f in range(quality.FILTERS)])
    most = [max(a[f] for a in answers) for f in range(quality.FILTERS)]
    mean = [sum(a[f] for a in answers) / len(answers) for f in range(quality.FILTERS)]
    return 1 / (1 + np.exp(-(float(np.dot(most + mean, net.out)) + float(net.shift[0]))))


def test_scores_equal_a_plain_convolution(spark):
    net = quality.fit([b"good words here and there"] * 20 + [b"#### $$$$ %%%% lorem"] * 20, [1] * 20 + [0] * 20, rounds=6)
    texts = [None, "", "a", "12345678", "123456789", "é" * 30, words(3, 500), "good words #### " * 40, "good words #### " * 40]
    docs = spark.createDataFrame([(i, t, 9.0, "held") for i, t in enumerate(texts)], "doc_id long, text string, score double, raw string")
    got = {r.doc_id: r.score for r in quality.score(docs, net).collect()}
    assert got == pytest.approx({i: plain_score(net, (t or "").encode()) for i, t in enumerate(texts)}, abs=1e-5)
    assert quality.score(docs.limit(0), net).count() == 0


def test_long_texts_teach_from_all_over(spark):
    raw = bytes(range(256)) * 4000
    part = quality.spread(raw, 16_384)
    assert len(part) == 16_384 and quality.spread(raw[:100], 16_384) == raw[:100]
    places = [raw.find(part[k : k + 256][:64]) for k in range(0, len(part), 256)]
    assert len(places) == 64
    late = [("x" * 60_000 + ("good words " if i % 2 else "$$$$ %%%% ") * 8000, i % 2) for i in range(40)]
    docs = spark.createDataFrame([(i, t, "q") for i, (t, _) in enumerate(late)] + [(0, late[0][0], "q"), (77, None, "q")], "doc_id long, text string, quality string")
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(late)] + [(0, 0), (5, None), (77, 1)], "doc_id long, quality int")
    net = quality.learned(docs, labels, rounds=6)
    assert net.score([b"good words " * 40])[0] > net.score([b"$$$$ %%%% " * 40])[0] + 0.3


# secrets


def test_secrets_are_masked_where_live(spark):
    own, shared = "A1b2C3d4E5f6", "EXAMPLEKEY00"
    docs = spark.createDataFrame(
        [(1, f"é🤖 token = '{own}' and", "s1"), (2, f"password:{shared}", "s1"), (3, f"password:{shared}", "s2"), (4, f"API_KEY={shared}", "s3"), (5, "token=short", "s1"), (6, None, None), (7, "0" * 40 + " secret=" + "f" * 40, "s9")],
        "doc_id long, text string, source string",
    )
    got = {r.doc_id: r for r in secrets.scan(docs).collect()}
    assert got[1].spans == f"assign:3:{3 + len('token = ') + 1 + len(own)}" and got[1].n_live == 1
    assert [got[i].n_copied for i in (2, 3, 4)] == [1, 1, 1] and got[5].spans == got[6].spans == ""
    assert got[7].n_hex == 2 and got[7].base_spans == "hex:0:40,assign:41:88,hex:48:88"
    texts = {r.doc_id: r.text for r in secrets.redact(docs).collect()}
    assert texts[1] == "é🤖 [SECRET]' and" and texts[2] == f"password:{shared}" and texts[6] is None and texts[7] == "[SECRET] [SECRET]"
    assert secrets.scan(docs.limit(0)).count() == 0


def test_secrets_match_the_pattern_engine(spark):
    import re

    r = random.Random(8)
    bits = ["token", "TOKEN", "api_key", "passwd", "=", ":", " ", '"', "'", "abcdefgh", "AKIA", "0123456789abcdef" * 2, "Z9", "é", "🤖", "\n", "=="]
    texts = ["".join(r.choice(bits) for _ in range(30)) for _ in range(300)]
    docs = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], "doc_id long, text string, source string")
    for row in secrets.scan(docs).collect():
        want = []
        for k, kind in enumerate(secrets.ORDER):
            pattern, group, least = secrets.KINDS[kind]
            want += [(m.start(), k, f"{kind}:{m.start()}:{m.end()}") for m in re.finditer(pattern, texts[row.doc_id], re.A) if len(m[group]) >= least]
        assert row.spans == ",".join(s for _, _, s in sorted(want))


def test_values_of_many_repositories_are_examples(spark):
    """One value in a third of the rows, all of one owner, with its counts sent by join and by broadcast."""
    rows = [(i, f"token = '{'EXAMPLE0' if i % 3 else f'Own{i:05d}x'}'", "s0") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    want = {i: ((0, 1, 1, 200) if i % 3 else (1, 0, 1, 1)) for i, _, _ in rows}
    for hot in (10_000, 50):
        with pytest.MonkeyPatch.context() as m:
            m.setattr(secrets, "HOT", hot)
            assert {r.doc_id: (r.n_live, r.n_copied, r.owners, r.repos) for r in secrets.scan(docs).collect()} == want
    masked = {r.doc_id: r.text for r in secrets.redact(docs).collect()}
    assert masked[1] == rows[1][1] and masked[3] == "[SECRET]'"
    clash = docs.select("doc_id", "text", "source", *[F.lit(0).alias(c) for c in ("row", "key", "kinds", "owners", "repos")])
    assert secrets.scan(clash).count() == 300 and secrets.redact(clash).columns == clash.columns and secrets.redact(clash.limit(0)).count() == 0


def test_private_keys_match_the_pattern_engine(spark):
    import re

    r = random.Random(18)
    head, foot = ("-----%s RSA PRIVATE KEY-----" % side for side in ("BEGIN", "END"))
    bits = [head, foot, "\n", "\r\n", "\\n", " ", '"', "Proc-Type: 4,ENCRYPTED", "MIIEowIBAAKCAQEA" * 4, "MIIEowIBAAKCAQEA", "QUJD+/==", "words of prose", "-", "é🤖"]
    texts = ["".join(r.choice(bits) for _ in range(25)) for _ in range(400)]
    pattern = secrets.KINDS["vendor"][0].replace(secrets.HEADER, secrets.KEY).replace("\\z", "\\Z")
    docs = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], "doc_id long, text string, source string")
    for row in secrets.scan(docs).collect():
        want = [f"vendor:{m.start()}:{m.end()}" for m in re.finditer(pattern, texts[row.doc_id], re.A)]
        assert [s for s in row.spans.split(",") if s.startswith("vendor")] == want, texts[row.doc_id]


def test_private_keys_are_told_apart_by_their_bodies(spark):
    import base64

    def block(seed, width=64, br="\n", end=True, fields=""):
        body = base64.b64encode(random.Random(seed).randbytes(600)).decode()
        lines = [body[i : i + width] for i in range(0, len(body), width)]
        return br.join(["-----BEGIN RSA PRIVATE KEY-----", *([fields + br] if fields else []), *lines, *(["-----END RSA PRIVATE KEY-----"] if end else [])])

    alone = "-----BEGIN RSA PRIVATE KEY-----"
    own = [
        block(1), block(2, br="\r\n"), block(3, br="\\n"), block(4, br='" +\n  "'), block(5, end=False), block(6, br="\n# "), block(7, fields="Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,0A1B"),
        block(8, br=" "), block(9, width=10_000, br=""), block(10, width=20, end=False), block(11, br="\n\n"), alone.replace("RSA", "EC") + "\n" + "QUJD" * 250_000 + "\n-----END EC PRIVATE KEY-----",
    ]
    copied = [block(99), block(99, width=76, br="\n  "), block(99, br="\\n")]
    texts = [(f"own{i}", f"é🤖 before it\n{k}", k) for i, k in enumerate(own)] + [(f"copied{i}", f"see {k}", k) for i, k in enumerate(copied)]
    texts += [("code", f'if text.startswith("{alone}") and text.endswith("-----END RSA PRIVATE KEY-----"): pass', alone)]
    texts += [("prose", f"{alone}\nThe words of prose stay.\nThanks\n", alone), ("two", f"{block(21, end=False)}\n{alone}", None)]
    docs = spark.createDataFrame([(n, t + ("" if n in ("code", "prose") else "\nand words behind it")) + (f"s{i}",) for i, (n, t, _) in enumerate(texts)], "doc_id string, text string, source string")
    got = {r.doc_id: r for r in secrets.scan(docs).collect()}
    clear = {r.doc_id: r.text for r in secrets.redact(docs).collect()}
    for name, text, key in texts:
        if key:
            at = text.index(key)
            assert f"vendor:{at}:{at + len(key)}" in got[name].spans.split(","), name
        if name.startswith("own"):
            assert got[name].n_copied == 0 and clear[name] == "é🤖 before it\n[SECRET]\nand words behind it", name
        if name.startswith("copied"):
            assert got[name].n_copied >= 1 and clear[name] == text + "\nand words behind it", name
    # the header alone is one value that three sources carry here; the key before it is masked
    assert got["code"].n_copied == got["prose"].n_copied == 1
    assert got["two"].n_live == got["two"].n_copied == 1 and clear["two"] == f"[SECRET]\n{alone}\nand words behind it"


# archives


def test_archives_and_their_history(spark):
    big = "<p>" + "x" * 1200
    rows = [(1, "http://A.example/x?b#f", big), (2, "http://b.example/", big), (3, None, None), (4, "http://a.example/x?b", "<p>é"), (4, "http://a.example/x?b", "<p>é"), (9, "http://www.b.example", big), (None, "http://c.example/a b", big)]
    out = warc.archive(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert len(out) == len(rows)
    kinds = sorted((str(r.page_id), r.record_type, r.refers_to) for r in out)
    assert kinds == sorted([("1", "revisit", 9), ("2", "revisit", 9), ("3", "response", None), ("4", "response", None), ("4", "response", None), ("9", "response", None), ("None", "response", None)])
    for r in out:
        want = next(h or "" for i, _, h in rows if i == r.page_id).encode()
        assert (r.payload_bytes, r.payload_digest) == (len(want), hashlib.sha1(want).hexdigest())
    keys = [(r.urlkey, r.captured) for r in out]
    assert keys == sorted(keys)
    assert warc.archive(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_loser_tree_merges_any_number_of_runs():
    r = random.Random(1)
    for k in (1, 2, 3, 7, 8):
        runs = [sorted(((f"u{r.randrange(5)}", "t", r.choice([None, 1, 2]), "", "", 0, 0, "", f"a{i}", j) for j in range(r.randrange(20))), key=warc.order) for i in range(k)]
        got = list(warc.LoserTree([iter(x) for x in runs]))
        assert [warc.order(x) for x in got] == sorted(warc.order(x) for x in itertools.chain(*runs))


# pages


def test_main_text_of_a_page():
    page = (
        "<html><head><title>no</title></head><body class='has-sidebar'><nav>no</nav><div id='cookieNotice'>no</div><article><h1>A &amp; B</h1><p>one<b>two</b>&nbsp;three<p>four<br>five"
        "<ul><li>x<li>y</ul><script>var a='</p>';</script><form>no</form><section class='comments'>no</section></article><footer>no"
    )
    assert html_extract.main_text(page, "h") == "A & B onetwo three four five x y"
    assert html_extract.main_text(None, "h") == html_extract.main_text("", "h") == ""
    assert html_extract.main_text("<div>" * 50_000 + "deep", "h") == "deep"
    assert html_extract.main_text("a < b <p>c", "h") == "a < b c"
    assert html_extract.main_text("<div class='page with-sidebar'><p>kept<div class='sidebar'>no</div><div class='no-ads adBox'>no</div></div>", "h") == "kept"


def test_what_stands_beside_an_article_in_main_stays():
    page = "<header><h1>Site</h1><p>slogan</header><main><h1>Title</h1><p>Standfirst</p><article><header><h2>Own</h2><p>Lead</p><ul><li>no</ul><time>no</time></header><p>Body of it</p></article><p>After</p></main><div>no</div>"
    assert html_extract.main_text(page, "h") == "Title Standfirst Own Lead Body of it After"
    assert html_extract.main_text("<div role=main><h1>T</h1><article>" + "long text " * 9 + "</article></div><p>out", "h") == "T " + ("long text " * 9).strip()
    for name in ("user-comments", "fb-comments", "comment-thread-v2", "newsletter-optin", "readerComments", "disqus_thread", "gdpr-bar-3"):
        for kind in ("class", "id"):
            assert html_extract.main_text(f"<article><p>The text of the article is the longer part</p><div {kind}='{name}'><p>no no</p></div></article>", "h") == "The text of the article is the longer part", name
    for name in ("comments-enabled post", "has-comments", "no-sidebar", "comment-policy"):
        assert html_extract.main_text(f"<article><div class='{name}'><p>The text of the article</p></div><p>end</p></article>", "h") == "The text of the article end", name


def test_hosts_that_begin_alike_have_templates_of_their_own():
    far = ["x" * 80 + end for end in "ab"]
    keys = [set(html_extract.marked(html_extract.parse("<div><p>Same</p></div>"), h)[0]) for h in far]
    assert not keys[0] & keys[1]


def brute_extract(rows):
    """Templates counted in plain dictionaries, then the text of each page without its host's."""
    counts, totals, where = {}, {}, {}
    contents = set()
    for _, url, page in rows:
        host = ("" if "://" not in (url or "") else url.split("://")[1]).split("/")[0].split("?")[0].split("#")[0].split("@")[-1].split(":")[0].lower()
        outside, inside, whole = html_extract.marked(html_extract.parse(page or ""), host)
        where[url, page] = host
        if (host, whole) in contents:
            continue
        contents.add((host, whole))
        totals[host] = totals.get(host, 0) + 1
        for key in {*outside, *inside}:
            n, i = counts.get((host, key), (0, False))
            counts[host, key] = (n + 1, i or key in inside)
    gone: dict = {}
    for (host, key), (n, inside) in counts.items():
        least, share = html_extract.INSIDE if inside else html_extract.OUTSIDE
        if (n >= least and n >= share * totals[host]) or (not inside and n >= html_extract.ENOUGH):
            gone.setdefault(host, set()).add(key)
    return sorted(((i, html_extract.main_text(page, where[url, page], gone.get(where[url, page], set()))) for i, url, page in rows), key=str)


def test_extraction_equals_brute_force(spark):
    r = random.Random(6)
    rows = [(d.page_id, d.url, d.html) for d in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    blocks = [f"<div class=x{k}><p>Block {k} of the site</p></div>" for k in range(12)]
    for i in range(150):
        own = f"<p>Own text {i} " + "and more of it " * r.randrange(1, 9) + "</p>" + "".join(f"<p>{r.randrange(8)} shared</p>" for _ in range(2))
        wrap = r.choice(["<article>%s</article>", "<main>%s</main>", "<div class=post>%s</div>", "%s"])
        rows.append((10_000 + i, f"https://u@Host{r.randrange(4)}.example:80/{i}?q#f", "".join(r.sample(blocks, 3)) + wrap % own + r.choice(blocks)))
    rows += [rows[-1], (None, None, None), (5, "no address", "<p>alone")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert sorted(((x.page_id, x.text) for x in html_extract.extract(pages).collect()), key=str) == brute_extract(rows)


def test_names_inside_an_article_must_name_a_part_as_a_whole():
    page = (
        "<div class='social-x'>no</div><article><h2 id='social-policy'>A</h2><h2 id=comments>B</h2><section id='search-algorithms'>c</section><div id='related-work'>d</div><span class='share-price'>e</span>"
        "<div class='social-share'>no</div><div class='searchBox'>no</div><div id='related-posts'>no</div><div class='post-comments'>no</div><section id='notices'>%s</section></article>"
    )
    long = "most of the article stands in here, whatever the id says about it " * 2
    assert html_extract.main_text(page % long, "h").replace(" ", "") == "ABcde" + long.replace(" ", "")
    assert html_extract.main_text(page % "f", "h").replace(" ", "") == "ABcde"
    assert html_extract.main_text("<div class='social-policy-page'><article>all of it</article></div><div class='social-x'>no</div>", "h") == "all of it"


def test_template_subtrees_go_and_shared_passages_stay(spark):
    shared = "<p>A passage that two documents share.</p>"
    rows = [(i, "http://h.example/%d" % i, f"<div class=x><p>Site words everywhere</p></div><article><p>own {i}</p>{shared if i < 4 else ''}</article>") for i in range(20)]
    rows += [(50 + i, "http://k.example/", "<div><p>Same page</p></div>") for i in range(9)] + [(90, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    want = {i: f"own {i}" + (" A passage that two documents share." if i < 4 else "") for i in range(20)} | {50 + i: "Same page" for i in range(9)} | {90: ""}
    for most in (100, 0):  # the broadcast of templates and the join give the same
        assert {r.page_id: r.text for r in html_extract.extract(pages, broadcast_most=most).collect()} == want
    assert html_extract.extract(pages.limit(0)).count() == 0


def test_template_on_a_large_host_and_articles_without_the_tag(spark):
    shared = "<p>A passage that three documents share, long enough to be one.</p>"
    heads = {"main": "<main>", "role": "<div role=main>", "post": "<div class=post>", "anonymous": "<div><div>"}
    rows = [(f"hot{i}", f"http://hot.example/{i}", f"<div class=x>{'A block of the section.' if i < 12 else ''}</div><div class=post><p>The own text of page {i} is longer</p></div>") for i in range(200)]
    want = {f"hot{i}": f"The own text of page {i} is longer" for i in range(200)}
    for kind, head in heads.items():
        for i in range(20):
            own = f"Own {kind} text of page {i}, " + "which goes on for long " * (5 + i % 2)
            rows.append((f"{kind}{i}", f"http://{kind}.example/{i}", f"<div class=x>The same on all pages</div>{head}<p>{own}</p>{shared if i < 3 else ''}"))
            want[f"{kind}{i}"] = own.strip() + (" A passage that three documents share, long enough to be one." if i < 3 else "")
    # one post under three addresses, beside other dates
    rows += [(f"copy{i}", f"http://copies.example/{i}", f"<div>date {i}</div><div class=post><p>The whole post</p></div>") for i in range(3)]
    want |= {f"copy{i}": f"date {i} The whole post" for i in range(3)}
    pages = spark.createDataFrame(rows, "page_id string, url string, html string")
    got = {r.page_id: r.text for r in html_extract.extract(pages).collect()}
    assert {k: v for k, v in got.items() if want[k] != v} == {}


# neighbours


def test_recall_against_brute_force(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = df.collect()
    ids, v = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], np.float64)
    found: dict = {}
    for r in ann.nearest(df, F.col("vec_id") % 20 == 0).collect():
        found.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    hit = 0
    for q, got in found.items():
        s = (v * v[ids == q][0]).sum(axis=1)
        s[ids == q] = -np.inf
        best = ids[np.lexsort((ids, -s))[:20]]
        assert sorted(got) == list(range(1, 21)) and all(abs(score - s[ids == i][0]) < 1e-12 for i, score in got.values())
        hit += len(set(best) & {i for i, _ in got.values()})
    assert hit / (20 * len(found)) >= 0.9


def test_neighbour_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(ann, "CELL", 16)
    inf, nan = float("inf"), float("nan")
    rows = [(0, [1.0, 0.0]), (1, [0.0, 0.0]), (2, None), (3, [nan, 1.0]), (4, [inf, 0.0]), (5, [1.0, None]), (6, [1.0]), (7, [1.0, 0.0]), (8, [2.0, 1.0]), (8, [2.0, 1.0]), (None, [1.0, 1.0])]
    got = [tuple(r)[1:] for r in ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") == 0).orderBy("rank").collect()]
    assert got == [(1, 8, 2.0), (2, 7, 1.0)]
    same = spark.createDataFrame([(i, [1.0, 0.0]) for i in range(200)], "vec_id long, embedding array<double>")
    got = [r.vec_id for r in ann.nearest(same, F.col("vec_id") == 40).orderBy("rank").collect()]
    assert got == list(range(20))
    assert ann.nearest(same.limit(0), F.col("vec_id") == 0).count() == 0


# the pipeline


def test_pipeline_stages_take_effect(spark, tmp_path):
    a, b = words(1, 200), words(2, 200)
    rows = [(i, f"the {words(50 + i, 80)} and house number {i}", "en", "s0") for i in range(10, 40)]
    rows += [(100, a, "en", "s1"), (101, a.replace(" ", "\n"), "en", "s2"), (102, edited(a, (5,), "q"), "en", "s3"), (103, b + " token = 'Zz9Yy8Xx7Ww6'", "en", "s4"), (104, "123 456", "en", "s5"), (105, None, "en", "s5")]
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(path)
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    docs = {r.doc_id for r in out}
    assert docs >= set(range(10, 40)) | {103} and len(docs & {100, 101, 102}) == 1 and not docs & {104, 105}
    e = packing.Encoder(tokenizer("byte_bpe_50k.json"))
    ids = b"".join(bytes(r.ids) for r in sorted((r for r in out if r.doc_id == 103), key=lambda r: r.start))
    assert ids == e(b + " [SECRET]'") + np.array([1], "<u4").tobytes()
    assert all(zlib.crc32(bytes(r.ids)) == r.ids_crc32 for r in out)


def test_pipeline_on_nothing_and_on_repeated_rows(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/empty/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/empty").count() == 0
    rows = [(i, f"the {words(80 + i, 60)} and number {i}", "en", "s0", 0) for i in range(30)]
    rows += [rows[0], rows[1], (None, f"the {words(200, 60)} and number none", "en", "s1", 0), (40, "", "en", "s1", 0), (41, "the w1 w2 w3 and number", None, None, None)]
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/rows/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/rows/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = common.settle(stage(spark, docs, str(tmp_path)), "t")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
    kept = sorted(str(r.doc_id) for r in docs.collect())
    assert kept == sorted([str(i) for i in range(30)] + ["None", "41"])


# odd columns


def test_codec_on_clashing_columns_and_nothing(spark):
    path = tokenizer("piece_bpe_32k.model")
    docs = spark.createDataFrame([(1, "a b", "x", 2.0), (2, None, None, None)], "doc_id long, text string, ids string, decoded double")
    out = sentencepiece_codec.decode(sentencepiece_codec.encode(docs, path), path)
    assert sorted(out.columns) == ["decoded", "doc_id", "ids", "text"] and {r.doc_id: r.decoded for r in out.collect()} == {1: "a b", 2: ""}
    assert sentencepiece_codec.decode(sentencepiece_codec.encode(docs.limit(0), path), path).count() == 0
    holes = spark.createDataFrame([(1, [5, None, 300]), (2, None), (3, [])], "i long, ids array<int>")
    assert {r.i: bool(r.decoded) for r in sentencepiece_codec.decode(holes, path).collect()} == {1: True, 2: False, 3: False}


def test_archives_and_neighbours_on_clashing_columns(spark):
    pages = spark.createDataFrame([(1, "http://a.example/", "<p>x", "c", 5, "r")], "page_id long, url string, html string, urlkey string, payload_bytes int, record_type string")
    assert [(r.payload_bytes, r.record_type) for r in warc.archive(pages).collect()] == [(4, "response")]
    vecs = spark.createDataFrame([(i, [float(i), 1.0], 7, 0.5, 3) for i in range(30)], "vec_id long, embedding array<double>, query_id int, score double, rank int")
    got = ann.nearest(vecs, F.col("vec_id") == 0).collect()
    assert {r.query_id for r in got} == {0} and sorted(r.rank for r in got) == list(range(1, 21))
