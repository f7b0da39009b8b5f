"""Operators against plain Python on small frames, with planted faults and hot keys."""

import collections
import random

import pytest
from pyspark.sql import functions as F

from duebook.operators import corpus, gates, history, lines, matching, merge, scans, segments


def hot_sequence(spark, n=400):
    rng = random.Random(5)
    rows = [("hot" if i % 3 else f"k{i % 7}", i, rng.choice([None, "a", "b", "c"]), rng.randint(-3, 9)) for i in range(n)]
    return rows, spark.createDataFrame(rows, "k string, pos long, v string, n int")


def test_blocked_scans_equal_a_plain_loop(spark):
    rows, df = hot_sequence(spark)
    total, last = collections.Counter(), {}
    want = {}
    for k, pos, v, n in rows:
        total[k] += n
        last[k] = v if v is not None else last.get(k)
        want[pos] = (total[k], last[k])
    out = scans.running_sum(df, ["k"], "pos", F.col("n"), "s", block=16)
    out = scans.carry_down(out, ["k"], "pos", F.col("v"), "c", block=16)
    assert {r["pos"]: (r["s"], r["c"]) for r in out.collect()} == want


def test_global_position(spark):
    rows = [(i * 37 % 101, i % 3) for i in range(101)]
    df = spark.createDataFrame(rows, "id long, d long")
    out = scans.global_position(df, "d", "id", "place", block=8).collect()
    want = {x: p for p, x in enumerate(sorted((d, i) for i, d in rows), 1)}
    assert {(r["d"], r["id"]): r["place"] for r in out} == want


@pytest.mark.parametrize("measure", ["min", "left", "max"])
@pytest.mark.parametrize("ratio", [0.5, 0.8, 1.0])
def test_word_pairs_miss_nothing(spark, measure, ratio):
    rng = random.Random(7)
    vocab = ["common"] * 12 + ["also"] * 6 + [f"w{i}" for i in range(25)]

    def side():
        return [(i, sorted(set(rng.choices(vocab, k=rng.randint(1, 6))))) for i in range(60)]

    left, right = side(), side()
    got = matching.word_pairs(
        spark.createDataFrame(left, "lid long, a array<string>"), spark.createDataFrame(right, "rid long, b array<string>"), "a", "b", ratio, measure
    ).collect()
    got = {(r["lid"], r["rid"]) for r in got}
    size = {"min": min, "max": max, "left": lambda x, y: x}[measure]
    want = {(i, j) for i, a in left for j, b in right if len(set(a) & set(b)) / size(len(a), len(b)) >= ratio and set(a) & set(b)}
    assert want <= got


def test_blank_bodies_agree_with_all(spark):
    left = spark.createDataFrame([(1, ["x"], []), (2, ["x"], ["p"]), (3, ["x"], ["q"])], "lid long, a array<string>, lb array<string>")
    right = spark.createDataFrame([(1, ["x"], []), (2, ["x"], ["p"]), (3, ["x"], ["r"])], "rid long, b array<string>, rb array<string>")
    pairs = {(r["lid"], r["rid"]) for r in matching.word_pairs(left, right, "a", "b", 1.0, "min", bodies=("lb", "rb")).collect()}
    assert pairs == {(1, 1), (1, 2), (1, 3), (2, 1), (2, 2), (3, 1)}


def test_phrases_of_any_length_meet_and_blank_ones_do_not(spark):
    texts = [(i, t) for i, t in enumerate(["Inquiry of NATION_12 affairs", "nation_1", "a NT matter", "none", "xNATION_2x"])]
    phrases = [(i, p) for i, p in enumerate(["NATION_1", "NATION_2", "NT", "nation_12", "Q", "", " "])]
    df, p = spark.createDataFrame(texts, "id long, t string"), spark.createDataFrame(phrases, "place long, phrase string")
    want = {(i, j) for i, t in texts for j, x in phrases if x.strip() and x.lower() in t.lower()}
    assert {(r["id"], r["place"]) for r in matching.phrase_matches(df, p, "t").collect()} == want


def test_a_numbered_report_needs_its_number(spark):
    rows = spark.createDataFrame([(1, "Report 505: Financial statements audit", "Public Accounts", None, None)], "id long, title string, body string, tabled date, ref long")
    answers = spark.createDataFrame([(7, "Government response to Public Accounts Report 506: Financial statements audit", None), (8, "Government response to Public Accounts Report 505: Financial statements audit", None)], "rid long, title string, tabled date")
    none = spark.createDataFrame([], "ref long, rid long")
    hand = spark.createDataFrame([], "title string, tabled date, rid long")
    got = matching.removal_match(rows, answers, none, hand).collect()
    assert [(r["id"], r["rid"], r["basis"]) for r in got] == [(1, 8, "title match")]


def test_refusals_and_dissents(spark):
    text = (
        "Committee's Recommendations\nRecommendation 1\nThe committee recommends that the consultation period be doubled to sixty days.\n"
        "The Government supports this recommendation.\nThis follows recommendation 7 of the earlier report.\n"
        "Recommendation 2\nToo short.\nRecommendation 3\nThe committee recommends that the fund be kept for ten further years. Agreed.\n"
        "Recommendation 4\nThe committee recommends that the agency publish all of its guidance online. the Government has begun\n"
    )
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    found = segments.candidates(docs, "doc_id", "text")
    best = {r["label"]: r for r in segments.best_per_label(found).collect()}
    assert best["1"]["said"].startswith("The Government supports this recommendation") and "7" not in best
    why = {r["label"]: r["why"] for r in segments.refusals(found).collect()}
    assert why["2"] == "fewer characters than an item needs"
    assert why["4"] == "the answer starts in the middle of a sentence"
    assert best["3"]["said"] == "Agreed" and set(best) | set(why) == {"1", "2", "3", "4"}


def test_gate_catches_planted_faults(spark):
    df = spark.createDataFrame([(1, 5, 9), (2, 9, 5), (3, None, 4)], "id long, tabled int, answered int")
    found = gates.violations(df, {"early": F.col("answered") < F.col("tabled"), "missing": F.col("tabled").isNull()}, F.col("id"))
    assert {(r["rule"], r["key"]) for r in found.collect()} == {("early", "2"), ("missing", "3")}
    with pytest.raises(ValueError, match="early: 1"):
        gates.must_be_empty(found)
    gates.must_be_empty(found.where("false"))
    assert gates.append_once(df, F.col("id") == 1).collect()[0]["key"] == "1"


def test_claims_at_printed_precision(spark):
    b = spark.createDataFrame([(1, "It is 5.1 per cent of\n1,234 rows.", 5.0847, 1234), (2, "It is 5.2 per cent of 1,235 rows.", 5.0847, 1234)], "id long, text string, s double, n long")
    got = gates.claims(b, [("is {} per cent of {} rows", [F.col("s"), F.col("n")]), ("{} absent", [F.col("n")])]).collect()
    assert {(r["id"], r["claim"], r["figure"]): r["outcome"] for r in got} == {
        (1, 0, 1): "agrees", (1, 0, 2): "agrees", (1, 1, 1): "not said", (2, 0, 1): "moved", (2, 0, 2): "moved", (2, 1, 1): "not said"}


def test_a_missing_edition_breaks_the_streak(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (1, 3), (2, 1), (2, 3), (3, 1), (3, 2)], "id long, e int")
    got = history.streaks(df, ["id"], "e", F.lit(True), 3).collect()
    assert {r["id"]: r["editions_in_a_row"] for r in got} == {1: 3, 2: 1}


def test_loose_dedupe_prefers_the_live_reader(spark):
    rows = [(1, "fixture", "Access to", "House Committee", "d"), (2, "live", "", "Access to House Committee", "d"), (3, "live", "x", "y", None), (4, "live", "x", "y", None)]
    df = spark.createDataFrame(rows, "pos long, source string, inquiry string, body string, day string")
    from duebook.functions import tokens

    df = df.withColumn("words", tokens.word_set(F.concat_ws(" ", "body", "inquiry")))
    kept = merge.loose_dedupe(df, ["inquiry", "body", "day"], ["day", "words"], F.col("day").isNotNull(), F.col("source") == "live", ["pos"])
    assert sorted(r["pos"] for r in kept.collect()) == [2, 3]


def test_typeset_lines(spark):
    rows = [
        (1, 0, "Big", 20.0, 10.0, "List of Recommendations"), (1, 1, "B", 11.0, 20.0, "Recommendation 1"), (1, 2, "P", 10.0, 20.0, "Fund it"),
        (1, 3, "B", 11.0, 20.0, "A section should be repealed"), (1, 4, "P", 10.0, 20.0, "It should go"), (1, 5, "Big", 20.0, 10.0, "Chapter"),
        (1, 6, "P", 10.0, 20.0, "More text"), (1, 7, "P", 8.0, 90.0, "12 Home Affairs, notice"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, line_no int, font string, size double, down double, text string")
    assert [r["text"] for r in lines.unnumbered_items(df).collect()] == ["A section should be repealed"]
    assert [r["line"] for r in lines.foot_notes(df).collect()] == ["12 Home Affairs, notice"]
    bold = spark.createDataFrame([(1, 0, True, "a"), (1, 1, True, "b"), (1, 2, False, "x"), (1, 3, True, "c")], "doc_id long, line_no int, bold boolean, text string")
    assert sorted(r["heading"] for r in lines.bold_runs(bold).collect()) == ["a", "a b", "b", "c"]


def test_exact_sample(spark):
    df = spark.range(1000).select(F.col("id"), F.when(F.col("id") < 700, "hot").otherwise("cold").alias("s"))
    a = corpus.exact_sample(df, ["s"], F.col("id"), 1, 9).collect()
    b = corpus.exact_sample(df, ["s"], F.col("id"), 1, 9).collect()
    assert len(a) == 18 and sorted(a) == sorted(b)


def test_provenance_finds_the_label_above(spark):
    asked = "The committee recommends that the program be funded for ten further years from now on in every state of the land"
    docs = spark.createDataFrame([(1, f"Recommendation 1\n{asked}.\nRecommendation 2\nOther words stand here.\n")], "doc_id long, text string")
    rows = spark.createDataFrame([(1, "1", asked), (1, "2", asked), (1, "1", asked.replace("ten", "two")), (2, "1", asked)], "doc_id long, label string, asked string")
    got = [r["outcome"] for r in corpus.provenance(rows, docs, r"(?i)Recommendation\s*(\d{1,3})").collect()]
    assert sorted(got) == ["label does not match", "source text missing", "text not in source", "verified"]


def test_refresh_runs_its_steps_in_order(spark):
    import datetime as dt

    from duebook.operators import register

    d = dt.date
    cols = "id long, title string, body string, tabled date"
    schedule = spark.createDataFrame([(1, "Coastal fishing licences", "Work Committee", d(2020, 1, 5)), (2, "Freight rail corridors", "Work Committee", d(2020, 2, 5))], cols)
    tracker = spark.createDataFrame([(3, "Cyber crime reporting systems", "Law Committee", d(2020, 8, 1)), (4, "Old matter", "Law Committee", d(2020, 3, 1))], cols)
    reports = spark.createDataFrame([(70, "Coastal fishing licences report", "Work Committee", d(2020, 1, 6))], "id long, title string, body string, day date")
    responses = spark.createDataFrame([(900, "Government response to Work: Freight rail corridors", d(2020, 9, 1)), (901, "Response on fishing", d(2020, 9, 2))], "rid long, title string, tabled date")
    links = spark.createDataFrame([(70, 901)], "ref long, rid long")
    by_hand = spark.createDataFrame([], "title string, tabled date, rid long")
    other = spark.createDataFrame([(5, "Cyber crime reporting systems", "Joint Law Committee", d(2020, 8, 20), None)], "id long, title string, body string, day date, ref long")
    out = register.refresh(spark, schedule, tracker, reports, responses, links, by_hand, other, "2020-06-30", "2020-12-31", "2020-01-01")
    assert [r["id"] for r in out["open"].collect()] == [3]
    assert {(r["id"], r["rid"], r["basis"]) for r in out["removed"].collect()} == {(1, 901, "link"), (2, 900, "title match")}
    assert [(r["lid"], r["rid"]) for r in out["on_both"].collect()] == [(3, 5)]
    assert {r["as_at"].month: r["backlog"] for r in out["backlog"].collect()}[8] == 3
    assert out["faults"].count() == 0


def test_an_answer_is_judged_whole(spark):
    asked = "The committee recommends that the Australian Government fund the program for ten further years"
    reasons = "It has been weighed with care by all who took part in the work. " * 50
    text = f"Recommendation 1\n{asked}.\n\nGovernment response: {reasons}The Government does not support this recommendation.\n"
    got = segments.read(spark.createDataFrame([(1, text)], "d long, t string"), "d", "t").collect()
    assert [(r["state"], r["verdict"]) for r in got] == [("position", "not accepted")] and len(got[0]["said"]) > 3000


def test_an_item_too_long_is_refused_and_not_cut(spark):
    long = "That the program be kept and that it must be reviewed again " * 40
    docs = spark.createDataFrame([(1, f"Recommendation 1\n{long}\nChapter 2\n")], "d long, t string")
    got = segments.report_segments(docs, "d", "t").collect()
    assert [r["why"] for r in got] == ["length"] and len(got[0]["asked"]) > segments.REPORT_MAX
    assert segments.best_report_label(segments.report_segments(docs, "d", "t")).count() == 0


def test_the_committee_wins_a_label_over_a_shorter_dissent(spark):
    text = "Recommendation 1\nThe committee recommends that the whole program be extended by four more years.\nChapter 2\n\nRecommendation 1\nThe Greens recommend that it must be closed.\n"
    found = segments.report_segments(spark.createDataFrame([(1, text)], "d long, t string"), "d", "t")
    assert [(r["author"], r["asked"][:13]) for r in segments.best_report_label(found).collect()] == [("", "The committee")]


def test_a_quotation_may_hold_what_ends_a_quote(spark):
    asked = r"The committee recommends that paths like C:\Ends and \Q be read as they stand (every time) in all of the records"
    docs = spark.createDataFrame([(1, f"Recommendation 3\n{asked}.\n")], "doc_id long, text string")
    rows = spark.createDataFrame([(1, "3", asked)], "doc_id long, label string, asked string")
    assert [r["outcome"] for r in corpus.provenance(rows, docs, r"(?i)Recommendation\s*(\d{1,3})").collect()] == ["verified"]


def test_a_probe_in_many_places_finds_each_label(spark):
    words = "the same words stand under every label of this long text"
    text = "".join(f"Recommendation {i % 999}\n{words}.\n" for i in range(4000))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    rows = spark.createDataFrame([(1, str(n), words) for n in (0, 500, 998, 999)], "doc_id long, label string, asked string")
    got = {r["label"]: r["outcome"] for r in corpus.provenance(rows, docs, r"(?i)Recommendation\s*(\d{1,3})").collect()}
    assert got["500"] == got["998"] == "verified" and got["999"] == "label does not match"


def test_a_late_position_replaces_a_bare_mention(spark):
    text = "Recommendation 7\nThis recommendation is held in a confidential part.\nRecommendation 7\nThe Government accepts this recommendation.\nRecommendation 8 and 9\nThe Government will think about it. It supports recommendation 8 of others.\n"
    got = {r["label"]: (r["state"], r["verdict"], r["said"]) for r in segments.prose_answers(spark.createDataFrame([(1, text)], "d long, t string"), "d", "t").collect()}
    assert got["7"] == ("position", "accepted", "The Government accepts this recommendation.")
    assert got["8"][0] == "position"
