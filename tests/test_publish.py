"""Positions, cascades, tables against each other, claims and typeset lines on rows made by hand."""

from __future__ import annotations

import random

import pytest
from duebook.operators import compare, gates, matching, positions, typeset
from duebook.plans import QUERIES
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
RESPONSE = (
    "Response to Recommendations 6.1–6.29\nResponsibility: Australian Government\nResponse: Subject to further consideration\n"
    "The framework is being considered and a report follows in due course.\n"
    "Response to Recommendation 6.30\nResponsibility: Australian Government\nResponse: Accept\n"
    "The remit of the Centre will be made wider (see\nRecommendation 6.40) as part of it.\n"
    "Response to Recommendation 6.31\nResponse to Recommendation 6.32\nResponsibility: Australian Government\nACT and WA: Accept in\nprinciple\n"
    "The framework is being considered and a report follows in due course. The Charter changes with it.\n"
)
PROSE = "Recommendation 1\nThe Government agrees-in-principle with it and says so.\nRecommendation 2: A title\nThe Government agrees. It acts.\n"


@pytest.mark.parametrize(
    "line, want",
    [
        ("Response to Recommendation 4.22", ["4.22"]),
        ("Response to Recommendations 4.1–4.4", ["4.1", "4.2", "4.3", "4.4"]),
        ("Recommendations 6.6 and 6.7", ["6.6", "6.7"]),
        ("Response to Recommendations 6.6 to 6.8", ["6.6", "6.7", "6.8"]),
        ("Response to Recommendations 7.18, 7.19 and 7.21", ["7.18", "7.19", "7.21"]),
        ("Recommendation 17.1: Amend section 5.1 of the Act", ["17.1"]),
        ("Recommendation 7.26 as part of its review", []),
        ("Recommendation 74.", []),
        ("Recommendation 11) as part of", []),
        ("see Recommendation 11", []),
        ("Recommendations", []),
    ],
)
def test_what_a_heading_answers(spark, line, want):
    assert spark.createDataFrame([(line,)], "t string").select(positions.labels_named(F.col("t"))).first()[0] == want


def test_windows_are_intervals_and_back_to_back_headings_share_a_body(spark):
    docs = spark.createDataFrame([(1, RESPONSE), (2, None), (3, ""), (4, "no heading")], "doc_id long, text string")
    for block in (3, 65536):
        got = sorted((r.labels[0], len(r.labels), r.first_line, r.last_line) for r in positions.windows(docs, block).collect())
        assert got == [("6.1", 29, 0, 3), ("6.30", 1, 4, 8), ("6.31", 1, 9, 15), ("6.32", 1, 10, 15)]


def outcome(spark, text, label, state, verdicts, words):
    claims = spark.createDataFrame([("x", 1, label, state, verdicts, words)], "id string, doc_id long, label string, state string, verdicts array<string>, words string")
    return positions.positions(claims, spark.createDataFrame([(1, text)] if text else [], "doc_id long, text string")).first().outcome


@pytest.mark.parametrize(
    "text, label, state, verdicts, words, want",
    [
        (RESPONSE, "6.30", "position", ["Accept"], "The remit of the Centre will be made wider", "verified"),
        (RESPONSE, "6.32", "position", ["Accept in principle"], "The Charter changes with it.", "verified"),
        (RESPONSE, "6.31", "position", ["Accept in principle"], "The Charter changes with it.", "verified"),
        (RESPONSE, "6.31", "position", ["Accept"], "The Charter changes with it.", "the verdict is not stated there"),
        (RESPONSE, "6.7", "position", ["Subject to further consideration"], "The framework is\nbeing considered", "verified"),
        (RESPONSE, "6.30", "position", ["Accept"], "The Charter changes with it.", "the words stand under another label"),
        (RESPONSE, "6.30", "position", ["Accept"], "Words it never wrote.", "the words are not in the document"),
        (RESPONSE, "6.40", "noted", [], "", "the document does not name this label"),
        (RESPONSE, "6.7", "noted", None, None, "verified"),
        (RESPONSE, "6.7", "position", None, " ", "no words to check"),
        (RESPONSE, "6.99", "not addressed", None, None, "verified"),
        (None, "6.30", "position", ["Accept"], "anything", "source text missing"),
        (PROSE, "1", "position", ["The Government agrees"], "with it and says so.", "the verdict is not stated there"),
        (PROSE, "1", "position", ["The Government agrees-in-principle"], "with it and says so.", "verified"),
        (PROSE, "2", "position", ["The Government agrees"], "It acts.", "verified"),
    ],
)
def test_how_a_position_check_ends(spark, text, label, state, verdicts, words, want):
    assert outcome(spark, text, label, state, verdicts, words) == want


def test_a_failed_row_takes_all_that_rests_on_it(spark):
    rows = [("a", "text not in source"), ("b", "verified"), ("c", "verified"), ("d", "verified"), ("ring1", "verified"), ("ring2", "verified"), ("far", "verified"), ("own", "no words to check")]
    needs = [("b", "a"), ("c", "b"), ("c", "d"), ("ring1", "ring2"), ("ring2", "ring1"), ("far", "ring1"), ("own", "a"), ("d", "not there")]
    out = positions.cascade(spark.createDataFrame(rows, "id string, outcome string"), spark.createDataFrame(needs, "id string, on string"))
    got = {r.id: (r.outcome, r.round) for r in out.collect()}
    fell = "rests on a row that was not verified"
    assert got == {
        "a": ("text not in source", 0), "own": ("no words to check", 0), "b": (fell, 1), "c": (fell, 2), "d": ("verified", None),
        "ring1": ("verified", None), "ring2": ("verified", None), "far": ("verified", None),
    }
    none = positions.floor(out.limit(0)).first()
    assert (none.rows, none.publish) == (0, False) and not positions.floor(out).first().publish


def test_tables_are_compared_range_by_range(spark):
    r = random.Random(5)
    left = [(i, r.choice([None, "", "x", "y"]), i % 7) for i in range(500)] + [(None, "n", 1)]
    right = [(*x,) for x in left if x[0] not in (3, 4)] + [(900, "new", 0)]
    blank = next(i for i, t, _ in left[11:] if t == "")  # a blank that becomes a null
    right = [(k, {10: "other", blank: None}.get(k, v), n) for k, v, n in right]
    L, R = (spark.createDataFrame(x, "k long, v string, n long") for x in (left, right))
    for ranges in (1, 16, 4096):
        got = {(x.k, x.outcome) for x in compare.differences(L, R.repartition(5), ["k"], ["v", "n"], ranges).collect()}
        assert got == {(3, "left only"), (4, "left only"), (900, "right only"), (10, "differs"), (blank, "differs")}
    assert compare.differences(L, L.repartition(3), ["k"], ["v", "n"]).count() == 0
    twice = L.unionByName(L.where("k = 8"))
    assert [(x.k, x.outcome) for x in compare.differences(L, twice, ["k"], ["v", "n"]).collect()] == [(8, "held more than once")]
    assert compare.differences(L.limit(0), L.limit(0), ["k"], ["v"]).count() == 0
    assert compare.differing(L, R, ["k"], ["v", "n"]).count() <= 5


def test_every_publishing_rule_fires(spark):
    rules = {r.rule for r in QUERIES["gate_publish_tables"](spark, SF).select("rule").distinct().collect()}
    assert rules == {
        "no https link", "index row without a position", "position without an index row", "stated position without a verdict", "verdicts do not add up",
        "coverage of another build", "link to a document of another body", "removals counted and listed differ",
    }
    outcomes = {r.outcome for r in QUERIES["position_outcomes"](spark, SF).select("outcome").distinct().collect()}
    assert len(outcomes) == 7
    assert {r.outcome for r in QUERIES["claims_metrics"](spark, SF).select("outcome").distinct().collect()} == {"agrees", "moved", "unknown metric", "not said", "figures and keys differ in number"}


def test_claims_are_read_at_the_precision_printed(spark):
    briefs = spark.createDataFrame([(1, "s", "Of 1,204 rows\n(5.1 per cent) 3 remain; -x 7.250 left.")], "brief long, scope string, text string")
    metrics = spark.createDataFrame([("s", "rows", 1204.0), ("s", "share", 0.050847), ("s", "gone", 1201.0), ("other", "rows", 9.0)], "scope string, metric string, value double")
    claims = [
        (1, 1, "Of {} rows ({} per cent)", ["rows", "share%"]), (1, 2, "{} remain", ["rows - gone"]), (1, 3, "{} remain", ["gone - rows"]), (1, 4, "{} remain", ["lost"]),
        (1, 5, "{} remain", ["rows", "gone"]), (1, 6, "{} vanish", ["rows"]), (2, 7, "Of {}", ["rows"]), (1, 8, "Of {} rows", ["rows", " "]),
    ]
    out = gates.claims_table(briefs, spark.createDataFrame(claims, "brief long, claim int, pattern string, keys array<string>"), metrics)
    got = {(r.claim, r.figure, r.outcome) for r in out.collect()}
    assert got == {(1, 1, "agrees"), (1, 2, "agrees"), (2, 1, "agrees"), (3, 1, "moved"), (4, 1, "unknown metric"), (5, None, "figures and keys differ in number"), (6, None, "not said"), (8, 1, "agrees")}


def lines(spark, rows):
    return spark.createDataFrame([(1, i, f, float(s), t) for i, (f, s, t) in enumerate(rows)], "doc_id long, line_no int, font string, size double, text string")


def test_headings_go_on_only_in_an_extension_of_their_font(spark):
    cases = [
        ([("DINPro-Medium", 13, "Recommendation 4.33 Reference to the Convention"), ("DINPro-MediumItalic", 13, "of Persons"), ("DINPro", 9, "Body")], ["Reference to the Convention of Persons"]),
        ([("Calibri-Bold", 11, "Recommendation 1: Heading"), ("Calibri-Italic", 11, "Its text")], ["Heading"]),
        ([("Calibri-Bold", 11, "Recommendation 2 Heading"), ("Calibri", 11, "Its text"), ("Calibri-Bold", 11, "not any more")], ["Heading"]),
        ([("B", 11, "Recommendation 3 One"), ("B", 11, "Recommendation 4 Two"), ("B", 11, "goes on")], ["One", "Two goes on"]),
        ([(None, 11, "Recommendation 5 Alone"), (None, 11, "no font")], ["Alone"]),
    ]
    for rows, want in cases:
        for block in (1, 65536):
            assert [r.heading for r in typeset.label_headings(lines(spark, rows), block=block).orderBy("line_no").collect()] == want


def test_the_longest_heading_that_a_text_begins_with(spark):
    heads = spark.createDataFrame([(1, "One two"), (1, "One two three"), (1, "One two three four"), (1, "  "), (2, "Other:"), (3, "Straße — x")], "k int, heading string")
    texts = spark.createDataFrame([(1, "a", "One two three. And more"), (1, "b", "One twos"), (1, "c", None), (2, "d", "Other"), (9, "e", "No heads here"), (3, "f", "Straße — x: y")], "k int, row string, text string")
    got = {r.row: (r.heading, r.rest) for r in typeset.longest_prefix(texts, heads, ["k"], "row").collect()}
    assert got["a"] == ("One two three", "And more") and got["b"] == ("", "One twos") and got["d"] == ("Other", "") and got["e"] == ("", "No heads here") and got["f"] == ("Straße — x", "y")
    assert got["c"][0] == ""


def test_title_pairs_equal_brute_force(spark):
    r = random.Random(2)
    words = [f"w{i}" for i in range(25)]
    sets = [sorted(r.sample(words, r.randrange(0, 7))) for _ in range(160)]
    left = spark.createDataFrame(list(enumerate(sets[:80])), "lid long, a array<string>")
    right = spark.createDataFrame(list(enumerate(sets[80:])), "rid long, b array<string>")
    for ratio, least in ((0.6, 2), (0.8, 1), (0.5, 1), (1.0, 3)):
        got = {(x.lid, x.rid) for x in matching.title_pairs(left, right, "a", "b", ratio, least).collect()}
        want = set()
        for i, a in enumerate(sets[:80]):
            for j, b in enumerate(sets[80:]):
                n = len(set(a) & set(b))
                if a and b and n >= least and n >= ratio * min(len(a), len(b)) - 1e-9:
                    want.add((i, j))
        assert want <= got


def test_candidates_grow_with_the_rows(spark):
    """Ten times the titles of one topic: pairs of words keep the candidates in proportion."""
    def size(n):
        side = lambda k, ident: spark.createDataFrame([(i, ["aged", "care", "funding", f"case{i}", f"site{i % (k // 3)}"]) for i in range(k)], f"{ident} long, w array<string>").withColumnRenamed("w", f"w_{ident}")
        return matching.title_pairs(side(n, "lid"), side(n, "rid"), "w_lid", "w_rid", 0.8, 2).count()

    assert size(3000) <= 15 * size(300)
