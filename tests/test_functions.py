"""Sentence tables and small cases for the column functions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from duebook.functions import dates, numbering, text, tokens, wording
from duebook.operators import status


def column(spark, values, make, schema="x string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {schema}")
    return [r["y"] for r in df.select("i", make(F.col("x")).alias("y")).orderBy("i").collect()]


POSITIONS = [
    ("Supported", "1", "accepted"),
    ("The Government supports this recommendation.", "1", "accepted"),
    ("Agreed in part.", "1", "in part or in principle"),
    ("Supported in - principle. More follows.", "1", "in part or in principle"),
    ("The Australian Government accepts the Committee's recommendations in principle.", "1", "in part or in principle"),
    ("The Government broadly supports this recommendation.", "1", "in part or in principle"),
    ("Not supported.", "1", "not accepted"),
    ("The Government does not agree to this recommendation.", "1", "not accepted"),
    ("The Government is unable to support the recommendation.", "1", "not accepted"),
    ("The Government rejects recommendation 4.", "4", "not accepted"),
    ("The recommendation has already been implemented.", "1", "accepted"),
    ("The Government does not accept recommendations one and two.", "2", "not accepted"),
    ("The Government does not accept recommendations one and two.", "3", ""),
    ("The Government agrees in principle with recommendations 10 to 12.", "11", "in part or in principle"),
    ("The Government agrees in principle with recommendations 10 to 12.", "13", ""),
    ("The Government notes this recommendation.", "1", ""),
    ("Support Act is a charity.", "1", "accepted"),
    ("The Department will publish a plan to support farmers.", "1", ""),
    ("", "1", ""),
    (None, "1", ""),
]


def test_positions_and_verdicts(spark):
    df = spark.createDataFrame([(i, w, l) for i, (w, l, _) in enumerate(POSITIONS)], "i int, w string, l string")
    got = df.select("i", wording.verdict(F.col("w"), F.col("l")).alias("v")).orderBy("i").collect()
    assert [r["v"] for r in got] == [v for *_, v in POSITIONS]


TEMPLATES = [
    ("Given the passage of time since this report was tabled, a substantive Government response is no longer appropriate.", "proforma_closure"),
    ("Given the time that has elapsed, a response is no longer considered necessary to be given here.", "proforma_closure"),
    ("Given the passage of time since this report was tabled, the Government provides the following update: all is done.", "substantive"),
    ("Given the passage of\nvoting centres and to all mobile teams at the next\nof time, a substantive government response is no longer\nfederal election. appropriate.", "proforma_closure"),
    ("The Government supports this. Given the passage of time, a response is no longer appropriate to it.", "partial_proforma"),
    ("too short", "unreadable"),
]


def test_classes(spark):
    from duebook.operators.corpus import classify

    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(TEMPLATES)], "i int, text string")
    got = classify(df).orderBy("i").collect()
    assert [r["class"] for r in got] == [c for _, c in TEMPLATES]


def test_dates(spark):
    assert column(spark, ["Report presented 23 August 2010", "tbled 17 november 2010", "31 February 2010", "none"], dates.long_date) == [
        dt.date(2010, 8, 23), dt.date(2010, 11, 17), None, None]
    assert column(spark, ["Report tabled: 1/4/2026", "13/13/2026"], dates.slash_date) == [dt.date(2026, 4, 1), None]
    got = column(spark, ["2025-11-30", "2024-02-28", "2025-01-31"], lambda c: dates.deadline(F.to_date(c)))
    assert got == [dt.date(2026, 2, 28), dt.date(2024, 5, 28), dt.date(2025, 4, 30)]
    assert column(spark, ["1.2.89", "1.2.90", "1/2/05 * i"], dates.cell_date) == [dt.date(2089, 2, 1), dt.date(1990, 2, 1), dt.date(2005, 2, 1)]
    assert column(spark, [4291, 20, 366], dates.human_duration, "x int") == ["11 years, 8 months", "0 months", "1 year"]


def test_status(spark):
    df = spark.createDataFrame([("7.3.24",), ("Interim*",), ("minute. Complete response",), ("x. Incomplete response",), ("-",), ("",), ("odd",)], "cell string")
    df = df.withColumn("tabled", F.current_date()).withColumn("title", F.lit("t"))
    rows = {r["cell"]: r for r in status.decode(df, "cell", "tabled", "title").collect()}
    assert rows["7.3.24"]["received"] == dt.date(2024, 3, 7)
    assert rows["Interim*"]["considered"] and rows["Interim*"]["interim"]
    assert rows["minute. Complete response"]["complete"] and rows["x. Incomplete response"]["partial"]
    assert rows["-"]["notes"] == "" and rows[""]["notes"].startswith("no status") and rows["odd"]["notes"].startswith("unrecognised")


def test_titles(spark):
    assert column(spark, ["Report 505: accounts", "Report No. 4 and report 12", "none"], tokens.numbers) == [["505"], ["12", "4"], []]
    assert column(spark, ["Iron Boomerang [August 2023]", "Bill 2024 [Provisions]", "X (2019) [May 2020]"], text.without_month) == [
        "Iron Boomerang", "Bill 2024 [Provisions]", "X"]
    assert column(spark, ["Committee on Healthiv", "Committee on Work"], text.clean_body) == ["Committee on Health", "Committee on Work"]


def test_labels(spark):
    assert column(spark, ["4.1–4.3", "7.8 and 7.10", "6.30 to 7.2", "3"], numbering.labels_in) == [["4.1", "4.2", "4.3"], ["7.8", "7.10"], ["6.30", "7.2"], ["3"]]
    assert column(spark, ["one to three", "10 & 12", "none"], numbering.numbers_in) == [[1, 2, 3], [10, 12], []]
    done = column(spark, [["1", "2", "3"], ["1", "3"], ["1.1", "1.2", "2.1"], ["1", "2.1"], []], lambda c: numbering.completeness(c)[1], "x array<string>")
    assert done == [True, False, True, False, True]


@pytest.mark.parametrize(
    "words, away",
    [
        ("This is a matter for state and territory governments.", True),
        ("It is primarily the responsibility of the Victorian Government.", True),
        ("Weed control is a shared duty, noting it is a responsibility of state and territory governments.", False),
        ("The Government works with the states and territories.", False),
    ],
)
def test_points_elsewhere(spark, words, away):
    assert column(spark, [words], wording.points_elsewhere) == [away]


def test_long_tails_are_tidied_like_short_ones(spark):
    body = "The committee recommends that funding be kept " * 8
    got = column(spark, ["2.10 " + body + "12 Response: 7", body[:50] + "Response" + " ." * 200], text.tidy)
    assert got == [body.strip(), body[:50].strip()]


def test_drift(spark):
    loose = "Given the time elapsed since this report the Government will not respond to anything in it."
    assert column(spark, [loose, TEMPLATES[0][0], TEMPLATES[2][0]], wording.drifted) == [True, False, False]
