"""Status cells of a register: what they say, and how a row is shown."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from duebook.functions import dates

# Fixed values.
NOTHING = ("-", "–", "—")
NO_RESPONSE = "No response to date"
PARTIAL = "Partial response received"
COMPLETE = "Fully responded"
DEADLINE_VERDICTS = ("Yes", "No", "Time not expired", "Time has not expired")
INTERIM_TITLE = r"(?i)\binterim\b"
JOINT_BODY = r"(?i)\bjoint\b|\bPJC\b"
BILL_TITLE = r"(?i)\bbills?\b"


def _notes(*parts: Column) -> Column:
    return F.array_join(F.filter(F.array(*parts), lambda n: n.isNotNull()), "; ")


def decode(df: DataFrame, cell: str, tabled: str, title: str) -> DataFrame:
    """First register: a date, a dash, Interim, Interim*, or a narrative with a verdict at its end."""
    c = F.col(cell)
    out = df.select(
        "*",
        dates.cell_date(F.regexp_replace(c, r"\*+$", ""), 90).alias("received"),
        c.startswith("Interim").alias("interim"),
        c.startswith("Interim*").alias("considered"),
        c.endswith("Incomplete response").alias("partial"),
        c.endswith("Complete response").alias("complete"),
    )
    known = (
        F.col("received").isNotNull()
        | F.col("interim")
        | F.col("partial")
        | F.col("complete")
        | c.isin(*NOTHING)
    )
    return out.withColumn(
        "notes",
        _notes(
            F.when(F.col(tabled).isNull(), "unparsed tabling date"),
            F.when(F.col(title) == "", "no title in source row"),
            F.when(c == "", "no status recorded in the schedule").when(
                ~known, F.concat(F.lit("unrecognised status "), c)
            ),
        ),
    )


def decode_with_verdict(df: DataFrame, cell: str, within: str, since: Column) -> DataFrame:
    """Second register: its own deadline verdict is taken, and late-booked responses are marked.

    Where the response cell is blank the verdict slides into its place.
    """
    slid = F.col(cell).isin(*DEADLINE_VERDICTS)
    out = df.select(
        "*",
        F.when(slid, "").otherwise(F.col(cell)).alias("response"),
        F.when(slid, F.col(cell)).otherwise(F.col(within)).alias("verdict"),
    )
    r, v = F.col("response"), F.col("verdict")
    out = out.select(
        "*",
        dates.cell_date(r, 90).alias("received"),
        r.startswith(PARTIAL).alias("partial"),
        r.startswith(COMPLETE).alias("complete"),
        (r.startswith(NO_RESPONSE) | (r == "")).alias("nothing"),
    ).withColumn("out_of_period", F.when(F.col("received") < since, F.col("received")))
    return out.withColumn(
        "notes",
        _notes(
            F.when(
                F.col("out_of_period").isNotNull(),
                F.concat(
                    F.lit("response of "),
                    F.col("received").cast("string"),
                    F.lit(" predates this reporting period"),
                ),
            ),
            F.when(
                F.col("received").isNull() & ~(F.col("partial") | F.col("complete") | F.col("nothing")),
                F.concat(F.lit("unrecognised status "), r),
            ),
            F.when((v != "") & ~v.isin(*DEADLINE_VERDICTS), F.concat(F.lit("unrecognised deadline verdict "), v)),
        ),
    )


def sentence_bucket(status: Column) -> Column:
    """What a government's status sentence amounts to; the first phrase found decides."""
    s = F.lower(F.coalesce(status, F.lit("")))
    return (
        F.when(s.contains("being considered"), "considered")
        .when(s.contains("full response"), "full")
        .when(s.contains("tabled on"), "answered")
        .otherwise("other")
    )


def display(precedence: list[tuple[Column, str]], default: str) -> Column:
    """The one status shown, by a register's own order of precedence."""
    out = None
    for cond, label in precedence:
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out.otherwise(default)


def title_flags(title: Column, body: Column) -> dict[str, Column]:
    return {
        "joint": body.rlike(JOINT_BODY),
        "interim_report": title.rlike(INTERIM_TITLE),
        "bill": title.rlike(BILL_TITLE),
    }


def grid_record(cells: Column, is_date: str = r"^\d{1,2}\.\d{1,2}\.\d{2,4}$") -> dict[str, Column]:
    """A grid row read by position among its non-empty cells.

    The first date cell is the tabling date, what stands before it is the title,
    the two after it are response and verdict; a bare Yes or No in the response
    place is the verdict of an empty response.
    """
    filled = F.filter(F.transform(cells, lambda c: F.trim(c)), lambda c: c != "")
    at = F.array_position(F.transform(filled, lambda c: c.rlike(is_date)), F.lit(True)).cast("int")
    resp = F.coalesce(F.get(filled, at), F.lit(""))
    within = F.coalesce(F.get(filled, at + 1), F.lit(""))
    slid = resp.isin("Yes", "No")
    return {
        "kind": F.when(at > 1, "record").when(F.size(filled) == 1, "continuation").otherwise("skipped"),
        "title": F.when(at > 1, F.array_join(F.slice(filled, F.lit(1), F.greatest(at - 1, F.lit(0))), " ")),
        "tabled_cell": F.when(at > 1, F.get(filled, at - 1)),
        "response": F.when(at > 1, F.when(slid, "").otherwise(resp)),
        "within": F.when(at > 1, F.when(slid, resp).otherwise(within)),
    }
