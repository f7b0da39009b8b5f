"""Dates written in prose or cells, deadlines, clocks, durations."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values.
LONG_DATE = r"(\d{1,2})\s+([A-Za-z]+)\s+(\d{4})"
SLASH_DATE = r"(\d{1,2})/(\d{1,2})/(\d{4})"
CELL_DATE = r"^\s*(\d{1,2})[./](\d{1,2})[./](\d{4}|\d{2})\s*\*?\s*[a-z]{0,3}\s*$"
AS_AT = r"(?i)as at (\d{1,2}\s+[A-Za-z]+\s+\d{4})"
PERIOD_START = r"(?i)received since (\d{1,2}\s+[A-Za-z]+\s+\d{4})"
DEADLINE_MONTHS = 3
CUTS = (180, 365, 730, 1826)
BUCKETS = (
    "within the deadline",
    "to 180 days",
    "181 to 365 days",
    "1 to 2 years",
    "2 to 5 years",
    "over 5 years",
)


def _date(text: Column, pattern: str) -> Column:
    return F.to_date(F.try_to_timestamp(text, F.lit(pattern)))


def long_date(text: Column) -> Column:
    """The first ``D Month YYYY`` in a text; null when it names no real day."""
    return _date(
        F.regexp_replace(F.regexp_extract(text, LONG_DATE, 0), r"\s+", " "), "d MMMM yyyy"
    )


def long_dates(text: Column) -> Column:
    """Every real ``D Month YYYY`` of a text, in order."""
    found = F.regexp_extract_all(text, F.lit(LONG_DATE), F.lit(0))
    parsed = F.transform(found, lambda s: _date(F.regexp_replace(s, r"\s+", " "), "d MMMM yyyy"))
    return F.filter(parsed, lambda d: d.isNotNull())


def slash_date(text: Column) -> Column:
    """The first ``D/M/YYYY`` in a text, day first."""
    return _date(F.regexp_extract(text, SLASH_DATE, 0), "d/M/yyyy")


def slash_dates(text: Column) -> Column:
    """Every real ``D/M/YYYY`` of a text, in order."""
    found = F.regexp_extract_all(text, F.lit(SLASH_DATE), F.lit(0))
    return F.filter(F.transform(found, lambda s: _date(s, "d/M/yyyy")), lambda d: d.isNotNull())


def cell_date(cell: Column, pivot: Column | int = 90, inclusive: bool = False) -> Column:
    """A dotted or slashed cell date; two-digit years below the pivot are of this century.

    ``inclusive`` admits the pivot year itself (an edition's year plus one).
    """
    pivot = F.lit(pivot) if isinstance(pivot, int) else pivot
    day, month, year = (F.regexp_extract(cell, CELL_DATE, i) for i in (1, 2, 3))
    y = year.try_cast("int")
    recent = (y <= pivot) if inclusive else (y < pivot)
    full = F.when(y > 999, y).when(recent, y + 2000).otherwise(y + 1900)
    return _date(F.concat_ws(".", day, month, full.cast("string")), "d.M.yyyy")


def as_at(title: Column) -> Column:
    return long_date(F.regexp_extract(title, AS_AT, 1))


def period_start(prose: Column) -> Column:
    return long_date(F.regexp_extract(prose, PERIOD_START, 1))


def preferred_dates(cell: Column, word: str = "tabled") -> tuple[Column, Column]:
    """Dates of the lines that carry the preferred word, else of all lines, and which it was."""
    lines = F.split(cell, "\n")
    best = F.flatten(
        F.transform(F.filter(lines, lambda s: F.lower(s).contains(word)), slash_dates_first)
    )
    rest = F.flatten(F.transform(lines, slash_dates_first))
    basis = (
        F.when(F.size(best) > 0, word)
        .when(F.size(rest) > 0, "presented date used")
        .otherwise("no date parsed")
    )
    return F.when(F.size(best) > 0, best).otherwise(rest), basis


def slash_dates_first(line: Column) -> Column:
    return F.slice(slash_dates(line), 1, 1)


def deadline(start: Column, months: int = DEADLINE_MONTHS) -> Column:
    """The calendar-month due date, pulled back to the month's last day where needed."""
    return F.add_months(start, months)


def deadline_days(start: Column, missing: int = 90, months: int = DEADLINE_MONTHS) -> Column:
    """Days allowed from a start date; ``missing`` where no start is recorded."""
    return F.coalesce(F.datediff(deadline(start, months), start), F.lit(missing))


def overdue_days(waited: Column, allowed: Column) -> Column:
    return F.greatest(F.lit(0), waited - allowed)


def duration_bucket(days: Column, allowed: Column, cuts=CUTS, names=BUCKETS) -> Column:
    """A wait's bucket; the first is the row's own deadline, the rest are fixed cut-offs."""
    out = F.when(days <= allowed, names[0])
    for cut, name in zip(cuts, names[1:]):
        out = out.when(days <= cut, name)
    return out.otherwise(names[-1])


def _count_of(n: Column, unit: str) -> Column:
    return F.concat(n.cast("string"), F.lit(f" {unit}"), F.when(n == 1, "").otherwise("s"))


def human_duration(days: Column) -> Column:
    """Years of 365.25 and months of 30.44 days, comma between."""
    years = F.floor(days / F.lit(365.25))
    months = F.floor((days - years * F.lit(365.25)) / F.lit(30.44))
    return (
        F.when(years == 0, _count_of(months, "month"))
        .when(months == 0, _count_of(years, "year"))
        .otherwise(F.concat_ws(", ", _count_of(years, "year"), _count_of(months, "month")))
    )


def plain_duration(days: Column) -> Column:
    """Years of 365 and months of 30 days; days where neither is reached."""
    years = F.floor(days / 365)
    months = F.floor((days % 365) / 30)
    return (
        F.when((years > 0) & (months > 0), F.concat_ws(" ", _count_of(years, "year"), _count_of(months, "month")))
        .when(years > 0, _count_of(years, "year"))
        .when(months > 0, _count_of(months, "month"))
        .otherwise(_count_of(days, "day"))
    )


def in_months(days: Column) -> Column:
    return _count_of(F.round(days / F.lit(30.44)).cast("long"), "month")
