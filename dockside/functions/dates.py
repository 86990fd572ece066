"""Calendar arithmetic with SQL-Server-style boundaries, as built-in column expressions."""

from pyspark.sql import Column, functions as F

FIRST_DAY = "0001-01-01"
LAST_DAY = "9999-12-31"


def month_boundaries(start, end) -> Column:
    """Number of month boundaries crossed (31 Jan -> 1 Feb is 1, not 0.03)."""
    start, end = _c(start), _c(end)
    return (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)


def year_boundaries(start, end) -> Column:
    return F.year(_c(end)) - F.year(_c(start))


def month_start(day) -> Column:
    return F.trunc(_c(day), "MM").cast("date")


def iso_weekday(day) -> Column:
    """1 = Monday ... 7 = Sunday, whatever the session says."""
    return F.weekday(_c(day)) + 1


def sunday_weekday(day) -> Column:
    """1 = Sunday ... 7 = Saturday."""
    return F.dayofweek(_c(day))


def week_of_year(day, week_starts: str = "monday") -> Column:
    """Week number where week 1 is the week holding 1 January (not the ISO week)."""
    day = _c(day)
    jan1 = F.trunc(day, "YEAR")
    offset = F.weekday(jan1) if week_starts == "monday" else F.dayofweek(jan1) - 1
    return F.floor((F.dayofyear(day) - 1 + offset) / 7).cast("int") + 1


def _c(column) -> Column:
    return F.col(column) if isinstance(column, str) else column
