"""Calendar dimension: built from a date span, or extended to a run date."""

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from dockside.functions.dates import iso_weekday, sunday_weekday, week_of_year
from dockside.operators.keys import highest_key, with_unknown

# The unknown calendar member
UNKNOWN_DAY = dict(
    FullDate=dt.date(1900, 1, 1), Year=1900, Quarter=0, Month=0, MonthName="Unknown", Day=0, DayOfWeek=0, DayName="Unknown", WeekOfYear=0, IsWeekend=False
)


def _attributes(days: DataFrame, key: str, week_starts: str) -> DataFrame:
    day = F.col("FullDate")
    weekday = iso_weekday(day) if week_starts == "monday" else sunday_weekday(day)
    return days.select(
        F.col("_key").cast("bigint").alias(key),
        "FullDate",
        F.year(day).alias("Year"),
        F.quarter(day).alias("Quarter"),
        F.month(day).alias("Month"),
        F.date_format(day, "MMMM").alias("MonthName"),
        F.dayofmonth(day).alias("Day"),
        weekday.alias("DayOfWeek"),
        F.date_format(day, "EEEE").alias("DayName"),
        week_of_year(day, week_starts).alias("WeekOfYear"),
        (F.weekday(day) >= 5).alias("IsWeekend"),
    )


def calendar(span: DataFrame, key: str = "DimDateID", week_starts: str = "monday", unknown: bool = False) -> DataFrame:
    """One row per day of a one-row ``span`` (StartDate, EndDate), keyed 1, 2, ... in date order."""
    days = span.select(F.posexplode(F.sequence("StartDate", "EndDate")).alias("_pos", "FullDate"))
    table = _attributes(days.select((F.col("_pos") + 1).alias("_key"), "FullDate"), key, week_starts)
    return with_unknown(table, key, UNKNOWN_DAY) if unknown else table


def fixed_span(spark: SparkSession, start, end) -> DataFrame:
    return spark.range(1).select(F.lit(start).cast("date").alias("StartDate"), F.lit(end).cast("date").alias("EndDate"))


def date_span(tables_and_columns) -> DataFrame:
    """Smallest month-aligned span covering every given (DataFrame, date column)."""
    spans = [t.agg(F.min(c).cast("date").alias("_lo"), F.max(c).cast("date").alias("_hi")) for t, c in tables_and_columns]
    merged = spans[0]
    for other in spans[1:]:
        merged = merged.unionByName(other)
    return merged.agg(F.trunc(F.min("_lo"), "MM").alias("StartDate"), F.last_day(F.max("_hi")).alias("EndDate"))


def missing_days(span: DataFrame, current: DataFrame, key: str, week_starts: str = "monday") -> DataFrame:
    """The days of ``span`` that ``current`` lacks, keyed after the highest key in use."""
    days = span.select(F.explode(F.sequence("StartDate", "EndDate")).alias("FullDate"))
    absent = days.join(current.select("FullDate"), "FullDate", "left_anti").select(F.sort_array(F.collect_list("FullDate")).alias("_days"))
    keyed = absent.select(F.posexplode("_days").alias("_pos", "FullDate"))
    return _attributes(keyed.select((highest_key(current, key) + F.col("_pos") + 1).alias("_key"), "FullDate"), key, week_starts)


def extend_calendar(current: DataFrame, run_date, key: str = "DimDateID", week_starts: str = "monday") -> DataFrame:
    """Days after the last one present, up to ``run_date``; just ``run_date`` if the calendar is empty."""
    end = F.lit(run_date).cast("date")
    bounds = current.agg(F.coalesce(F.date_add(F.max("FullDate"), 1), end).alias("StartDate")).select("StartDate", end.alias("EndDate"))
    days = bounds.where("StartDate <= EndDate").select(F.posexplode(F.sequence("StartDate", "EndDate")).alias("_pos", "FullDate"))
    return _attributes(days.select((highest_key(current, key) + F.col("_pos") + 1).alias("_key"), "FullDate"), key, week_starts)
