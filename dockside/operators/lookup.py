"""Dimension lookups used while building facts: by key, by validity interval, and as of a date.

No join here forces a broadcast: Spark broadcasts a side when its measured size allows it and shuffles
otherwise. In a shuffle join the repeated key is always on the fact side and unique (or a handful of versions)
on the other, the shape adaptive execution splits when a key is hot.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from dockside.functions.dates import FIRST_DAY, LAST_DAY
from dockside.operators.keys import UNKNOWN_KEY


def date_keys(calendar: DataFrame, key: str, **roles: str):
    """``date_keys(cal, "DimDateID", DueDate="DueDateID")`` -> {role date: two-column lookup}."""
    return {date: calendar.select(F.col("FullDate").alias(date), F.col(key).alias(alias)) for date, alias in roles.items()}


def key_lookup(rows: DataFrame, dimension: DataFrame, on, key: str, how: str = "inner", unknown: bool = False) -> DataFrame:
    """Add ``key`` by matching business-key columns; ``unknown`` fills -1 where a left lookup finds nothing."""
    on = [on] if isinstance(on, str) else list(on)
    joined = rows.join(dimension.select(*on, key), on, how)
    return joined.withColumn(key, F.coalesce(F.col(key), F.lit(UNKNOWN_KEY).cast("bigint"))) if unknown else joined


def validity(dimension: DataFrame, business_key, key: str, start: str = "StartDate") -> DataFrame:
    """Gap-free, overlap-free validity per business key, from the version start dates alone.

    The first known version reaches back to the beginning of time, so a fact older than the warehouse still
    finds its member, and finds the same one on every later run. A key has one version per run date at most,
    so the window stays small whatever the key.

    The window is partitioned by the key wrapped in a struct on purpose: the join that follows then shuffles the
    versions by the plain key itself, and only a join fed by two shuffles of its own can have a hot key split.
    """
    versions = Window.partitionBy(F.struct(*business_key)).orderBy(start, key)
    return dimension.select(
        *business_key,
        key,
        F.when(F.lag(start).over(versions).isNull(), F.lit(FIRST_DAY).cast("date")).otherwise(F.col(start)).alias("_from"),
        F.coalesce(F.date_sub(F.lead(start).over(versions), 1), F.lit(LAST_DAY).cast("date")).alias("_to"),
    )


def version_lookup(rows: DataFrame, dimension: DataFrame, business_key, day: str, key: str, start: str = "StartDate", how: str = "inner") -> DataFrame:
    """Exactly one version per row: the one in force on ``day``."""
    business_key = [business_key] if isinstance(business_key, str) else list(business_key)
    return _range_join(rows, validity(dimension, business_key, key, start), business_key, day, key, how)


def version_lists(dimension: DataFrame, business_key: str, key: str, start: str = "StartDate") -> DataFrame:
    """One row per business key with its versions in order, to be brought to a parent of the rows that look them up: these then find
    theirs by ``version_on`` without a shuffle of their own. A key has one version per run date at most, so the list stays short."""
    versions = F.sort_array(F.collect_list(F.struct(F.col(start).alias("since"), F.col(key).alias("key"))))
    return dimension.groupBy(business_key).agg(versions.alias("_versions"))


def version_on(day: str) -> Column:
    """The key that ``version_lookup`` finds, from a column of ``version_lists``: the last version begun by ``day``, before that the first."""
    begun = F.filter("_versions", lambda v: v["since"] <= F.col(day))
    found = F.coalesce(F.get(begun, F.size(begun) - 1), F.get("_versions", F.lit(0)))
    return F.when(F.col(day).isNotNull(), found["key"])


def interval_lookup(rows: DataFrame, dimension: DataFrame, business_key, day: str, key: str, start: str = "StartDate", end: str = "EndDate", how: str = "inner") -> DataFrame:
    """Versions whose stored interval holds ``day`` (an open end counts as forever); no match outside it."""
    business_key = [business_key] if isinstance(business_key, str) else list(business_key)
    ranges = dimension.select(
        *business_key, key, F.col(start).alias("_from"), F.coalesce(F.col(end), F.lit(LAST_DAY).cast("date")).alias("_to")
    )
    return _range_join(rows, ranges, business_key, day, key, how)


def _range_join(rows, ranges, business_key, day, key, how):
    right = ranges.select(*[F.col(c).alias(f"_r_{c}") for c in business_key], key, "_from", "_to")
    match = F.col(day).between(F.col("_from"), F.col("_to"))
    for c in business_key:
        match = (F.col(c) == F.col(f"_r_{c}")) & match
    return rows.join(right, match, how).select(*rows.columns, key)


def as_of(rows: DataFrame, history: DataFrame, key: str, day: str, since: str, tiebreak: str, values) -> DataFrame:
    """Left lookup of the last ``history`` row with ``since <= day``; ties go to the highest ``tiebreak``.

    The lookup is resolved once per (key, day), not per row: the distinct pairs and the history collapse to at
    most one entry per key and calendar day before the window, so even a key with a third of all rows gives a
    window partition of a few thousand entries. The rows then pick their answer up by an equi-join.
    """
    values = list(values)
    latest = F.max_by(F.struct(*values), F.col(tiebreak)).alias("_found")
    known = history.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_k"), F.col(since).alias("_d")).agg(latest)
    wanted = rows.where(F.col(key).isNotNull() & F.col(day).isNotNull()).select(F.col(key).alias("_k"), F.col(day).alias("_d")).distinct()
    timeline = known.withColumn("_asked", F.lit(0)).unionByName(wanted.withColumn("_asked", F.lit(1)), allowMissingColumns=True)
    order = Window.partitionBy("_k").orderBy("_d", "_asked").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    answers = (
        timeline.withColumn("_found", F.last("_found", ignorenulls=True).over(order))
        .where("_asked = 1")
        .select("_k", "_d", *[F.col(f"_found.{v}").alias(v) for v in values])
    )
    joined = rows.join(answers, (F.col(key) == F.col("_k")) & (F.col(day) == F.col("_d")), "left")
    return joined.select(*rows.columns, *values)
