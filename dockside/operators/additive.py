"""Totals kept up to date by adding and subtracting what has changed.

``entries`` holds a total's parts by source key: per key and group the number of source rows and the sums. They are signed: a night
adds, for the keys that differ at the source, the new part less the sum of all entries that the key has so far, so nothing is rewritten
and a repeated night adds nothing, whatever was lost in between. The totals take the same differences, and a group
without rows left goes. Sums are exact integers or decimals; a null measure counts as 0.
"""

from pyspark.sql import DataFrame, functions as F

ROWS = "SourceRows"


def entries(rows: DataFrame, key, by, **measures) -> DataFrame:
    """(key, by, SourceRows, measures): the part of each key in each group; ``measures`` are columns to be summed."""
    sums = [F.sum(F.coalesce(m, F.lit(0))).alias(name) for name, m in measures.items()]
    return rows.groupBy(*key, *by).agg(F.count(F.lit(1)).alias(ROWS), *sums)


def added(rows: DataFrame, by, measures) -> DataFrame:
    """Sums of entries or totals by ``by``, in the types that they have; what has come to no rows and no sums is left out."""
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    summed = rows.groupBy(*by).agg(*[F.sum(c).cast(kinds[c]).alias(c) for c in (ROWS, *measures)])
    return summed.where(" or ".join(f"{c} <> 0" for c in (ROWS, *measures)))


def totals(rows: DataFrame, by, measures) -> DataFrame:
    """The groups that have source rows, with SourceRows."""
    return added(rows, by, measures).where(f"{ROWS} > 0")


def deltas(before: DataFrame, now: DataFrame, key, by, measures) -> DataFrame:
    """Entries to add: the parts ``now`` less all entries of the same keys ``before``. Both are cut to the keys in question; keys
    without rows now are taken back whole."""
    columns = [*key, *by, ROWS, *measures]
    kinds = {f.name: f.dataType for f in before.schema.fields}
    back = before.select(*key, *by, *[(-F.col(c)).alias(c) for c in (ROWS, *measures)])
    return added(now.select(*[F.col(c).cast(kinds[c]).alias(c) for c in columns]).unionByName(back), [*key, *by], measures)


def folded(current: DataFrame, changes: DataFrame, by, measures) -> DataFrame:
    """The totals with the changes taken in."""
    columns = [*by, ROWS, *measures]
    return totals(current.select(*columns).unionByName(changes.select(*columns)), by, measures)
