"""Staged rows that a fact does not carry, with the first link that fails them.

The months in which the signatures of the staged and of the carried ids still differ after a load are the only ones that can hold
such rows, so only they are read; rows without a day, or whose parent is not staged, are found by the parents' keys. The
links are walked for the rejected rows alone. A rejected row keeps its month differing, and so is taken up again.
"""

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from dockside.operators.period import MONTH, Period, compared_months, dated_in


@dataclass(frozen=True)
class Link:
    """``child`` (an expression over the row and what earlier links brought) must be found in ``table.column``; ``brings`` names further
    columns of the parent, which later links see as ``table_column``. ``built`` marks a dimension or calendar."""

    child: str
    table: str
    column: str
    brings: tuple = ()
    built: bool = False

    @property
    def name(self) -> str:
        return f"{self.table}.{self.column}"


def _chains(links, columns) -> list[tuple[list[str], list[tuple[int, Link]]]]:
    """The links with their places, by the row's own columns that they hang on, directly or by what earlier links bring."""
    chains: list[tuple[set, list, set]] = []
    for place, link in enumerate(links):
        names = set(re.findall(r"\w+", link.child))
        roots, steps, brought = names & set(columns), [(place, link)], {f"{link.table}_{c}" for c in link.brings}
        apart = []
        for chain in chains:
            if chain[0] & roots or chain[2] & names:
                roots, steps, brought = roots | chain[0], chain[1] + steps, brought | chain[2]
            else:
                apart.append(chain)
        chains = [*apart, (roots, sorted(steps, key=lambda step: step[0]), brought)]
    return [(sorted(roots), steps) for roots, steps, _ in chains]


def needed(rows: DataFrame, source_id: str, links) -> DataFrame:
    """``rows`` with the columns alone that ``failed_links`` looks at."""
    used = {source_id}.union(*[roots for roots, _ in _chains(links, rows.columns)])
    return rows.select(*[c for c in rows.columns if c in used])


def _walked(rows: DataFrame, steps, s, d) -> DataFrame:
    """``_failed`` lowered to the place of the first link of ``steps`` that finds no parent."""
    for place, link in steps:
        parent = (d if link.built else s)[link.table]
        parent = parent.select(F.col(link.column).alias("_parent"), *[F.col(c).alias(f"{link.table}_{c}") for c in link.brings], F.lit(True).alias("_found"))
        rows = rows.withColumn("_child", F.expr(link.child)).join(parent.dropDuplicates(["_parent"]), F.col("_child") == F.col("_parent"), "left")
        failed = F.when(F.col("_found").isNull(), F.lit(place))
        rows = rows.withColumn("_failed", F.least("_failed", failed)).drop("_child", "_parent", "_found")
    return rows


def failed_links(rows: DataFrame, source_id: str, links, s, d, otherwise: str) -> DataFrame:
    """(SourceID, FailedLink) for every row: the first link in order whose parent is missing or whose key is null, else ``otherwise``.
    Parents are taken once a key, so a row is never doubled. Links that hang on one another are walked by the distinct keys that they
    start from, and the rows meet the outcome once. ``rows`` are read for each such chain, so have them written before."""
    nowhere = F.lit(None).cast("int").alias("_failed")
    chains, rows = _chains(links, rows.columns), needed(rows, source_id, links).select("*", nowhere)
    for roots, steps in chains:
        if len(steps) == 1:
            rows = _walked(rows, steps, s, d)
            continue
        keys = _walked(rows.select(*roots).distinct().select("*", nowhere), steps, s, d).where("_failed is not null")
        keys = keys.select(*[F.col(c).alias(f"_key_{c}") for c in roots], F.col("_failed").alias("_here"))
        same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_key_{c}")) for c in roots])
        rows = rows.join(keys, same, "left").withColumn("_failed", F.least("_failed", "_here")).drop("_here", *[f"_key_{c}" for c in roots])
    name = F.get(F.array(*[F.lit(link.name) for link in links]), F.col("_failed")) if links else F.lit(None)
    return rows.select(F.col(source_id).cast("string").alias("SourceID"), F.coalesce(name, F.lit(otherwise)).alias("FailedLink"))


def uncarried(fact: DataFrame, s, period: Period, carried: DataFrame, upto=None) -> DataFrame:
    """Staged rows whose id the fact, laid out by month, does not carry; ``carried`` are its signatures by month. Rows after the day ``upto`` are
    not due yet. Where no month is the same on both sides, there is nothing to leave out, and the rows are not sought by their parents."""
    months, same = compared_months(carried, period.signatures(s))
    if period.parent is None:
        rows = s[period.table].where(dated_in(period.day, months) | F.col(period.day).isNull())
        if upto is not None:
            rows = rows.where(F.col(period.day).isNull() | (F.col(period.day).cast("date") <= F.lit(upto).cast("date")))
    elif not same:
        rows = s[period.table]
    else:
        parents, link = s[period.parent], period.link
        published = s.signatures(f"{period.table}.ids") if hasattr(s, "signatures") else None
        held = (period.by_link(s) if published is None else published).select(link)
        dated = parents.where(dated_in(period.day, months) | F.col(period.day).isNull()).select(link)
        lost = held.join(parents.select(link), link, "left_anti")
        rows = _with_keys(s[period.table], dated.unionByName(lost), link)
    loaded = fact.where(F.col(MONTH).isin(months)).select(F.col(period.loaded_as).alias(period.source_id))
    return rows.join(loaded, period.source_id, "left_anti")


def _with_keys(rows: DataFrame, keys: DataFrame, link: str) -> DataFrame:
    """Rows whose ``link`` is among the keys, null like any other."""
    keys = keys.select(F.col(link).alias("_key")).distinct()
    return rows.join(keys, rows[link].eqNullSafe(keys["_key"]), "left_semi")
