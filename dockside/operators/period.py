"""Transaction facts laid out by the month of their source rows, and increments that read only the months a batch touches.

Per month a signature of the source ids that the fact carries is published beside it. A nightly run compares it with that
of today's staged rows: the months that differ are the batch's, few and known before any row is looked at. They become
literal filters, on the staged side as ranges of days, on the published side as a list of partitions; the anti-join by
source id sees nothing else. A staged row that found no dimension keeps its month differing, so it is taken up again, and so
does a loaded row that has gone at the source, which the fact keeps.

Tables that are updated in place (an accumulating snapshot, a dimension of type 1) can be laid out likewise. The signatures then
are those of the source, and a night rewrites the months in which it differs from the night before; the log carries over
the directories of the others.
"""

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from dockside.operators import increment, scd, signature
from dockside.sources.overlay import Overlay

MONTH = "SourceMonth"  # year * 100 + month


def month_of(day):
    day = F.col(day) if isinstance(day, str) else day
    return (F.year(day) * 100 + F.month(day)).cast("int")


@dataclass(frozen=True)
class Period:
    """The staged ``table`` whose rows a fact carries as ``loaded_as``, by the month of ``day``. Where the day stands in a parent
    table, ``parent`` is its name and ``link`` the column that both have."""

    table: str
    source_id: str
    loaded_as: str
    day: str
    parent: str | None = None
    link: str | None = None

    def by_link(self, s) -> DataFrame:
        """Signatures of the ids by the parent's key, as staging publishes them."""
        return signature.by_parent(s[self.table], [self.link], [self.source_id])

    def signatures(self, s) -> DataFrame:
        """One signature per month of the staged rows' ids; rows without a day are month null."""
        if self.parent is None:
            rows = s[self.table].select(month_of(F.col(self.day).cast("date")).alias(MONTH), self.source_id)
            return signature.signatures(rows, [MONTH], [self.source_id])
        published = s.signatures(f"{self.table}.ids") if hasattr(s, "signatures") else None
        months = s[self.parent].select(self.link, month_of(self.day).alias(MONTH))
        if published is None:  # a row's hash is smaller than a signature of its own, and most parents have rows in many places
            rows = s[self.table].select(self.link, signature.row_hash([self.source_id]).alias("_hash"))
            return signature.summed(rows.join(months, self.link).select(MONTH, "_hash"), [MONTH])
        return signature.added(published.join(months, self.link), [MONTH])

    def carried(self, fact: DataFrame) -> DataFrame:
        """The same signatures of the rows that the fact carries."""
        return signature.signatures(fact, [MONTH], [self.loaded_as])

    def staged(self, s, months) -> Overlay:
        """The sources with the table cut to the months."""
        days = signature.in_months(self.day, months)
        if self.parent is None:
            return Overlay(s, **{self.table: s[self.table].where(days)})
        parents = s[self.parent].where(days)
        rows = s[self.table].join(parents.select(self.link), self.link, "left_semi")
        return Overlay(s, **{self.table: rows, self.parent: parents})


def laid_out(rows: DataFrame, day: str) -> DataFrame:
    """``rows`` with the month of ``day``; 0 where it is null."""
    return rows.withColumn(MONTH, F.coalesce(month_of(F.col(day).cast("date")), F.lit(0)))


def dated_in(day: str, months):
    """``day`` lies in one of the ``months`` as ``laid_out`` numbers them, as ranges that reach the scan."""
    found = signature.in_months(day, [dt.date(m // 100, m % 100, 1) for m in months if m])
    return found | F.col(day).isNull() if 0 in months else found


def homes(current: DataFrame, wanted: DataFrame, keys, months) -> list[int]:
    """``months`` and the other ones that hold published rows with the keys of ``wanted``: those that have moved to another month at the
    source, or gone and come back. Only keys that no row of ``months`` has are looked for, in the key columns of the rest."""
    inside = F.col(MONTH).isin(months)
    strangers = wanted.select(*keys).join(current.where(inside).select(*keys), list(keys), "left_anti")
    found = current.where(~inside).join(strangers, list(keys), "left_semi").select(MONTH).distinct().collect()
    return sorted({*months, *(r[0] for r in found)})


def update_members(current: DataFrame, source: DataFrame, dim: scd.Dimension, day: str, run_date, months) -> tuple[DataFrame, list[int]]:
    """The next rows of the months that staged members of ``months`` touch, with ``ChangeType``, and these months; all other
    published rows stay as they are. ``current`` is laid out by ``day``. One row a member, so not for versioned dimensions."""
    if dim.kind == "versioned":
        raise ValueError(f"{dim.name} has several rows a member, which may lie in several months")
    staged = source.where(dated_in(day, months))
    touched = homes(current, staged, dim.business_key, months)
    rows = scd.update(current.where(F.col(MONTH).isin(touched)), staged, dim, run_date, among=current)
    return laid_out(rows, day), touched


def member_signatures(source: DataFrame, dim: scd.Dimension, day: str) -> DataFrame:
    """One signature per month of ``day`` of what the source says of the dimension's members."""
    return signature.signatures(laid_out(source, day), [MONTH], [*dim.business_key, *dim.attributes])


def batch_months(seen: DataFrame, now: DataFrame) -> list[int]:
    """The months whose rows differ; as many as there are months at most."""
    return sorted(r[0] for r in signature.touched(seen, now, [MONTH]).collect() if r[0] is not None)


def compared_months(seen: DataFrame, now: DataFrame) -> tuple[list[int], list[int]]:
    """The months whose rows differ, and those whose rows are the same."""
    months = [tuple(r) for r in signature.compared(seen, now, [MONTH]).collect() if r[0] is not None]
    return sorted(m for m, same in months if not same), sorted(m for m, same in months if same)


def update(current: DataFrame, s, d, period: Period, build, months, upto=None) -> DataFrame:
    """The published rows as kept and the staged rows that are not among them as inserted; only ``months`` are read.
    ``current`` has the column ``SourceMonth``; ``upto`` leaves later days out."""
    cut = period.staged(s, [dt.date(m // 100, m % 100, 1) for m in months])
    rows = cut[period.table]
    if upto is not None:
        rows = rows.where(F.col(period.day) <= F.lit(upto).cast("date"))
    fresh = increment.unloaded(rows, current.where(F.col(MONTH).isin(months)), period.source_id, period.loaded_as)
    return increment.append(current, build(Overlay(cut, **{period.table: fresh}), d, month=True))


def carried_after(current: DataFrame, period: Period, seen: DataFrame, months) -> DataFrame:
    """The published signatures after an update that read ``months``."""
    read = F.col(MONTH).isin(months)
    return seen.where(~read | F.col(MONTH).isNull()).unionByName(period.carried(current.where(read)))
