"""Slowly changing dimensions as pure functions: (current state, staged rows, run date) -> next state.

``update`` adds a ``ChangeType`` column (kept / updated / expired / inserted) that loads count and drop.
Members missing from the staged rows are kept.

An update shuffles once. The live rows and the staged rows are unioned and sorted inside the surrogate-key
buckets, which puts both sides of a member next to each other; every row then decides for itself what becomes
of it, and new rows take their keys from the same sort.
"""

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from dockside.functions.compare import any_differs
from dockside.operators.keys import BUCKET_SQL, assign_keys, digest_sql, highest_key, interleaved, with_unknown

CHANGE = "ChangeType"


@dataclass(frozen=True)
class Dimension:
    """What makes one dimension differ from the next.

    kind        overwrite (type 1), versioned (type 2), previous_value (type 3) or insert_only
    tracked     columns whose change matters; the rest of ``attributes`` ride along
    chain       type 3: current value first, then the columns holding older values
    seed_chain  type 3: fill the older columns with the first value instead of NULL
    stamp       type 3: date column set when the value was last set
    first_start versioned: column giving the first version's start, instead of the run date
    """

    name: str
    key: str
    business_key: tuple
    attributes: tuple
    kind: str
    tracked: tuple = ()
    required: tuple = ()
    chain: tuple = ()
    seed_chain: bool = False
    stamp: str | None = None
    start: str = "StartDate"
    end: str = "EndDate"
    current: str = "IsCurrent"
    first_start: str | None = None
    end_offset_days: int = -1
    null_equals_blank: bool = False
    unknown: dict | None = None
    constants: dict = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        extra = [*self.chain[1:], *([self.stamp] if self.stamp else [])]
        if self.kind == "versioned":
            extra += [self.start, self.end, self.current]
        return [self.key, *self.business_key, *self.attributes, *self.constants, *extra]


def _members(source: DataFrame, dim: Dimension, run_date) -> DataFrame:
    """Staged rows as members seen for the first time: every column of the dimension but the key."""
    if dim.kind == "insert_only":
        source = source.where(f"{dim.business_key[0]} is not null").select(*dim.business_key, *dim.attributes).distinct()
    values = {c: c for c in (*dim.business_key, *dim.attributes)}
    values |= {name: repr(value).lower() if isinstance(value, bool) else repr(value) for name, value in dim.constants.items()}
    for older in dim.chain[1:]:
        values[older] = dim.chain[0] if dim.seed_chain else f"cast(null as {source.schema[dim.chain[0]].dataType.simpleString()})"
    if dim.stamp:
        values[dim.stamp] = _day(run_date)
    if dim.kind == "versioned":
        values |= {dim.start: dim.first_start or _day(run_date), dim.end: "cast(null as date)", dim.current: "true"}
    return source.selectExpr(*[f"{value} as {name}" for name, value in values.items()])


def _day(value) -> str:
    return f"date'{value}'"


def first_load(source: DataFrame, dim: Dimension, run_date) -> DataFrame:
    """Key every source member; versioned dimensions open one version each."""
    table = assign_keys(_members(source, dim, run_date), dim.business_key, dim.key).select(*dim.columns)
    return with_unknown(table, dim.key, dim.unknown) if dim.unknown else table


def update(current: DataFrame, source: DataFrame, dim: Dimension, run_date, compare: bool = True, among: DataFrame | None = None) -> DataFrame:
    """Next state of the whole dimension plus ``ChangeType``; without ``compare`` only unseen members are added. Where ``current`` is
    a part of the dimension, ``among`` is the whole, above whose keys new ones start."""
    versioned = dim.kind == "versioned"
    live = current.where(dim.current) if versioned else current
    rows = _paired(live, _members(source, dim, run_date), dim)

    tracked = (dim.tracked or dim.attributes) if compare and dim.kind != "insert_only" else ()
    today = _day(run_date)
    opened = f"if(_staged, _other.{dim.start}, {dim.start})"
    rows = rows.selectExpr(
        "*",
        f"_both and ({_changed(dim, tracked)}) as _differs",
        f"_differs and {opened} < {today} as _expire" if versioned else "false as _expire",
        "_staged and (not _both or _expire) as _fresh",
    )
    so_far = f"over (partition by _bucket order by {_order(dim)} rows unbounded preceding)"
    rows = rows.selectExpr("*", f"sum(int(_fresh)) {so_far} as _rank").where("_fresh or not _staged")

    steps = {"overwrite": _overwrite, "versioned": _version, "previous_value": _shift, "insert_only": _keep}
    next_value = steps[dim.kind if compare else "insert_only"]
    result = rows.select(
        F.when(F.col("_fresh"), interleaved(highest_key(current if among is None else among, dim.key), F.col("_rank"))).otherwise(F.col(dim.key)).alias(dim.key),
        *[F.expr(f"if(_fresh, {_first_value(c, dim, today)}, {next_value(c, dim, today)}) as `{c}`") for c in dim.columns[1:]],
        F.expr(f"case when _fresh then 'inserted' when _expire then 'expired' when _differs then 'updated' else 'kept' end as {CHANGE}"),
    )
    if versioned:
        past = current.where(f"not {dim.current}").selectExpr(*dim.columns, f"'kept' as {CHANGE}")
        result = past.unionByName(result)
    return result


def _order(dim: Dimension) -> str:
    return ", ".join(["_digest", *dim.business_key, "_staged"])


def _paired(live: DataFrame, members: DataFrame, dim: Dimension) -> DataFrame:
    """Live and staged rows in one frame; ``_other`` is the same member on the other side, if there (``_both``)."""
    digest, bucket = digest_sql(dim.business_key), BUCKET_SQL
    old = live.selectExpr(*dim.columns, "false as _staged", f"{digest} as _digest", f"{bucket} as _bucket")
    new = members.selectExpr("*", "true as _staged", f"{digest} as _digest", f"{bucket} as _bucket")
    side = f"struct(_staged, {', '.join(dim.columns[1:])})"
    order = f"over (partition by _bucket order by {_order(dim)})"
    same = " and ".join(["_other._staged <> _staged", *[f"_other.{c} <=> {c}" for c in dim.business_key]])
    return old.unionByName(new, allowMissingColumns=True).selectExpr(
        "*", f"if(_staged, lag({side}) {order}, lead({side}) {order}) as _other"
    ).selectExpr("*", f"coalesce({same}, false) as _both")


def _changed(dim: Dimension, columns) -> str:
    return any_differs([(c, f"_other.{c}") for c in columns], dim.null_equals_blank)


def _first_value(column, dim, today):
    """A new row is the staged one, except that a further version of a known member starts today."""
    return f"if(_both, {today}, {column})" if dim.kind == "versioned" and column == dim.start else column


def _overwrite(column, dim, today):
    """Type 1: the staged attributes replace the old ones."""
    return f"if(_differs, _other.{column}, {column})" if column in dim.attributes else column


def _version(column, dim, today):
    """Type 2: close the version. A member that changes twice on one run date has its open version rewritten
    instead, so no version ends before it starts and a repeated run changes nothing."""
    if column in dim.attributes:
        return f"if(_differs and not _expire, _other.{column}, {column})"
    if column == dim.end:
        return f"if(_expire, date_add({today}, {dim.end_offset_days}), {column})"
    return "not _expire" if column == dim.current else column


def _shift(column, dim, today):
    """Type 3: move the chain one step only when its first value changed; other tracked columns are overwritten."""
    moved = f"_both and ({_changed(dim, dim.chain[:1])})"
    newer = dict(zip(dim.chain[1:], dim.chain))
    if column == dim.chain[0] or (column in dim.tracked and column in dim.attributes):
        return f"if(_differs, _other.{column}, {column})"
    if column in newer:
        return f"if({moved}, {newer[column]}, {column})"
    return f"if({moved}, {today}, {column})" if column == dim.stamp else column


def _keep(column, dim, today):
    return column
