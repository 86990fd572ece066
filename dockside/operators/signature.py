"""Which keys of a snapshot have changed at the source: order-free signatures of everything that feeds a key.

A signature is the number of a key's input rows with the sum and the exclusive or of their hashes, so it is added up in
any order, in part before the shuffle, and a moved, changed, added or removed input row shows on every key it belonged to.
Signatures are published beside the table they sign. A nightly run compares them, one small row a key, builds only the keys
that differ, and takes away those that nothing at the source supports any more.
"""

from pyspark.sql import Column, DataFrame, functions as F

from dockside.operators import increment

SIGNED = ("SignedRows", "SignedSum", "SignedXor")


def row_hash(columns) -> Column:
    """64 bits of a row's values; a null is told from every value and keeps its place."""
    return F.xxhash64(*[part for c in columns for part in (F.col(c), F.col(c).isNull())])


def signatures(rows: DataFrame, key, columns) -> DataFrame:
    """(key, SignedRows, SignedSum, SignedXor) over ``columns``; ``key`` may hold nulls, no rows give no keys."""
    return summed(rows.select(*key, row_hash(columns).alias("_hash")), key)


def summed(hashed: DataFrame, key) -> DataFrame:
    """Signatures of rows of which only the key and the hash (``_hash``) are left. The halves of the hashes are summed as whole numbers,
    which takes less time and room than a long decimal a row."""
    high, low = F.sum(F.shiftright("_hash", 32)), F.sum(F.col("_hash").bitwiseAND(F.lit(0xFFFFFFFF)))
    total = high.cast("decimal(20,0)") * F.lit(1 << 32).cast("decimal(10,0)") + low.cast("decimal(20,0)")
    return hashed.groupBy(*key).agg(F.count(F.lit(1)).alias("SignedRows"), total.cast("decimal(38,0)").alias("SignedSum"), F.bit_xor("_hash").alias("SignedXor"))


def added(signed_rows: DataFrame, key) -> DataFrame:
    """Signatures by a coarser ``key`` from those by a finer one."""
    return signed_rows.groupBy(*key).agg(
        F.sum("SignedRows").alias("SignedRows"), F.sum("SignedSum").cast("decimal(38,0)").alias("SignedSum"), F.bit_xor("SignedXor").alias("SignedXor")
    )


def by_parent(rows: DataFrame, by, columns) -> DataFrame:
    """Signatures of line-level ``rows`` by their parent's key: columns, or expressions with names."""
    return signatures(rows.selectExpr(*by, *columns), [b.split(" as ")[-1] for b in by], columns)


def signed(table: str, by, columns, s) -> DataFrame:
    """Signatures of the staged ``table`` by its parent's key, as staging published them or else computed; columns named after the table."""
    published = s.signatures(table) if hasattr(s, "signatures") else None
    found = by_parent(s[table], by, columns) if published is None else published
    return found.withColumnsRenamed({c: f"{table}{c}" for c in SIGNED})


def named(table: str) -> list[str]:
    return [f"{table}{c}" for c in SIGNED]


def compared(seen: DataFrame, now: DataFrame, key) -> DataFrame:
    """Every key of either side, and whether its signatures are the same on both (``_same``)."""
    before = seen.select(*key, F.struct(*SIGNED).alias("_seen"))
    after = now.select(*key, F.struct(*SIGNED).alias("_now"))
    return before.join(after, list(key), "full_outer").select(*key, F.expr("_seen <=> _now").alias("_same"))


def touched(seen: DataFrame, now: DataFrame, key) -> DataFrame:
    """The keys whose signatures differ or stand on one side only."""
    return compared(seen, now, key).where("not _same").select(*key)


def follow_rows(current: DataFrame, built: DataFrame, key, again: DataFrame | None = None) -> DataFrame:
    """The next state where no signatures of the inputs are at hand: the rows built from all sources are compared with the
    published ones by key. Keys in ``again`` count as changed."""
    columns = built.columns
    changed = touched(signatures(current, key, columns), signatures(built, key, columns), key)
    if again is not None:
        changed = changed.unionByName(again.select(*key)).distinct()
    return increment.replace_keys(current, built.join(changed, list(key), "left_semi").select(*columns), key, changed)


def in_months(day: str, months) -> Column:
    """``day`` lies in one of the ``months`` (first days), as ranges that reach the scan."""
    found, months = F.lit(False), sorted(months)
    while months:
        first = last = months.pop(0)
        while months and (months[0].year - last.year) * 12 + months[0].month - last.month == 1:
            last = months.pop(0)
        end = last.replace(year=last.year + last.month // 12, month=last.month % 12 + 1)
        found = found | ((F.col(day) >= F.lit(first)) & (F.col(day) < F.lit(end)))
    return found
