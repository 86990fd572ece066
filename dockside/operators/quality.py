"""Data-quality checks. Each returns a DataFrame; ``enforce`` is the only place that runs one."""

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T

from dockside.functions.compare import any_of, missing


class ValidationError(ValueError):
    """A load was refused; ``failures`` holds (check, columns, rows)."""

    def __init__(self, table: str, failures):
        self.table, self.failures = table, failures
        details = "; ".join(f"{check} in {columns}: {rows} rows" for check, columns, rows in failures)
        super().__init__(f"Validation failed for {table}: {details}")


def missing_values(rows: DataFrame, required, non_blank=()) -> DataFrame:
    """One scan: total rows, rows with any required value missing, and the count per column."""
    checks = [("missing", c, missing(c, c in non_blank)) for c in required]
    checks.append(("missing_any", ",".join(required), any_of(test for _, _, test in checks)))
    counts = rows.agg(
        F.count(F.lit(1)).alias("_total"),
        *[F.count(F.when(test, 1)).alias(f"_c{i}") for i, (_, _, test) in enumerate(checks)],
    )
    entries = [F.struct(F.lit("rows").alias("CheckName"), F.lit("*").alias("Columns"), F.col("_total").alias("Rows"))]
    entries += [
        F.struct(F.lit(name).alias("CheckName"), F.lit(columns).alias("Columns"), F.col(f"_c{i}").alias("Rows"))
        for i, (name, columns, _) in enumerate(checks)
    ]
    return counts.select(F.inline(F.array(*entries)))


def repeated_keys(rows: DataFrame, key) -> DataFrame:
    """The business keys that occur more than once, with how often."""
    return rows.groupBy(*key).agg(F.count(F.lit(1)).alias("Occurrences")).where("Occurrences > 1")


def duplicate_count(rows: DataFrame, key) -> DataFrame:
    """Number of business keys that repeat, as one report row."""
    return repeated_keys(rows, key).agg(F.count(F.lit(1)).alias("Rows")).select(
        F.lit("duplicate_keys").alias("CheckName"), F.lit(",".join(key)).alias("Columns"), "Rows"
    )


def validation_report(rows: DataFrame, key, required, non_blank=()) -> DataFrame:
    return missing_values(rows, required, non_blank).unionByName(duplicate_count(rows, key))


@dataclass(frozen=True)
class Checks:
    """The checks of ``validation_report`` for rows that are written anyway: missing values are counted by the write itself, and only the
    key columns of what it wrote are read again, to look for repeats."""

    key: tuple
    required: tuple
    non_blank: tuple = ()

    def counted(self):
        """Aggregates to observe while the rows pass by."""
        missed = [F.count(F.when(missing(c, c in self.non_blank), 1)).alias(f"missing_{c}") for c in self.required]
        return [F.count(F.lit(1)).alias("rows"), *missed]

    def failures(self, counts: dict, written: DataFrame) -> list[tuple]:
        """(check, columns, rows) of the checks that found something; repeats are looked for only among rows without missing values."""
        found = [("missing", c, counts.get(f"missing_{c}", 0)) for c in self.required]
        if self.key and not any(n for _, _, n in found):
            found += [tuple(r) for r in duplicate_count(written, self.key).collect()]
        return [f for f in found if f[2]]


def orphans(rows: DataFrame, parent: DataFrame, column: str, parent_column: str | None = None) -> DataFrame:
    """Rows whose foreign key is set but has no parent."""
    parents = parent.select(F.col(parent_column or column).alias(column))
    return rows.where(F.col(column).isNotNull()).join(parents, column, "left_anti")


def referential_report(links, tables) -> DataFrame:
    """(ForeignKey, Orphans, OrphanValues) for every link (child, column, parent, parent column): child rows whose key is set but has
    no parent. Each link reads its two columns and sums both sides by value in one shuffle of its own, whole numbers as such, so that
    a task holds the values of one link only. A key of -1 is the unknown member and counts as not set."""
    parts = []
    for child, column, parent, parent_column in links:
        sides = [tables[child].select(F.col(column).alias("Value")), tables[parent].select(F.col(parent_column).alias("Value"))]
        whole = all(isinstance(side.schema["Value"].dataType, T.IntegralType) for side in sides)
        keys, known = [side.select(F.col("Value").cast("bigint" if whole else "string")).where("Value is not null") for side in sides]
        keys = keys.where(F.col("Value") != F.lit(-1 if whole else "-1")).select("Value", F.lit(1).cast("bigint").alias("n"), F.lit(False).alias("known"))
        met = keys.unionByName(known.select("Value", F.lit(0).cast("bigint").alias("n"), F.lit(True).alias("known")))
        met = met.groupBy("Value").agg(F.sum("n").alias("n"), F.max("known").alias("known"))
        lost = F.when(~F.col("known"), F.col("n"))
        name = F.lit(f"{child}.{column}").alias("ForeignKey")  # a group, so that a link without values gives no row
        parts.append(met.groupBy(name).agg(F.coalesce(F.sum(lost), F.lit(0)).alias("Orphans"), F.count(lost).alias("OrphanValues")))
    return reduce(DataFrame.unionByName, parts)


def enforce(table: str, report: DataFrame) -> int:
    """Run a report (a handful of rows) and refuse the load if any check found something; gives the row count."""
    found = {(r.CheckName, r.Columns): r.Rows for r in report.collect()}
    failures = [(c, cols, n) for (c, cols), n in found.items() if n and c not in ("rows", "missing_any")]
    if failures:
        raise ValidationError(table, failures)
    return found.get(("rows", "*"), 0)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table with its row count."""
    counts = [df.agg(F.count(F.lit(1)).alias("RowCount")).select(F.lit(name).alias("TableName"), "RowCount") for name, df in tables.items()]
    result = counts[0]
    for other in counts[1:]:
        result = result.unionByName(other)
    return result
