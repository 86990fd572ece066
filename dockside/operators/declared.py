"""Declared column types: rows are cast to them, and every value that a column cannot hold is named with the reason.

A value is ``missing`` (null in a required column), ``unreadable`` (not of the type, or beyond its range), ``too long`` (for a
varchar) or ``inexact`` (digits or a time of day would be lost). Nothing is rounded, cut or nulled in silence: rows are either
conformed whole or refused with all their problems. Everything is an expression over one row, so a check costs no shuffle.
"""

from pyspark.sql import Column, DataFrame, functions as F, types as T

PROBLEMS = ("missing", "unreadable", "too long", "inexact")
_EXACT = T.DecimalType(38, 18)


def schema_of(declared: str | T.StructType) -> T.StructType:
    return T.StructType.fromDDL(declared) if isinstance(declared, str) else declared


def stored(field: T.StructField) -> T.DataType:
    """The type a column is kept in: a varchar is text whose length has been checked."""
    return T.StringType() if isinstance(field.dataType, (T.VarcharType, T.CharType)) else field.dataType


def typed(field: T.StructField) -> Column:
    """The column as its declared type, null where the value is not of it."""
    return F.col(f"`{field.name}`").try_cast(stored(field))


def problem(field: T.StructField) -> Column:
    """One of ``PROBLEMS``, or null where the declared column can hold the value."""
    value, cast = F.col(f"`{field.name}`"), typed(field)
    found = F.when(value.isNotNull() & cast.isNull(), F.lit("unreadable"))
    if isinstance(field.dataType, (T.VarcharType, T.CharType)):
        found = found.when(F.char_length(cast) > field.dataType.length, F.lit("too long"))
    elif isinstance(field.dataType, (T.IntegralType, T.DecimalType)):
        found = found.when(cast.cast(_EXACT) != value.try_cast(_EXACT), F.lit("inexact"))
    elif isinstance(field.dataType, T.DateType):
        found = found.when(cast.cast("timestamp_ntz") != value.try_cast("timestamp_ntz"), F.lit("inexact"))
    return found if field.nullable else F.when(value.isNull(), F.lit("missing")).otherwise(found)


def problems(schema: T.StructType) -> Column:
    """``Column: problem`` for each column that does not hold its value, in declared order."""
    named = [F.concat(F.lit(f"{f.name}: "), problem(f)) for f in schema.fields]
    return F.array_compact(F.array(*named)) if named else F.array().cast("array<string>")


def conformed(rows: DataFrame, declared: str | T.StructType, also=()) -> tuple[DataFrame, DataFrame]:
    """(rows as declared, refused rows as they came with ``Problems``). Columns that are not declared are left out, but for ``also``;
    a repeated row stays as often as it comes. Both parts read ``rows``; together they hold each row once."""
    schema = schema_of(declared)
    judged, others = rows.withColumn("Problems", problems(schema)), [F.col(f"`{c}`") for c in also]
    good = judged.where(F.size("Problems") == 0)
    return good.select(*[typed(f).alias(f.name) for f in schema.fields], *others), judged.where(F.size("Problems") > 0)


def report(rows: DataFrame, declared: str | T.StructType) -> DataFrame:
    """(ColumnName, DeclaredType, Missing, Unreadable, TooLong, Inexact): one row per declared column from one scan. A declared column that
    the table lacks counts as null in every row."""
    schema = schema_of(declared)
    absent = [f for f in schema.fields if f.name not in rows.columns]
    rows = rows.withColumns({f.name: F.lit(None).cast(stored(f)) for f in absent}) if absent else rows
    named = rows.select(*[problem(f).alias(f"p{i}") for i, f in enumerate(schema.fields)])
    counts = named.agg(*[F.count(F.when(F.col(f"p{i}") == p, 1)).alias(f"p{i}_{k}") for i in range(len(schema.fields)) for k, p in enumerate(PROBLEMS)])
    labels = ("Missing", "Unreadable", "TooLong", "Inexact")
    lines = [
        F.struct(
            F.lit(f.name).alias("ColumnName"), F.lit(f.dataType.simpleString()).alias("DeclaredType"),
            *[F.col(f"p{i}_{k}").alias(label) for k, label in enumerate(labels)],
        )
        for i, f in enumerate(schema.fields)
    ]
    return counts.select(F.inline(F.array(*lines)))


def enforced(rows: DataFrame, declared: str | T.StructType) -> DataFrame:
    """``rows`` with the declared columns in their types, the others as they are. The first value that its column cannot hold fails the job
    that reads the rows, so a load that writes them publishes nothing. Declared columns that ``rows`` lacks are left out."""
    fields = [f for f in schema_of(declared).fields if f.name in rows.columns]
    refuse = lambda f: F.raise_error(F.concat(F.lit(f"{f.name} is "), problem(f))).cast(stored(f))
    return rows.withColumns({f.name: F.when(problem(f).isNotNull(), refuse(f)).otherwise(typed(f)) for f in fields})
