"""Compare a Spark result with a DuckDB result: same columns, same rows in any order."""

import datetime as dt
from decimal import Decimal


def plain(value):
    if isinstance(value, Decimal):
        return format(value.normalize(), "f") if value else "0"
    if isinstance(value, float):
        return repr(round(value, 6))
    if isinstance(value, bool):
        return str(int(value))
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in rows)


def difference(spark_df, cursor):
    """None if equal, else a short description."""
    expected = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    actual = rows_of(spark_df.columns, spark_df.collect())
    if actual[0] != expected[0]:
        return f"columns {actual[0]} != {expected[0]}"
    if len(actual[1]) != len(expected[1]):
        return f"{len(actual[1])} rows != {len(expected[1])} rows"
    for a, e in zip(actual[1], expected[1]):
        if a != e:
            return f"first difference:\n  spark  {dict(zip(actual[0], a))}\n  oracle {dict(zip(actual[0], e))}"
    return None
