"""Missing-value and change tests used by validation and by the dimension updates."""

from functools import reduce
from operator import or_

from pyspark.sql import Column, functions as F


def missing(column: str, blank_is_missing: bool = False) -> Column:
    test = F.col(column).isNull()
    return test | (F.trim(F.col(column)) == "") if blank_is_missing else test


def any_of(conditions) -> Column:
    return reduce(or_, conditions, F.lit(False))


def any_differs(pairs, null_equals_blank: bool = False) -> str:
    """SQL test: some (old, new) pair differs, null-safe; optionally NULL and '' count as the same value."""
    if null_equals_blank:
        tests = [f"coalesce(string({old}), '') <> coalesce(string({new}), '')" for old, new in pairs]
    else:
        tests = [f"not ({old} <=> {new})" for old, new in pairs]
    return " or ".join(tests) or "false"
