"""Ordered reports: the first rows of a table, and of each of its keys, without sorting the rest."""

from pyspark.sql import DataFrame, Window, functions as F


def top_rows(rows: DataFrame, n: int, *order) -> DataFrame:
    """The first ``n`` rows in ``order``; every task passes on ``n`` rows at most."""
    return rows.orderBy(*order).limit(n)


def top_by(rows: DataFrame, key, n: int, *order) -> DataFrame:
    """The first ``n`` rows of each key, with ``Position``; Spark limits a key's rows in each task before they are shuffled."""
    place = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return rows.withColumn("Position", place).where(F.col("Position") <= n)
