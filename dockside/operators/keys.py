"""Surrogate keys: unique, stable across runs, and independent of how Spark partitions the rows.

Rows are spread over 4096 buckets by a digest of their business key. Bucket ``b`` owns the numbers ``b + 1``,
``b + 1 + 4096``, ``b + 1 + 2 * 4096``, ... above the highest key in use, and hands them out in digest order. Each
bucket numbers its own rows, so there is no global counter, no second pass over the rows and no window over more
than a sliver of them, whatever the distribution of the keys. The price is that keys are not gap-free, as with an
identity column. A recomputed task or another partition count gives the same keys.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

UNKNOWN_KEY = -1
BUCKETS = 4096
_DIGITS = 3  # hexadecimal digits that make 4096


def digest_sql(business_key) -> str:
    return "md5(concat_ws('|', " + ", ".join(f"coalesce(string({c}), '')" for c in business_key) + "))"


BUCKET_SQL = f"cast(conv(substring(_digest, 1, {_DIGITS}), 16, 10) as bigint)"


def with_bucket(rows: DataFrame, business_key) -> DataFrame:
    return rows.selectExpr("*", f"{digest_sql(business_key)} as _digest", f"{BUCKET_SQL} as _bucket")


def bucket_order(*columns):
    return Window.partitionBy("_bucket").orderBy("_digest", *columns)


def interleaved(after, rank) -> Column:
    """The ``rank``-th number of the row's bucket above ``after``."""
    return (after + (rank - 1) * BUCKETS + F.col("_bucket") + 1).cast("bigint")


def assign_keys(rows: DataFrame, business_key, key: str, after: Column | int = 0) -> DataFrame:
    """Key every row; ``business_key`` must be unique in ``rows``."""
    after = F.lit(after) if isinstance(after, int) else after
    rank = F.row_number().over(bucket_order(*business_key))
    return with_bucket(rows, business_key).select(interleaved(after, rank).alias(key), *rows.columns)


def assign_dense_keys(rows: DataFrame, business_key, key: str, after: Column | int = 0) -> DataFrame:
    """Gap-free numbers in digest order, for one more pass over the business keys to count each bucket."""
    after = F.lit(after) if isinstance(after, int) else after
    bucketed = with_bucket(rows, business_key)
    earlier = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = bucketed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select("_bucket", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    ranked = bucketed.withColumn("_rank", F.row_number().over(bucket_order(*business_key)))
    # offsets has at most 4096 rows by construction
    placed = ranked.join(F.broadcast(offsets), "_bucket")
    return placed.select((after + F.col("_offset") + F.col("_rank")).cast("bigint").alias(key), *rows.columns)


def highest_key(table: DataFrame, key: str) -> Column:
    """Largest key in use (0 for an empty table), as a scalar subquery of the surrounding plan."""
    return table.agg(F.greatest(F.coalesce(F.max(key), F.lit(0)), F.lit(0))).scalar()


def with_unknown(table: DataFrame, key: str, values: dict) -> DataFrame:
    """Add the unknown member (key -1); columns not named in ``values`` are NULL."""
    row = {key: UNKNOWN_KEY, **values}
    columns = [
        (F.lit(row[f.name]) if f.name in row else F.lit(None)).cast(f.dataType).alias(f.name) for f in table.schema.fields
    ]
    return table.sparkSession.range(1).select(*columns).unionByName(table)
