"""Do two copies of a table agree? Order-free digests by key bucket on both sides, then a look into the buckets that differ."""

from pyspark.sql import DataFrame, functions as F

from dockside.operators.signature import SIGNED, signatures, touched

BUCKETS = 1024


def _sides(source: DataFrame, staged: DataFrame, key, ignore):
    """Both sides with the columns they share, in the staged types, under the key's bucket."""
    kinds = {f.name: f.dataType for f in staged.schema.fields}
    columns = [c for c in source.columns if c in kinds and c not in ignore]
    sides = [t.select(*[F.col(c).cast(kinds[c]).alias(c) for c in columns]) for t in (source, staged)]
    return columns, *[t.withColumn("_bucket", F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in key]), F.lit(BUCKETS)).cast("int")) for t in sides]


def bucket_differences(source: DataFrame, staged: DataFrame, key, ignore=()) -> DataFrame:
    """The buckets whose rows differ: one aggregate over each side, met over at most ``BUCKETS`` rows."""
    columns, *sides = _sides(source, staged, key, ignore)
    before, after = (signatures(t, ["_bucket"], columns) for t in sides)
    return touched(before, after, ["_bucket"])


def reconcile(source: DataFrame, staged: DataFrame, key, ignore=()) -> DataFrame:
    """(key, Difference, SourceRows, StagedRows): keys missing on a side, or on both with other rows. Only the buckets that differ
    are compared by key; repeated rows count, and columns of one side alone or in ``ignore`` do not."""
    key = list(key)
    columns, *sides = _sides(source, staged, key, ignore)
    buckets = [r[0] for r in bucket_differences(source, staged, key, ignore).collect()]  # BUCKETS at most
    before, after = (signatures(t.where(F.col("_bucket").isin(buckets)), key, columns) for t in sides)
    left = before.select(*[F.col(k).alias(f"_l_{k}") for k in key], F.struct(*SIGNED).alias("_l"), F.lit(True).alias("_left"))
    right = after.select(*[F.col(k).alias(f"_r_{k}") for k in key], F.struct(*SIGNED).alias("_r"), F.lit(True).alias("_right"))
    same = F.lit(True)
    for k in key:
        same = same & F.col(f"_l_{k}").eqNullSafe(F.col(f"_r_{k}"))
    met = left.join(right, same, "full_outer").where("not (_l <=> _r)")
    kind = F.when(F.col("_right").isNull(), "missing in staging").when(F.col("_left").isNull(), "not at the source").otherwise("different")
    zero = F.lit(0).cast("bigint")
    return met.select(
        *[F.coalesce(f"_l_{k}", f"_r_{k}").alias(k) for k in key], kind.alias("Difference"),
        F.coalesce("_l.SignedRows", zero).alias("SourceRows"), F.coalesce("_r.SignedRows", zero).alias("StagedRows"),
    )
