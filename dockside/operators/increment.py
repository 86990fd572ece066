"""How a fact table takes in new data. Each returns the next state plus ``ChangeType``."""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from dockside.operators.scd import CHANGE


def _tag(rows: DataFrame, change: str) -> DataFrame:
    return rows.withColumn(CHANGE, F.lit(change))


def unseen(current: DataFrame, built: DataFrame, keys) -> DataFrame:
    """Built rows not loaded yet, recognised by ``keys``; keys are non-null (see ``key_lookup(unknown=True)``)."""
    return built.join(current.select(*keys), list(keys), "left_anti").select(*built.columns)


def unmarked(rows: DataFrame, keys, mark: str) -> DataFrame:
    """The rows without ``mark`` whose ``keys`` no marked row has, as ``unseen`` finds them (a null equals nothing). Both kinds come in one
    frame: where that is shuffled by some of the keys already, it is not shuffled again."""
    marked = F.max(mark).over(Window.partitionBy(*keys))
    filled = reduce(Column.__and__, [F.col(c).isNotNull() for c in keys])
    rows = rows.withColumn("_marked", marked)
    return rows.where(F.col(mark).isNull() & ~(filled & F.col("_marked").isNotNull())).drop("_marked")


def unloaded(staged: DataFrame, current: DataFrame, source_id: str, loaded_as: str) -> DataFrame:
    """Staged rows whose source id no fact row carries. Filtering before the fact is built means the dimension
    lookups only ever see new rows."""
    loaded = current.select(F.col(loaded_as).alias(source_id))
    return staged.join(loaded, source_id, "left_anti")


def append_unseen(current: DataFrame, built: DataFrame, keys) -> DataFrame:
    return _tag(current, "kept").unionByName(_tag(unseen(current, built, keys), "inserted"))


def in_window(rows: DataFrame, day: str, last_load, run_date) -> DataFrame:
    """Rows dated after the last load and up to the run date: ``(last_load, run_date]``."""
    return rows.where((F.col(day) > F.lit(last_load).cast("date")) & (F.col(day) <= F.lit(run_date).cast("date")))


def append(current: DataFrame, built: DataFrame) -> DataFrame:
    return _tag(current, "kept").unionByName(_tag(built, "inserted"))


def open_or_unseen(staged: DataFrame, day, key: str, current: DataFrame, loaded_day: str, again: DataFrame | None = None) -> DataFrame:
    """Staged rows of the latest day already loaded or a later one, and older ones whose ``key`` is not loaded or in ``again``."""
    latest = current.agg(F.coalesce(F.max(loaded_day), F.lit("0001-01-01").cast("date"))).scalar()
    loaded = current.select(F.col(key).alias("_loaded")).distinct()
    if again is not None:
        loaded = loaded.join(again.select(F.col(key).alias("_loaded")), "_loaded", "left_anti")
    marked = staged.join(loaded, staged[key] == F.col("_loaded"), "left")
    return marked.where((day >= latest) | F.col("_loaded").isNull()).select(*staged.columns)


def replace_keys(current: DataFrame, built: DataFrame, keys, gone: DataFrame) -> DataFrame:
    """Rows of ``current`` whose ``keys`` stand in ``gone`` give way to the built rows; the others are kept."""
    kept = current.join(gone.select(*keys).distinct(), list(keys), "left_anti").select(*current.columns)
    return _tag(kept, "kept").unionByName(_tag(built, "inserted"))


def replace_period(current: DataFrame, built: DataFrame, key: str, period: DataFrame) -> DataFrame:
    """Put the rebuilt period in the place of the rows whose ``key`` is among the period's day keys. Without a day of the
    calendar in the period nothing is dropped; the keys need not be in the order of the days."""
    return replace_keys(current, built, [key], period)


def merge(current: DataFrame, built: DataFrame, keys, updates) -> DataFrame:
    """Full-outer merge on unique ``keys``: matched rows take ``updates`` from the built side, new rows come in whole."""
    keys = list(keys)
    old = current.select(*[F.col(c).alias(f"_o_{c}") for c in current.columns], F.lit(True).alias("_old"))
    new = built.select(*[F.col(c).alias(f"_n_{c}") for c in built.columns], F.lit(True).alias("_new"))
    joined = old.join(new, [F.col(f"_o_{k}") == F.col(f"_n_{k}") for k in keys], "full_outer")
    both = F.col("_old").isNotNull() & F.col("_new").isNotNull()
    differing = F.lit(False)
    for c in updates:
        differing = differing | ~F.col(f"_o_{c}").eqNullSafe(F.col(f"_n_{c}"))

    def column(c):
        if c in updates:
            return F.when(F.col("_new").isNotNull(), F.col(f"_n_{c}")).otherwise(F.col(f"_o_{c}")).alias(c)
        return F.when(F.col("_old").isNotNull(), F.col(f"_o_{c}")).otherwise(F.col(f"_n_{c}")).alias(c)

    change = F.when(F.col("_old").isNull(), "inserted").when(both & differing, "updated").otherwise("kept")
    return joined.select(*[column(c) for c in current.columns], change.alias(CHANGE))


def rebuild(built: DataFrame) -> DataFrame:
    return _tag(built, "inserted")
