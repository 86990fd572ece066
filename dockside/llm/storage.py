"""Working tables in the folder all executors share, and bounded slices of Arrow batches."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


class Scratch:
    """A folder of its own below ``spark.checkpoint.dir`` for tables that cut a lineage.

    Where the setting is absent (tests on one machine), a temporary folder takes its place. Tables are left there: the
    DataFrames an operator returns read them, so only the caller knows when they may go.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        root = spark.conf.get("spark.checkpoint.dir", None) or f"file://{os.path.join(tempfile.gettempdir(), 'dockside')}"
        self.root = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` as a table and read it back: later uses neither recompute it nor need an executor's own disk."""
        df.write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))


BATCH_ROWS = 1024


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, with batches of at most ``BATCH_ROWS`` rows between Spark and Python in its session.

    The default of 10,000 rows suits numbers; as whole texts, such a batch takes more memory than the work on it.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(df.sparkSession.conf.get(name)) <= BATCH_ROWS:
        df.sparkSession.conf.set(name, str(BATCH_ROWS))
    return df


def text_slices(batch: pa.RecordBatch, column: str, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose texts take about ``limit`` bytes together; a longer text makes a slice of its own, whole."""
    if not batch.num_rows:
        return
    ends = np.cumsum(byte_lengths(batch.column(column)))
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def byte_lengths(texts: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
