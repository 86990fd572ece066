"""Folders that all executors see, for files a job writes and reads again."""

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path below ``spark.checkpoint.dir``. Where that is unset, a temporary folder takes its place on one machine; on a cluster,
    whose executors would not see it, the call is refused."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = f"file://{os.path.join(tempfile.gettempdir(), 'dockside')}"
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` written once to a shared folder and read from there: whatever uses them several times does their work once, and the
    size of a small table is known to the joins that follow."""
    path = shared_folder(rows.sparkSession, name)
    rows.write.parquet(path, compression="zstd")
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
