"""A training corpus from ``documents``: each stage works on what its predecessor kept, written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dockside.llm import decontaminate, pieces, secret_scan, simhash, toxicity
from dockside.llm.storage import Scratch


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network scores at one half or more go."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, model, keep_below=0.5)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the one with the smallest id."""
    return simhash.keep_one(spark, docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a test item go."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; what the scan finds in a text is masked in it."""
    return secret_scan.redact(spark, docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_pieces, pieces, lossless): every document as pieces that decode to its text."""
    return pieces.encode(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("secret_scans", redact_secrets),
    ("sentencepiece", encode_pieces),
]

ORACLE_SQL = None  # no stage can be stated in SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the result is the last stage's."""
    scratch, docs = Scratch(spark, "pipeline"), spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
    return docs
