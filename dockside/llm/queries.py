"""The registered queries of this subpackage: one per operator, over its whole table, and the SQL where SQL can state it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from dockside.llm import (
    decontaminate, html_text, licenses, line_dedup, log_bilinear, pieces, prefix_trie, quality_rules, secret_scan, simhash, spelling, token_counts, toxicity,
)
from dockside.llm.statements import QUALITY, SECRETS, SPELLING, TRIE
from dockside.llm.storage import Scratch


def _table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def op1_toxicity(spark: SparkSession, directory: str) -> DataFrame:
    docs = _table(spark, directory, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity.fit(docs, _table(spark, directory, "labels")))
    return scored.select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op2_sentencepiece_dropout(spark: SparkSession, directory: str) -> DataFrame:
    return pieces.encode(_table(spark, directory, "documents"), digest_only=True)


def op3_token_counts(spark: SparkSession, directory: str) -> DataFrame:
    """Three batches: every document, then without its repeated lines, then without copies; the first is sent twice."""
    docs, scratch = _table(spark, directory, "documents"), Scratch(spark, "tokens")
    rollups = token_counts.Rollups(spark, scratch.path("rollups"))
    rollups.apply("1-load", token_counts.counted(docs))
    rollups.apply("2-revise", token_counts.counted(token_counts.revised(docs)))
    rollups.apply("1-load", token_counts.counted(docs))
    rollups.apply("3-copies", deleted=token_counts.copies(docs, scratch))
    return rollups.totals()


def op4_secret_scans(spark: SparkSession, directory: str) -> DataFrame:
    found = secret_scan.scan(spark, _table(spark, directory, "documents"))
    of = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = secret_scan.listed(F.filter("found", lambda s: s["kind"].isin(*secret_scan.BASE)))
    return found.select(
        "doc_id", *map(of, secret_scan.BASE), F.sha2(base, 256).alias("base_sha256"), secret_scan.listed(F.col("found")).alias("spans")
    )


def op5_quality_rules(spark: SparkSession, directory: str) -> DataFrame:
    judged = quality_rules.judge(_table(spark, directory, "documents").select("doc_id", "text"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op6_simhash_near_dedup(spark: SparkSession, directory: str) -> DataFrame:
    found = simhash.near_duplicates(spark, _table(spark, directory, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id")
    )


def op7_license_scans(spark: SparkSession, directory: str) -> DataFrame:
    return licenses.scan(_table(spark, directory, "documents"), licenses.TEMPLATES + licenses.NOTICES)


def op8_substring_dedup(spark: SparkSession, directory: str) -> DataFrame:
    found = line_dedup.dedup(spark, _table(spark, directory, "documents"), lines=True)
    return found.select(
        "doc_id",
        "text",
        F.size("removed").cast("long").alias("n_removed"),
        F.aggregate("removed", F.lit(0), lambda n, s: n + s["stop"] - s["start"]).cast("long").alias("removed_chars"),
        F.array_join(F.transform("removed", lambda s: F.concat_ws(":", s["start"], s["stop"])), ",").alias("removed_spans"),
    )


def op9_benchmark_decontamination(spark: SparkSession, directory: str) -> DataFrame:
    return decontaminate.contaminated(_table(spark, directory, "documents"), _table(spark, directory, "benchmark"))


def op10_html_extraction(spark: SparkSession, directory: str) -> DataFrame:
    return html_text.extract(_table(spark, directory, "pages"))


def op11_spelling_variants(spark: SparkSession, directory: str) -> DataFrame:
    return spelling.variants(spark, _table(spark, directory, "documents"))


def op12_lm_scoring(spark: SparkSession, directory: str) -> DataFrame:
    return log_bilinear.score(spark, _table(spark, directory, "documents"))


def op13_conversation_trie(spark: SparkSession, directory: str) -> DataFrame:
    return prefix_trie.trie(spark, _table(spark, directory, "conversations"))


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_toxicity, op2_sentencepiece_dropout, op3_token_counts, op4_secret_scans, op5_quality_rules, op6_simhash_near_dedup, op7_license_scans,
        op8_substring_dedup, op9_benchmark_decontamination, op10_html_extraction, op11_spelling_variants, op12_lm_scoring,
        op13_conversation_trie,
    )
    return {f.__name__: f for f in found}


def statements() -> dict[str, str]:
    return {"op4_secret_scans": SECRETS, "op5_quality_rules": QUALITY, "op11_spelling_variants": SPELLING, "op13_conversation_trie": TRIE}
