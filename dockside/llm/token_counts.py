"""Token counts by source, language and tokenizer version, as totals that signed deltas keep up to date.

A batch holds new or revised documents and deletions. What the ledger holds for their keys is taken off (sign -1) and what
they count now is added (sign +1); both go into the batch's own folder, summed to one delta per group. Totals are the sum of
the committed batches' deltas: no batch reads the documents of another. A batch is committed by one row in the table of
commits, after its folders are written. A batch that is already there is not applied again, and one that failed before its
row writes the same folders anew. One writer at a time.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Callable, Iterator

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession, functions as F

from dockside.llm.storage import Scratch, small_batches, text_slices

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: How the vocabulary's texts fall into words before merging: a fixed value that belongs to the vocabulary.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
GROUP = ("source", "lang", "tokenizer")


@functools.lru_cache(maxsize=2)
def byte_bpe(path: str) -> tiktoken.Encoding:
    """The vocabulary, once in each worker process. The file must be readable by every executor."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("byte_bpe", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})


def _bpe_counts(texts: pa.Array, path: str) -> pa.Array:
    encode = byte_bpe(path).encode_ordinary
    return pa.array([len(encode(t)) if t else 0 for t in texts.to_pylist()], pa.int64())


def _word_counts(texts: pa.Array) -> pa.Array:
    return pa.array([len(t.split()) if t else 0 for t in texts.to_pylist()], pa.int64())


#: Tokenizer versions; a change of what one counts takes a new name.
TOKENIZERS: dict[str, Callable[[pa.Array], pa.Array]] = {
    "byte_bpe_50k-1": functools.partial(_bpe_counts, path=VOCABULARY),
    "words-1": _word_counts,
}


def key_of() -> F.Column:
    """A document's key: its id, or the digest of its text where it has none."""
    return F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text:"), F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)))


def counted(docs: DataFrame, tokenizers: dict[str, Callable] = TOKENIZERS) -> DataFrame:
    """(key, source, lang, tokenizer, n_tokens): one row per row of ``docs`` and tokenizer; null and empty texts count 0."""
    source = docs.select(key_of().alias("key"), F.col("source").cast("string"), F.col("lang").cast("string"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                for name, count in tokenizers.items():
                    version = pa.array([name] * part.num_rows)
                    yield pa.RecordBatch.from_arrays([*part.columns[:3], version, count(part.column("text"))], ["key", *GROUP, "n_tokens"])

    return small_batches(source).mapInArrow(run, "key string, source string, lang string, tokenizer string, n_tokens long")


class Rollups:
    """Entries by document, deltas by group, and commits, as Parquet below ``root`` in a folder that all executors share."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        spark.createDataFrame([], "batch string").write.mode("ignore").parquet(f"{self.root}/commits")

    def batches(self) -> list[str]:
        """Names of the committed batches."""
        return sorted(r.batch for r in self.spark.read.schema("batch string").parquet(f"{self.root}/commits").distinct().collect())

    def _read(self, what: str, schema: str) -> DataFrame:
        paths = [f"{self.root}/{what}/{b}" for b in self.batches()]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def entries(self) -> DataFrame:
        """What each key counts now, by tokenizer."""
        signed = self._read("entries", "key string, source string, lang string, tokenizer string, n_docs long, n_tokens long")
        return signed.groupBy("key", *GROUP).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")).where("n_docs != 0")

    def totals(self) -> DataFrame:
        """Documents, tokens and signed entries of each group, groups that deletions have emptied included."""
        deltas = self._read("deltas", "source string, lang string, tokenizer string, n_docs long, n_tokens long, n_entries long")
        return deltas.groupBy(*GROUP).agg(*[F.sum(c).alias(c) for c in ("n_docs", "n_tokens", "n_entries")])

    def apply(self, batch: str, counts: DataFrame | None = None, deleted: DataFrame | None = None) -> bool:
        """Commit ``counts`` (see ``counted``) of new and revised documents and the keys of ``deleted(key)``; False if done before.

        Of several rows with one key and tokenizer the one with the most tokens counts (then the last source, the last
        language). A key that is deleted and counted in one batch is counted. Unknown deleted keys have no effect.
        """
        if batch in self.batches():
            return False
        former = self.entries().select("key", *GROUP, (-F.col("n_docs")).alias("n_docs"), (-F.col("n_tokens")).alias("n_tokens"))
        parts, off = [former.where("false")], None
        if deleted is not None:
            off = deleted.select("key").distinct()
            parts.append(former.join(off, "key", "left_semi"))
        if counts is not None:
            order = F.struct("n_tokens", F.coalesce("source", F.lit("")).alias("s"), F.coalesce("lang", F.lit("")).alias("l"), "source", "lang")
            latest = counts.groupBy("key", "tokenizer").agg(F.max(order).alias("m"))
            latest.write.mode("overwrite").parquet(f"{self.root}/counts/{batch}")  # used twice, counted once
            latest = self.spark.read.schema(latest.schema).parquet(f"{self.root}/counts/{batch}")
            parts.append(latest.select("key", "m.source", "m.lang", "tokenizer", F.lit(1).cast("long").alias("n_docs"), "m.n_tokens"))
            again = former.join(latest, ["key", "tokenizer"], "left_semi")
            parts.append(again if off is None else again.join(off, "key", "left_anti"))
        signed = functools.reduce(DataFrame.unionByName, parts)
        net = signed.groupBy("key", *GROUP).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        net.where("n_docs != 0 or n_tokens != 0").write.mode("overwrite").parquet(f"{self.root}/entries/{batch}")
        written = self.spark.read.parquet(f"{self.root}/entries/{batch}")
        delta = written.groupBy(*GROUP).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"), F.count("*").alias("n_entries"))
        delta.write.mode("overwrite").parquet(f"{self.root}/deltas/{batch}")
        self.spark.createDataFrame([(batch,)], "batch string").coalesce(1).write.mode("append").parquet(f"{self.root}/commits")
        return True


def copies(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """(key): documents whose text a document with a smaller id has; null texts and ids are no copies."""
    named = docs.where("doc_id is not null and text is not null").select("doc_id", F.sha2("text", 256).alias("digest"))
    # a table of its own: joined straight after the aggregate, the copies of one text could not be split among tasks
    first = scratch.keep(named.groupBy("digest").agg(F.min("doc_id").alias("first")), "first")
    later = named.join(first, "digest").where("doc_id > first")
    return later.select(F.col("doc_id").cast("string").alias("key")).distinct()


def revised(docs: DataFrame) -> DataFrame:
    """The documents that have a line twice, with each line's first occurrence only."""
    lines = F.split("text", "\n", -1)
    return docs.withColumn("text", F.array_join(F.array_distinct(lines), "\n")).where(F.col("text") != docs["text"])
