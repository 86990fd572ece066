"""A trie of conversations: every distinct sequence of first turns is a node, with sums over its subtree by centroid decomposition.

Texts are read once, for a digest and a word count. A conversation of any length is numbered and its prefixes are keyed in
blocks: ranges of sorted turns get their offsets from the blocks before them, so no task needs a whole conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from dockside.llm.centroids import subtree_sums
from dockside.llm.storage import Scratch

WORD = r"[^\x20\x09-\x0D]+"
BLOCK = 4096  # turns, or members, that are put together at once
FAMILY, FORKS = 20, 4


def numbered(spark: SparkSession, turns: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv_id, pos, digest, words): turns in order, counted from 1; null turns first, equal ones by role and digest of the text.

    Null role and text become empty; rows without a conv_id belong to no conversation. Repeated rows are turns of their own.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    rows = turns.where("conv_id is not null").select(
        F.col("conv_id").cast("long"), "turn", role.alias("role"), digest.alias("digest"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("words")
    )
    rows = rows.withColumn("_tie", F.monotonically_increasing_id())  # equal rows may go to different ranges
    ranged = rows.repartitionByRange("conv_id", "turn", "role", "digest", "_tie").withColumn("_part", F.spark_partition_id())
    ranged = scratch.keep(ranged, "ranged")
    counts = ranged.groupBy("conv_id", "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("conv_id").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("conv_id", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("conv_id", "_part").orderBy("turn", "role", "digest")
    ranked = ranged.withColumn("_rank", F.row_number().over(inside))
    placed = ranked.join(offsets, ["conv_id", "_part"])
    return scratch.keep(placed.select("conv_id", (F.col("_offset") + F.col("_rank")).alias("pos"), "digest", "words"), "numbered")


def rebuilt(turns: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(rows, conversations): the first h turns of conversation c - c % 20, then c's own after its first h, with h the checksum of c modulo 4."""
    fork = F.crc32(F.col("conv_id").cast("string").cast("binary")) % FORKS
    lengths = scratch.keep(turns.groupBy("conv_id").agg(F.max("pos").alias("own")), "lengths")
    of = lengths.select("conv_id", "own", (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("_base"), fork.alias("fork"))
    bases = lengths.select(F.col("conv_id").alias("_base"), F.col("own").alias("_base_own"))
    of = of.join(bases, "_base", "left").withColumn("taken", F.least("fork", F.coalesce("_base_own", F.lit(0))))
    of = scratch.keep(of.select("conv_id", "_base", "fork", "taken", (F.col("taken") + F.greatest(F.col("own") - F.col("fork"), F.lit(0))).alias("length")), "forks")
    heads = turns.where(F.col("pos") < FORKS).select(F.col("conv_id").alias("_base"), F.col("pos").alias("depth"), "digest", "words")
    first = of.join(heads, "_base").where("depth <= taken").select("conv_id", "depth", "digest", "words")
    later = turns.join(of.select("conv_id", "fork", "taken"), "conv_id").where("pos > fork")
    later = later.select("conv_id", (F.col("pos") - F.col("fork") + F.col("taken")).alias("depth"), "digest", "words")
    return scratch.keep(first.unionByName(later), "rebuilt"), of.select("conv_id", "length")


def _mixed(*columns) -> list[Column]:
    """Two 64-bit hashes of a turn and its place; a prefix is the exclusive or of its turns' hashes."""
    return [F.xxhash64(F.lit(1), *columns).alias("a"), F.xxhash64(*columns, F.lit(2)).alias("b")]


def prefixes(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv_id, depth, words, a, b, ka, kb): each turn's own hashes and those of the sequence it ends."""
    hashed = rows.select("conv_id", "depth", "words", *_mixed("depth", "digest")).withColumn("_block", F.expr(f"(depth - 1) div {BLOCK}"))
    hashed = scratch.keep(hashed, "hashed")
    sums = hashed.groupBy("conv_id", "_block").agg(F.bit_xor("a").alias("_a"), F.bit_xor("b").alias("_b"))
    before = Window.partitionBy("conv_id").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    offsets = sums.select("conv_id", "_block", *[F.coalesce(F.bit_xor(f"_{c}").over(before), zero).alias(f"_{c}") for c in "ab"])
    inside = Window.partitionBy("conv_id", "_block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    running = hashed.select("*", *[F.bit_xor(c).over(inside).alias(f"_k{c}") for c in "ab"])
    joined = running.join(offsets, ["conv_id", "_block"])
    return joined.select("conv_id", "depth", "words", "a", "b", *[F.col(f"_k{c}").bitwiseXOR(F.col(f"_{c}")).alias(f"k{c}") for c in "ab"])


def _digests(members: DataFrame) -> DataFrame:
    """(id, ends_sha256) of (id, conv_id): members are put together in blocks of neighbouring ids, then hashed as they stream by."""
    blocks = members.groupBy("id", F.floor(F.col("conv_id") / BLOCK).alias("block")).agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
    texts = blocks.select("id", "block", F.array_join(F.transform("ids", lambda x: x.cast("string")), ",").alias("text"))
    return texts.repartition("id").sortWithinPartitions("id", "block").mapInArrow(_hashed, "id long, ends_sha256 string")


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, state = None, None
    for batch in batches:
        ids, found = [], []
        for node, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
            if node != now:
                if state is not None:
                    ids.append(now)
                    found.append(state.hexdigest())
                now, state = node, hashlib.sha256(text.encode())
            else:
                state.update(f",{text}".encode())
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(found, pa.string())], ["id", "ends_sha256"])
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([state.hexdigest()])], ["id", "ends_sha256"])


def trie(spark: SparkSession, conversations: DataFrame, **options) -> DataFrame:
    """One row per node: (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256).

    Members are the rebuilt conversations that start with the node's turns, those without turns are members of the root
    alone. ``options`` go to ``subtree_sums``. A table without conversations gives no rows.
    """
    scratch = Scratch(spark, "trie")
    turns = numbered(spark, conversations, scratch)
    rows, convs = rebuilt(turns, scratch)
    keyed = scratch.keep(prefixes(rows, scratch), "keyed")
    grouped = keyed.groupBy("depth", "ka", "kb").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("words").alias("words"),
        F.min(F.col("ka").bitwiseXOR(F.col("a"))).alias("pa"), F.min(F.col("kb").bitwiseXOR(F.col("b"))).alias("pb"),
    )
    zero = F.lit(0).cast("long")
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0")
    root = root.select(zero.alias("depth"), zero.alias("ka"), zero.alias("kb"), "conv_id", "n_convs", zero.alias("words"), zero.alias("pa"), zero.alias("pb"))
    nodes = scratch.keep(grouped.withColumn("depth", F.col("depth").cast("long")).unionByName(root).withColumn("id", F.monotonically_increasing_id()), "nodes")

    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("ka").alias("pa"), F.col("kb").alias("pb"), F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    linked = scratch.keep(nodes.join(above, ["depth", "pa", "pb"], "left"), "linked")
    children = linked.where("parent is not null").groupBy(F.col("parent").alias("id")).agg(F.count(F.lit(1)).alias("n_children"))
    linked = scratch.keep(linked.join(children, "id", "left").withColumn("n_children", F.coalesce("n_children", zero)), "counted")
    own = linked.select("id", "parent", (F.col("n_children") == 0).cast("long").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens"))
    sums = subtree_sums(own, ["n_leaves", "saved_tokens"], scratch, **options)

    last = convs.select("conv_id", F.col("length").alias("depth"))
    at = keyed.select("conv_id", "depth", "ka", "kb").join(last, ["conv_id", "depth"]).unionByName(
        last.where("depth = 0").select("conv_id", "depth", zero.alias("ka"), zero.alias("kb"))
    )
    ends = _digests(at.join(nodes.select("depth", "ka", "kb", "id"), ["depth", "ka", "kb"]).select("id", "conv_id"))
    found = linked.select("id", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children").join(sums, "id").join(ends, "id", "left")
    none = F.sha2(F.lit("").cast("binary"), 256)
    return found.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", none).alias("ends_sha256"))
