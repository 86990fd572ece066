"""SimHash near duplicates by covering locality-sensitive hashing.

``covering_masks`` gives 2^(radius+1)-1 masks with the property that for any ``radius`` positions one mask leaves all of
them out. Two fingerprints that differ in at most ``radius`` bits therefore agree under some mask: they meet in that
mask's table, and no pair is missed. The tables are grouped, not joined with themselves:

* a group of two is its smallest and its largest fingerprint; nothing is collected;
* a group of up to ``GROUP_LIMIT`` fingerprints is searched as one array;
* a larger group is divided again by covering masks over the bits that its mask left free. Members then agree in about
  48 of 64 bits, so that a group has 2^17 members at most whatever the input.

A group gives a spanning forest of its links, never all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from dockside.llm.components import roots
from dockside.llm.storage import Scratch, small_batches

SEED, SHINGLE, RADIUS, BITS = 42, 4, 4, 64
GROUP_LIMIT = 2048
_STEP = 1 << 16  # shingles whose bits are counted at once


def shingle_hashes(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """XXH64 of every ``shingle``-word run: A-Z lowered, words between ASCII white space, joined by one space."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined, ends = b" ".join(words), np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    if len(words) <= shingle:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    starts = np.concatenate(([0], ends))[: len(words) - shingle + 1].tolist()
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[s:e], SEED) for s, e in zip(starts, (ends[shingle - 1 :] - 1).tolist())], np.uint64)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The bits set in over half of the shingles' hashes, repeats counted; 0 for a text without words."""
    hashes = shingle_hashes(text, shingle)
    counts = np.zeros(BITS, np.int64)
    for start in range(0, len(hashes), _STEP):
        part = hashes[start : start + _STEP].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(id, digest, fp): one row per row of ``docs``; fp is the fingerprint as a signed long, digest the text's MD5."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.fromiter((fingerprint(t.as_py(), shingle) for t in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(values.view(np.int64))], ["id", "digest", "fp"])

    text = F.col(text_col).cast("string")
    source = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("t"), digest_of(text).alias("digest"))
    return small_batches(source).mapInArrow(run, "id long, digest binary, fp long")


def digest_of(text: Column) -> Column:
    """16 bytes of a text; null has none."""
    return F.unhex(F.md5(text.cast("binary")))


def covering_masks(bits: list[int], radius: int = RADIUS) -> list[int]:
    """Masks over the positions ``bits``: for any ``radius`` of them one mask leaves all of them out.

    Position i gets a vector of radius+1 bits, mask v the positions whose vector has odd parity with v. ``radius``
    vectors span too little to leave no v at right angles to all of them.
    """
    size = (1 << (radius + 1)) - 1
    return [sum(1 << b for i, b in enumerate(bits) if ((i % size + 1) & v).bit_count() % 2) for v in range(1, size + 1)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def spanning_links(values: np.ndarray, radius: int = RADIUS) -> list[tuple[int, int]]:
    """A spanning forest of the links (at most ``radius`` differing bits) among distinct fingerprints."""
    left, links = np.sort(values), []
    while len(left):
        root, left = left[0], left[1:]
        frontier = [root]
        while frontier and len(left):
            near = np.bitwise_count(left ^ frontier.pop()) <= radius
            if near.any():
                found, left = left[near], left[~near]
                frontier += list(found)
                links += [(int(root), int(x)) for x in found]
    return links


def _links_of_groups(groups: DataFrame, radius: int):
    """The links in groups of two, from their ends; what finds those in larger ones, from their members."""
    pairs = groups.where("n = 2 and bit_count(low ^ high) <= " + str(radius)).select(F.col("low").alias("a"), F.col("high").alias("b"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            links = [x for members in frame["members"] for x in spanning_links(np.asarray(members, np.int64).view(np.uint64), radius)]
            yield pd.DataFrame(np.array(links, np.uint64).reshape(-1, 2).view(np.int64), columns=["a", "b"])

    return pairs, run


def links(fps: DataFrame, radius: int = RADIUS, limit: int = GROUP_LIMIT) -> DataFrame:
    """(a, b): fingerprints of ``fps(fp)``, all distinct, that hang together by links of at most ``radius`` bits."""
    masks = covering_masks(list(range(BITS)), radius)
    second = [[m | x for x in covering_masks([b for b in range(BITS) if not m >> b & 1], radius)] for m in masks]
    first = F.array(*[F.lit(_signed(m)) for m in masks])
    keyed = fps.select("fp", F.posexplode(first).alias("v", "mask")).select("fp", "v", F.expr("fp & mask").alias("key"))
    groups = keyed.groupBy("v", "key").agg(F.count("*").alias("n"), F.min("fp").alias("low"), F.max("fp").alias("high"))
    pairs, run = _links_of_groups(groups, radius)
    # Spark sizes ``keyed`` as if the explode gave one row for each fingerprint, and would broadcast it
    crowded = groups.where("n > 2").select("v", "key", "n").hint("merge")
    members = keyed.join(crowded, ["v", "key"])
    middle = members.where(F.col("n") <= limit).groupBy("v", "key").agg(F.collect_list("fp").alias("members"))
    table = F.array(*[F.array(*[F.lit(_signed(m)) for m in row]) for row in second])
    deep = members.where(F.col("n") > limit).select("fp", "v", F.posexplode(table[F.col("v")]).alias("w", "mask"))
    deep = deep.select("fp", "v", "w", F.expr("fp & mask").alias("key")).groupBy("v", "w", "key").agg(F.collect_list("fp").alias("members"))
    found = middle.select("members").unionByName(deep.where(F.size("members") > 1).select("members"))
    return pairs.unionByName(found.mapInPandas(run, "a long, b long"))


def near_duplicates(
    spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, radius: int = RADIUS
) -> DataFrame:
    """(id, fp, component): component is the smallest id that can be reached over links of at most ``radius`` bits.

    Null and empty texts have fingerprint 0 and are linked like any other; equal texts have equal fingerprints. Rows with a
    null id get their component from the other rows of their class (null if it has none). Repeated rows stay, each with the
    same result; rows that share an id but not a text are classed each by its own text. Other columns are not read.
    """
    scratch = Scratch(spark, "simhash")
    rows, rooted = _rooted(spark, docs, scratch, id_col, text_col, shingle, radius)
    least = scratch.keep(rooted.groupBy("root").agg(F.min("least").alias("component")), "least")
    component = rooted.select("fp", "root").join(least, "root").select("fp", "component")
    return rows.join(component, "fp").select("id", "fp", "component")


def _rooted(spark: SparkSession, docs: DataFrame, scratch: Scratch, id_col: str, text_col: str, shingle: int, radius: int) -> tuple[DataFrame, DataFrame]:
    """(rows, rooted): all rows as (id, digest, fp); each fingerprint as (fp, least, root), root being its component."""
    rows = scratch.keep(fingerprints(docs, id_col, text_col, shingle), "rows")
    classes = scratch.keep(rows.groupBy("fp").agg(F.min("id").alias("least")), "classes")
    root = roots(links(classes.select("fp"), radius), scratch)
    rooted = classes.join(root, classes.fp == root.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    return rows, scratch.keep(rooted, "rooted")


def keep_one(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each component: that with the smallest id, of equal ids the smallest digest; a null id comes last.

    Rows are told apart by id and text, so a text that shares its id with a near duplicate stays, and copies without ids leave
    one. Of rows equal in both one stays. Components and their members are summed in part before they are shuffled.
    """
    scratch = Scratch(spark, "simhash")
    rows, rooted = _rooted(spark, docs, scratch, id_col, text_col, SHINGLE, RADIUS)
    key = F.struct(F.col("id").isNull().alias("unnamed"), F.col("id").alias("id"), F.col("digest").alias("digest"))
    of_fp = scratch.keep(rows.groupBy("fp").agg(F.min(key).alias("first")).join(rooted.select("fp", "root"), "fp"), "firsts")
    first = scratch.keep(of_fp.groupBy("root").agg(F.min("first").alias("kept")), "kept")
    kept = of_fp.join(first, "root").select("fp", "kept")
    judged = rows.join(kept, "fp").select("id", "digest", (F.col("kept.id").eqNullSafe(F.col("id")) & F.col("kept.digest").eqNullSafe(F.col("digest"))).alias("stays"))
    judged = judged.groupBy(F.col("id").alias("_id"), F.col("digest").alias("_digest")).agg(F.max("stays").alias("_stays"), F.count(F.lit(1)).alias("_n"))
    judged = scratch.keep(judged.where("not _stays or _n > 1"), "judged")
    # a column of the documents may have any name: their row is one value beside the key
    whole = docs.select(F.col(id_col).cast("long").alias("id"), digest_of(F.col(text_col).cast("string")).alias("digest"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    same = F.col("id").eqNullSafe(F.col("_id")) & F.col("digest").eqNullSafe(F.col("_digest"))
    left = whole.join(judged, same, "left_anti").select("row")
    repeated = judged.where("_stays")
    if not repeated.isEmpty():
        once = whole.join(repeated, same, "left_semi").groupBy("id", "digest").agg(F.any_value("row").alias("row"))
        left = left.unionByName(once.select("row"))
    return left.select("row.*")


