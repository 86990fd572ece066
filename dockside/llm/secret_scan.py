"""Secret scans over an incremental ledger of text blobs, in DataFrame functions alone.

A text is named by the SHA-256 of its content, so that copies, renamed paths and unchanged versions are one blob. The ledger
holds what each rule version found in each blob and which paths have held which blobs; a scan reads the blobs that the ledger
lacks for its rule version, adds a batch to it, and joins the findings to every path. Places are code points: the texts between
the matches (``split``) and the matches themselves (``regexp_extract_all``) alternate, so that their lengths add up to the places.
They are added up in blocks of ``BLOCK``, as an array that grows by one is copied each time.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from dockside.llm.storage import Scratch

#: kind, pattern, least length of group 2 (0: any match counts). The order is that of the kinds in a list of spans. Patterns of
#: greedy runs carry their least length themselves: a run that is too short holds no longer one.
RULES = [
    ("assign", r"""((?i)password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6),
    ("access", r"AKIA[A-Z0-9]{16,}", 0),
    ("hex", r"[0-9a-f]{24,}", 0),
    ("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]*-----END [A-Z ]*PRIVATE KEY-----", 0),
]
BASE = ("assign", "access", "hex")
VERSION = "2"  # of RULES; a new one has every blob scanned again
MASK = "[REDACTED]"  # no rule's characters: nothing around it can grow into a match
BLOCK = 256
_SPANS = "array<struct<start:int,rank:int,end:int,kind:string>>"


def _spans(text: Column, rank: int, kind: str, pattern: str, least: int) -> Column:
    """The pattern's leftmost matches that do not overlap, as spans; those with too short a group 2 are dropped at the end."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    both = F.zip_with(between, matches, lambda b, m: F.struct(F.length(b).alias("gap"), F.coalesce(F.length(m), F.lit(0)).alias("size"), m.alias("match")))

    def step(done: Column, part: Column) -> Column:
        start, end = done["at"] + part["gap"], done["at"] + part["gap"] + part["size"]
        passed = part["match"].isNotNull()
        if least:
            passed &= F.length(F.regexp_extract(part["match"], pattern, 2)) >= least
        span = F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(kind).alias("kind"))
        found = F.when(passed, F.concat(done["found"], F.array(span))).otherwise(done["found"])
        return F.struct(end.alias("at"), found.alias("found"))

    def block(done: Column, parts: Column) -> Column:
        begin = F.struct(done["at"].alias("at"), F.array().cast(_SPANS).alias("found"))
        more = F.aggregate(parts, begin, step)
        return F.aggregate(F.array(more), done, lambda d, m: F.struct(m["at"].alias("at"), F.concat(d["found"], F.array(m["found"])).alias("found")))

    begin = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{_SPANS}>").alias("found"))
    places = F.flatten(F.aggregate(_blocks(both), begin, block, lambda done: done["found"]))
    return F.when(F.size(matches) > 0, places).otherwise(F.array().cast(_SPANS))


def _blocks(values: Column) -> Column:
    """The array in runs of ``BLOCK``; it is computed once, as the only element of another."""
    cut = lambda x: F.transform(F.sequence(F.lit(0), F.floor((F.size(x) - 1) / BLOCK).cast("int")), lambda i: F.slice(x, i * BLOCK + 1, BLOCK))
    return F.transform(F.array(values), cut)[0]


def spans(text: Column) -> Column:
    """All spans of all rules in ``text`` (not null), by start, then by the rules' order."""
    return F.sort_array(F.concat(*[_spans(text, rank, *rule) for rank, rule in enumerate(RULES)]))


def listed(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def blob_of(text: Column) -> Column:
    return F.sha2(F.coalesce(text.cast("string"), F.lit("")), 256)


class Ledger:
    """Findings by blob and rule version, and blobs by path, as Parquet tables for each batch below ``root``, in a folder that all
    executors share.

    A batch is written to folders named after it and then committed; what an uncommitted one left is written over. A ledger that is
    opened again, by another process too, holds what was committed. A committed batch that is sent again adds only what is new.
    """

    _COMMITS = "number int, name string, folder string"

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        spark.createDataFrame([], self._COMMITS).write.mode("ignore").parquet(f"{self.root}/commits")

    def commits(self) -> list:
        """(number, name, folder) of the committed batches in order: one row a batch."""
        return self.spark.read.schema(self._COMMITS).parquet(f"{self.root}/commits").orderBy("number").collect()

    def read(self, version: str = VERSION) -> DataFrame | None:
        """Findings of the committed batches (None before the first): a blob once for each rule version."""
        folders = [c.folder for c in self.commits()]
        if not folders:
            return None
        return self.spark.read.parquet(*[f"{self.root}/batch-{f}" for f in folders]).where(F.col("rule_version") == version)

    def paths(self) -> DataFrame | None:
        """(doc_id, blob, since): every version that a path has had, with the number of the first batch that held it."""
        parts = [
            self.spark.read.parquet(f"{self.root}/paths-{c.folder}").select("doc_id", "blob", F.lit(c.number).alias("since")) for c in self.commits()
        ]
        return functools.reduce(DataFrame.unionByName, parts).groupBy("doc_id", "blob").agg(F.min("since").alias("since")) if parts else None

    def findings(self, version: str = VERSION) -> DataFrame | None:
        """(doc_id, blob, since, found): the ledger's findings for all stored versions of all paths."""
        paths = self.paths()
        return paths and paths.join(self.read(version).select("blob", "found"), "blob").select("doc_id", "blob", "since", "found")

    def scan(self, docs: DataFrame, batch: str | None = None, version: str = VERSION, text_col: str = "text") -> DataFrame:
        """Scan the blobs of ``docs`` that the ledger lacks for ``version``; gives the ledger's findings with them. The batch is
        named by its number where no name is given."""
        self.add(docs, batch, version, text_col)
        return self.read(version)

    def add(self, docs: DataFrame, batch: str | None = None, version: str = VERSION, text_col: str = "text") -> str:
        """As ``scan``; gives the batch's folder name."""
        done = self.commits()
        number = len(done)
        name = str(number) if batch is None else batch
        folder = f"{name}.{number}" if name in {c.folder for c in done} else name
        text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
        paths = docs.select(F.col("doc_id").cast("string").alias("doc_id"), blob_of(F.col(text_col)).alias("blob"))
        paths.write.mode("overwrite").parquet(f"{self.root}/paths-{folder}")
        blobs = docs.select(blob_of(F.col(text_col)).alias("blob"), text.alias("text"))
        if done:
            blobs = blobs.join(self.read(version).select("blob"), "blob", "left_anti")
        fresh = blobs.dropDuplicates(["blob"]).select("blob", F.lit(version).alias("rule_version"), spans(F.col("text")).alias("found"))
        fresh.write.mode("overwrite").parquet(f"{self.root}/batch-{folder}")
        self.spark.createDataFrame([(number, name, folder)], self._COMMITS).coalesce(1).write.mode("append").parquet(f"{self.root}/commits")
        return folder


def scan(spark: SparkSession, docs: DataFrame, ledger: Ledger | None = None, batch: str | None = None) -> DataFrame:
    """(doc_id, blob, found): one row per row of ``docs``, a path and version of its text; found lists its spans.

    Without a ledger one is begun in the shared folder. A null text is read as empty; empty texts have no spans; repeated
    rows and copies have the same findings; a null doc_id stays null. Other columns are not read.
    """
    ledger = ledger or Ledger(spark, Scratch(spark, "secrets").path("ledger"))
    folder = ledger.add(docs, batch)
    kept = docs.schema["doc_id"].dataType
    paths = spark.read.parquet(f"{ledger.root}/paths-{folder}").select(F.col("doc_id").cast(kept).alias("doc_id"), "blob")
    found = ledger.read().select(F.col("blob").alias("_blob"), "found")
    return paths.join(found, F.col("blob") == F.col("_blob")).select("doc_id", "blob", "found")


def masked(text: Column, found: Column) -> Column:
    """``text`` with ``MASK`` for each run of overlapping spans. Each block of spans takes its piece off the front of what is left of the
    text, so that places are counted from there and not from the text's start."""

    def step(done: Column, span: Column, piece: Column, base: Column) -> Column:
        gap = F.substring(piece, done["at"] - base + 1, span["start"] - done["at"])
        out = F.when(span["start"] >= done["at"], F.concat(done["out"], F.array(gap))).otherwise(done["out"])
        return F.struct(F.greatest(done["at"], span["end"]).alias("at"), out.alias("out"))

    def block(done: Column, part: Column) -> Column:
        end = F.greatest(done["at"], F.array_max(F.transform(part, lambda s: s["end"])))
        begin = F.struct(done["at"].alias("at"), F.array().cast("array<string>").alias("out"))
        cut = F.struct(F.substring(done["rest"], F.lit(1), end - done["at"]).alias("piece"), end.alias("end"))

        def joined(d: Column, c: Column) -> Column:
            gaps = F.aggregate(part, begin, lambda x, s: step(x, s, c["piece"], done["at"]), lambda x: x["out"])
            text = F.concat_ws("", F.transform(gaps, lambda g: F.concat(g, F.lit(MASK))))
            rest = F.substring(d["rest"], c["end"] - d["at"] + 1, F.length(d["rest"]))
            return F.struct(c["end"].alias("at"), rest.alias("rest"), F.concat(d["out"], F.array(text)).alias("out"))

        return F.aggregate(F.array(cut), done, joined)

    begin = F.struct(F.lit(0).alias("at"), text.alias("rest"), F.array().cast("array<string>").alias("out"))
    return F.aggregate(_blocks(found), begin, block, lambda done: F.concat(F.array_join(done["out"], ""), done["rest"]))


def redact(spark: SparkSession, docs: DataFrame, ledger: Ledger | None = None) -> DataFrame:
    """``docs`` with every span replaced by ``MASK`` and ``n_chars`` counted anew where a text has changed.

    Overlapping spans get one mask. All rows stay; texts without spans, null and empty ones too, are left as they are.
    """
    ledger = ledger or Ledger(spark, Scratch(spark, "secrets").path("ledger"))
    found = ledger.scan(docs).where(F.size("found") > 0).select("blob", "found")
    # a column of the documents may have any name: their row is one value beside the key
    rows = docs.select(blob_of(F.col("text")).alias("own"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    joined = rows.join(found, F.col("own") == F.col("blob"), "left")
    changed_text = joined.select("row", F.when(F.col("found").isNotNull(), masked(F.col("row.text"), F.col("found"))).alias("masked"))
    n_chars = F.when(F.col("masked").isNotNull(), F.length("masked").cast("long")).otherwise(F.col("row.n_chars"))
    changed = {"text": F.coalesce("masked", F.col("row.text")), "n_chars": n_chars}
    return changed_text.select(*[changed.get(c, F.col("row")[c]).alias(c) for c in docs.columns])
