"""Substring dedup by hashing lines: of equal units the earliest stays, the others leave their documents.

A unit is a line; a line of several sentences is cut where a sentence or a capitalised word begins, once the unit has
``UNIT_WORDS`` words, so that a passage set into another paragraph is met as well. Units are compared without case and with
single spaces, by 128-bit digests. The first in order of (doc_id, place) stays. Repeated units that follow one another form
a run; runs of ``LEAST_WORDS`` words or more are removed, and their places in the original text are kept. With ``lines`` every
line that repeats as a whole is removed too, whatever its length; the least length then holds for units cut inside a line only.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from dockside.llm.storage import Scratch, small_batches, text_slices

UNIT_WORDS = 4
LEAST_WORDS = 20  # 1: every repeated line goes, whatever its length
_LINE_END = re.compile(r"[^\S\n]*(?:\n|\Z)")
_CUT = re.compile(r"\n|(?<=[.!?])[^\S\n]+|[^\S\n]+(?=[A-ZÀ-ÖØ-Þ])")


def units(text: str | None) -> list[tuple[int, int, int, bytes]]:
    """(start, end, words, digest) of each unit with a word, in order; the places are code points."""
    found, start, text = [], 0, text or ""

    def add(end: int, whole: bool) -> bool:
        words = text[start:end].lower().split()
        if words and (whole or len(words) >= UNIT_WORDS):
            found.append((start, end, len(words), xxhash.xxh128_digest(" ".join(words))))
            return True
        return whole

    for cut in _CUT.finditer(text):
        line = cut[0] == "\n"
        if not line and cut.start() - start < 2 * UNIT_WORDS - 1:
            continue  # too short to have so many words
        if add(cut.start(), line):
            start = cut.end()
    add(len(text), True)
    return found


def whole_lines(text: str | None, found: list[tuple[int, int, int, bytes]]) -> list[tuple[int, int, int, int, bytes, int]]:
    """(n, start, end, words, digest, line) of each of ``units(text)`` and, after its units, of each line of several units.

    ``line`` is the number of units of a whole line, 0 for a unit that is a part of one; n is that of the first unit.
    """
    out, first = [], 0
    for n, (start, stop, words, digest) in enumerate(found):
        if start == 0 or text[start - 1] == "\n":
            first = n
        ends = _LINE_END.match(text, stop) is not None
        out.append((n, start, stop, words, digest, int(ends and first == n)))
        if ends and first < n:
            line = text[found[first][0] : stop].lower().split()
            out.append((first, found[first][0], stop, len(line), xxhash.xxh128_digest(" ".join(line)), n - first + 1))
    return out


def unit_table(docs: DataFrame, lines: bool = False) -> DataFrame:
    """One row per unit of ``docs(own, doc_id, text)``; ``again``: the text has the unit before. ``lines``: see ``whole_lines``."""
    schema = "own long, doc_id long, n int, start int, stop int, words int, a long, b long, again boolean, line int"
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                columns: list[list] = [[] for _ in names]
                for own, doc, text in zip(*(part.column(c).to_pylist() for c in ("own", "doc_id", "text"))):
                    seen = set()
                    found = units(text)
                    rows = whole_lines(text, found) if lines else [(n, *unit, 0) for n, unit in enumerate(found)]
                    for n, start, stop, words, digest, line in rows:
                        a, b = (int.from_bytes(digest[k : k + 8], "little", signed=True) for k in (0, 8))
                        for column, value in zip(columns, (own, doc, n, start, stop, words, a, b, digest in seen, line)):
                            column.append(value)
                        seen.add(digest)
                kinds = [pa.int64(), pa.int64(), *[pa.int32()] * 4, pa.int64(), pa.int64(), pa.bool_(), pa.int32()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return small_batches(docs).mapInArrow(run, schema)


def removed_runs(repeated: list[tuple[int, int, int, int]], least: int = LEAST_WORDS) -> list[tuple[int, int]]:
    """Spans of the runs of repeated units (n, start, stop, words), in order of n, that have ``least`` words or more."""
    spans, run = [], []
    for unit in [*sorted(set(repeated)), None]:
        if run and (unit is None or unit[0] != run[-1][0] + 1):
            if sum(u[3] for u in run) >= least:
                spans.append((run[0][1], run[-1][2]))
            run = []
        run.append(unit)
    return spans


def removed_spans(text: str, repeated: list[tuple[int, int, int, int, int]], least: int) -> list[tuple[int, int]]:
    """Spans of the repeated units (n, start, stop, words, line) that go: whole lines, and runs of ``least`` words or more."""
    runs = removed_runs([u[:4] for u in repeated if u[4] < 2], least)
    spans: list[tuple[int, int]] = []
    for start, stop in sorted([*runs, *[(u[1], u[2]) for u in repeated if u[4]]]):
        if spans and (start <= spans[-1][1] or text[spans[-1][1] : start].isspace()):
            start, stop = spans[-1][0], max(stop, spans.pop()[1])
        spans.append((start, stop))
    return spans


def without(text: str, spans: list[tuple[int, int]]) -> str:
    ends = [0, *[stop for _, stop in spans]]
    return "".join(text[s:e] for s, e in zip(ends, [*[start for start, _ in spans], len(text)]))


def dedup(spark: SparkSession, docs: DataFrame, least: int = LEAST_WORDS, lines: bool = False) -> DataFrame:
    """(doc_id, text, removed): one row per row of ``docs``; removed lists the spans (start, stop) of the original text.

    Documents rank by doc_id, those without one last; units that tie, because their documents share an id (repeated rows do) or
    have none, all stay. Null texts stay null and empty ones empty. Other columns are not read.
    """
    scratch = Scratch(spark, "lines")
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    source = source.select(F.xxhash64("doc_id", "text").alias("own"), "doc_id", "text")
    table = scratch.keep(unit_table(source, lines), "units")
    first = table.groupBy("a", "b").agg(
        F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.count("*").alias("n_all"), F.count("doc_id").alias("n_named")
    )
    # a table of its own: joined straight after the aggregate, a common line's units could not be split among tasks
    first = scratch.keep(first.where("last > first or n_named between 1 and n_all - 1").select("a", "b", "first"), "first")
    unit = F.struct("n", "start", "stop", "words", "line").alias("unit")
    later = table.join(first, ["a", "b"]).where("doc_id > first or doc_id is null").select("own", unit)
    repeated = later.unionByName(table.where("again").select("own", unit)).groupBy("own").agg(F.collect_set("unit").alias("repeated"))
    joined = source.join(repeated.withColumnRenamed("own", "_own"), F.col("own") == F.col("_own"), "left").select("doc_id", "text", "repeated")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
        for batch in batches:
            for part in text_slices(batch, "text"):
                texts, spans = [], []
                for text, found in zip(part.column("text").to_pylist(), part.column("repeated").to_pylist()):
                    gone = removed_spans(text, [tuple(u.values()) for u in found or []], least)
                    texts.append(text if text is None else without(text, gone))
                    spans.append([{"start": s, "stop": e} for s, e in gone])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(texts, pa.string()), pa.array(spans, kind)], ["doc_id", "text", "removed"])

    return small_batches(joined).mapInArrow(run, "doc_id long, text string, removed array<struct<start:int,stop:int>>")
