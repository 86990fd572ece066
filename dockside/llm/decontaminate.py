"""Benchmark decontamination: every training passage queries a BM25 inverted index of the test items.

A text is cut into passages of twice an item's longest length, half overlapping, so that an item lies whole in one of them.
Scores are BM25 with the items as documents, divided by the item's score for its own words: 1 if a passage has them all.
The index is read as in block-max WAND, a whole batch of passages at a time: postings of rare words are kept as the highest
score in each block of items; a block is opened for a passage only if the sum of those, with the most that the block's
common words could add, reaches the threshold. Nothing that reaches it is passed over. Items of opened blocks are scored in
full, and what reaches the threshold is verified by five-word shingles of question and answer.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from dockside.llm.storage import small_batches, text_slices
from dockside.llm.words import read_words, runs

K1, B = 1.2, 0.75
THRESHOLD = 0.5  # of the item's score for its own words
OVERLAP, SHINGLE = 0.8, 5
BLOCK = 2  # items of a block
_SLICE = 4 << 20  # bytes of text whose words are coded together
SHORTEST = 64  # items of up to so many words share passages of twice that; longer ones are classed by doubling
PASS_CHARS = 32 << 20  # characters of test items that one reading of the documents is searched for
FOUND = "item_id long, score double, overlap double, question_overlap double, answer_overlap double, first_word int, end_word int"


def _shingles(words: list) -> set:
    n = min(SHINGLE, len(words))
    return {tuple(words[k : k + n]) for k in range(len(words) - n + 1)} if n else set()


def _share(part: set, whole: set) -> float:
    return len(part & whole) / len(part) if part else 1.0


def question_and_answer(text: str) -> tuple[str, str]:
    """The last sentence is the answer, what stands before it the question; a single sentence is a question alone."""
    sentences = re.split(r"(?<=[.!?])\s+", text.strip())
    return (" ".join(sentences[:-1]), sentences[-1]) if len(sentences) > 1 else (text, "")


def _words(texts: list[str]) -> list[list[str]]:
    ids, starts, names = read_words(pa.array(texts, pa.string()))
    names = names.to_pylist()
    return [[names[k] for k in ids[s:e]] for s, e in zip(starts, starts[1:])]


class Index:
    """Items of up to ``length`` words. ``items``: (id, text) pairs with at least one word each."""

    def __init__(self, items: list[tuple[int, str]], length: int):
        self.length, self.ids = length, [i for i, _ in items]
        words = _words([t for _, t in items])
        parts = [question_and_answer(t) for _, t in items]
        counts = [Counter(w) for w in words]
        self.terms: dict[str, int] = {t: k for k, t in enumerate(dict.fromkeys(t for c in counts for t in c))}
        self.names = pa.array(list(self.terms), pa.string())
        df = Counter(t for c in counts for t in c)
        idf = {t: math.log(1 + (len(items) - n + 0.5) / (n + 0.5)) for t, n in df.items()}
        mean = sum(map(len, words)) / len(items)
        self.impacts = []
        for c, w in zip(counts, words):
            raw = {self.terms[t]: idf[t] * f * (K1 + 1) / (f + K1 * (1 - B + B * len(w) / mean)) for t, f in c.items()}
            total = sum(raw.values())
            self.impacts.append({t: x / total for t, x in raw.items()})
        number = lambda texts: [_shingles([self.terms[t] for t in w]) for w in _words(texts)]
        self.whole = number([t for _, t in items])
        self.question, self.answer = number([q for q, _ in parts]), number([a for _, a in parts])
        # postings: for each rare word its blocks and the highest impact in each; common words only bound what a block can add
        self.blocks, cut = -(-len(items) // BLOCK), 3
        while True:
            common = {self.terms[t] for t, n in df.items() if n > cut}
            self.most = np.zeros(self.blocks)
            for i, impacts in enumerate(self.impacts):
                self.most[i // BLOCK] = max(self.most[i // BLOCK], sum(x for t, x in impacts.items() if t in common))
            if not common or self.most.max() < THRESHOLD - 0.02:
                break
            cut *= 3
        best: dict[tuple[int, int], float] = {}
        for i, impacts in enumerate(self.impacts):
            for t, x in impacts.items():
                if t not in common:
                    best[t, i // BLOCK] = max(best.get((t, i // BLOCK), 0.0), x)
        keys = sorted(best)
        self.post_block = np.array([b for _, b in keys], np.int64)
        self.post_most = np.array([best[k] for k in keys])
        self.post_size = np.bincount([t for t, _ in keys], minlength=len(self.terms)).astype(np.int64)
        self.post_start = np.cumsum(self.post_size) - self.post_size

    def search(self, ids: np.ndarray, starts: np.ndarray, names: pa.Array) -> list[tuple]:
        """(text, item, score, first word, passage's words) of all passages and items that reach the threshold."""
        term_of = pc.fill_null(pc.index_in(names, value_set=self.names), -1).to_numpy().astype(np.int64)
        term = term_of[ids] if len(ids) else ids
        counts, half = np.diff(starts), self.length
        passages = np.where(counts > 0, np.maximum(-(-counts // half) - 1, 1), 0)
        first = np.cumsum(passages) - passages
        at = np.nonzero(term >= 0)[0]
        at = at[self.post_size[term[at]] > 0]
        text = np.searchsorted(starts, at, side="right") - 1
        nth = (at - starts[text]) // half
        size = len(self.terms)
        here, before = nth < passages[text], nth > 0
        keys = np.unique(np.concatenate(((first[text] + nth)[here] * size + term[at][here], (first[text] + nth - 1)[before] * size + term[at][before])))
        passage, t = keys // size, keys % size
        posts = runs(self.post_start[t], self.post_size[t])
        cells, back = np.unique(np.repeat(passage, self.post_size[t]) * self.blocks + self.post_block[posts], return_inverse=True)
        bound = np.bincount(back, self.post_most[posts], len(cells)) + self.most[cells % self.blocks]
        cells = cells[bound >= THRESHOLD - 1e-9]  # common words alone never reach it: without a rare word no block is opened
        found, last, seen = [], -1, set()
        for cell in cells.tolist():
            p, block = divmod(cell, self.blocks)
            if p != last:
                last, d = p, int(np.searchsorted(first + passages, p, side="right"))
                start = (p - int(first[d])) * half
                words = term[starts[d] + start : min(starts[d] + start + 2 * half, starts[d + 1])].tolist()
                seen = set(words)
            for i in range(block * BLOCK, min((block + 1) * BLOCK, len(self.ids))):
                score = sum(x for t, x in self.impacts[i].items() if t in seen)
                if score >= THRESHOLD - 1e-9:
                    found.append((d, i, score, start, words))
        return found

    def verified(self, ids: np.ndarray, starts: np.ndarray, names: pa.Array) -> dict[tuple[int, int], tuple]:
        """(text, item): what ``FOUND`` lists, for the best passage that overlaps enough."""
        best: dict[tuple[int, int], tuple] = {}
        for d, i, score, start, words in self.search(ids, starts, names):
            n = min(SHINGLE, min(map(len, self.whole[i])))
            there = _shingles(words) if n == SHINGLE else {tuple(words[k : k + n]) for k in range(len(words) - n + 1)}
            sub = lambda part: _share(part, there if part <= self.whole[i] else _grams(words, part))
            whole, question, answer = _share(self.whole[i], there), sub(self.question[i]), sub(self.answer[i])
            if whole < OVERLAP and (question < OVERLAP or answer < OVERLAP):
                continue
            at = [k for k in range(len(words) - n + 1) if tuple(words[k : k + n]) in self.whole[i]] or [0]
            row = (self.ids[i], score, whole, question, answer, start + at[0], start + at[-1] + n)
            best[d, i] = max(best.get((d, i), row), row, key=lambda r: (r[2], r[1], -r[5]))
        return best


def _grams(words: list, part: set) -> set:
    """The runs of ``words`` that are as long as those of ``part``."""
    n = len(next(iter(part))) if part else 1
    return {tuple(words[k : k + n]) for k in range(len(words) - n + 1)}


def indexes(benchmark: DataFrame) -> list[list[Index]]:
    """The items as indexes by length, in passes of ``PASS_CHARS`` characters. Items without words (null, empty) are left out.

    The benchmark is the stated query set: it is read in blocks of bounded size, each with its own word statistics. Items
    with a null id are searched for, and found as null.
    """
    tests = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    chars = tests.agg(F.sum(F.length("text"))).first()[0] or 0
    passes = -(-chars // PASS_CHARS)
    return [_by_length(tests.where(F.pmod(F.xxhash64("text"), F.lit(passes)) == k).distinct()) for k in range(passes)]


def _by_length(tests: DataFrame) -> list[Index]:
    rows = sorted(tests.toArrow().to_pylist(), key=lambda r: (r["item_id"] is None, r["item_id"], r["text"]))
    classes: dict[int, list] = {}
    for row, words in zip(rows, _words([r["text"] for r in rows])):
        if words:
            length = max(SHORTEST, 1 << (len(words) - 1).bit_length())
            classes.setdefault(length, []).append((row["item_id"], row["text"]))
    return [Index(items, length) for length, items in sorted(classes.items())]


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, score, overlap, ...): one row per row of ``docs`` and test item that it contains.

    An item counts as contained if 0.8 of its five-word shingles, or 0.8 of its question's and of its answer's, stand in one
    passage (a part of fewer words is one shingle). ``first_word`` and ``end_word`` give the place, counted in words of
    letters and digits. Null and empty texts, an empty benchmark and empty tables give no rows; repeated rows give repeated
    rows; a null doc_id stays null. Other columns are not read.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema, out = f"doc_id long, {FOUND}", None
    for group in indexes(benchmark):

        def run(batches: Iterator[pa.RecordBatch], group=group) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in text_slices(batch, "text", _SLICE):
                    coded, own = read_words(part.column("text")), part.column("doc_id").to_pylist()
                    rows = [(own[d], *row) for index in group for (d, _), row in sorted(index.verified(*coded).items())]
                    names = [x.split()[0] for x in schema.split(", ")]
                    kinds = [pa.int64(), pa.int64(), *[pa.float64()] * 4, pa.int32(), pa.int32()]
                    columns = list(zip(*rows)) or [[]] * len(names)
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        part = small_batches(source).mapInArrow(run, schema)
        out = part if out is None else out.unionByName(part)
    return source.sparkSession.createDataFrame([], schema) if out is None else out


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that contain no test item, unchanged."""
    at = docs.columns.index("text")
    for group in indexes(benchmark):

        def run(batches: Iterator[pa.RecordBatch], group=group) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in text_slices(batch, batch.schema.names[at], _SLICE):
                    coded, keep = read_words(part.column(at)), np.ones(part.num_rows, bool)
                    for index in group:
                        for d, _ in index.verified(*coded):
                            keep[d] = False
                    yield part.filter(pa.array(keep))

        docs = small_batches(docs).mapInArrow(run, docs.schema)
    return docs
