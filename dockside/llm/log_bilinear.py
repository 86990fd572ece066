"""A log-bilinear language model trained with noise-contrastive estimation in numpy, scoring whole texts.

The words of all training texts are counted. The most frequent words are symbols of their own, all others stand for the
symbol of their last two letters; the end of a text is a symbol too. The two symbols before a token, each by a vector and a
weight for its distance, predict a vector; its product with every symbol's output vector, normalised over all symbols, gives
the token's symbol. Within a symbol that stands for many words, a word has its add-one share of the corpus counts.

Training is data-parallel: from common starting values every task makes one pass of noise-contrastive steps over all tokens
of its texts, and Spark averages what the tasks have learnt by the number of tokens. Scoring computes the normaliser once for
each pair of symbols that a block of texts holds, by products of whole matrices.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from dockside.llm.storage import Scratch, small_batches, text_slices

END, START, OTHER, FIRST = 0, 1, 2, 3  # symbols: end of text, before the text, any other word, then word endings, then words
ENDINGS, WORDS = 253, 768  # symbols of each sort: 1,024 with the three above
HOT, HOT_LETTERS = 1 << 17, 64  # words whose counts go to every task: so many, of so many characters at most
SIZE, BEFORE = 16, 2  # numbers in a vector, symbols before a token
NOISE, STEP, RATE = 32, 2048, 0.1
SLICE = 4 << 20


def held_out(doc_id: Column) -> Column:
    """True where the checksum of the id as text leaves 2 when divided by 7; a null id counts as the empty string."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 7 == 2


def _tokens(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(words, starts): text i has ``words[starts[i]:starts[i + 1]]``, A to Z in lower case. Null is read as empty."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    words = lists.flatten()
    full = pc.not_equal(words, "")
    offsets = np.asarray(lists.offsets) - lists.offsets[0].as_py()
    counted = np.concatenate(([0], np.cumsum(full.to_numpy(zero_copy_only=False))))
    return words.filter(full), counted[offsets]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in text_slices(batch, "text", SLICE):
            found = _tokens(part.column("text"))[0].value_counts()
            yield pa.RecordBatch.from_arrays([found.field("values"), found.field("counts")], ["word", "n"])


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) over the whole texts of ``docs(text)``."""
    return small_batches(docs.select("text")).mapInArrow(_counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Counts:
    """What coding needs of the corpus: bounded lists, and totals. ``rest`` has (words, tokens) of each symbol that stands for many."""

    texts: int
    tokens: int
    types: int
    hot: pa.Array
    hot_n: np.ndarray
    endings: pa.Array
    rest: dict[int, tuple[int, int]]

    def symbol(self, names: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(symbols, places among the hot words or -1) of distinct words."""
        place = _index(names, self.hot)
        ending = _index(pc.utf8_slice_codeunits(names, start=-2), self.endings)
        rest = np.where(ending >= 0, FIRST + ending, OTHER)
        return np.where((place >= 0) & (place < WORDS), FIRST + ENDINGS + place, rest), place

    def prior(self) -> np.ndarray:
        """The symbols' shares of the training tokens, each counted once more than it occurs; ``START`` is never predicted."""
        n = np.ones(FIRST + ENDINGS + WORDS)
        n[END] += self.texts
        for symbol, (_, tokens) in self.rest.items():
            n[symbol] += tokens
        n[FIRST + ENDINGS : FIRST + ENDINGS + min(WORDS, len(self.hot_n))] += self.hot_n[:WORDS]
        n[START] = 0
        return n / n.sum()

    def shares(self) -> np.ndarray:
        """For each symbol the log10 of what a word's count plus one is divided by; 0 for symbols of one word."""
        found = np.zeros(FIRST + ENDINGS + WORDS)
        for symbol, (types, tokens) in self.rest.items():
            found[symbol] = np.log10(tokens + types + 1)
        return found


def _index(names: pa.Array, among: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.index_in(names, value_set=among), -1).to_numpy(zero_copy_only=False)


def gather(counts: DataFrame, texts: int) -> Counts:
    """Lists and totals of ``counts(word, n)``. The hot words that come to the driver are those of the highest levels of frequency
    (sixteen to a doubling) that have at most ``HOT`` words together: no task sorts or passes on more than it keeps."""
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    short = counts.where(F.length("word") <= HOT_LETTERS).withColumn("level", F.floor(16 * F.log2("n")))
    sizes = sorted(short.groupBy("level").count().collect(), reverse=True)
    full = np.cumsum([r["count"] for r in sizes]) <= HOT
    least = min((r.level for r, fits in zip(sizes, full) if fits), default=1 << 20)
    hot = short.where(F.col("level") >= int(least)).select("word", "n").toArrow().sort_by([("n", "descending"), ("word", "ascending")])
    words, n = pa.chunked_array(hot.column("word").chunks, pa.string()).combine_chunks(), hot.column("n").to_numpy()
    known = counts.sparkSession.createDataFrame([(w,) for w in words[:WORDS].to_pylist()], "known string")
    rest = counts.join(known, F.col("word") == F.col("known"), "left_anti").groupBy(F.right("word", F.lit(2)).alias("ending"))
    rest = rest.agg(F.count(F.lit(1)).alias("types"), F.sum("n").alias("tokens"))
    top = rest.orderBy(F.desc("tokens"), "ending").limit(ENDINGS).collect()
    left = rest.agg(F.coalesce(F.sum("types"), F.lit(0)), F.coalesce(F.sum("tokens"), F.lit(0))).first()
    shares = {FIRST + k: (r.types, r.tokens) for k, r in enumerate(top)}
    shares[OTHER] = (left[0] - sum(r.types for r in top), left[1] - sum(r.tokens for r in top))
    return Counts(
        texts, total[0] + texts, total[1] + (texts > 0), words, n, pa.array([r.ending for r in top], pa.string()), shares
    )


CODED = "doc_id {}, held_out boolean, n_tokens long, n_hot long, all_log double, rest_log double, codes array<short>, tail array<string>"


def coded(docs: DataFrame, counts: Counts) -> DataFrame:
    """Each text as symbols, with what the hot words add to its sums and the other words (``tail``), whose counts are elsewhere."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logs, shares = np.log10(counts.hot_n + 1.0), counts.shares()
        for batch in batches:
            for part in text_slices(batch, "text", SLICE):
                words, starts = _tokens(part.column("text"))
                names = words.dictionary_encode()
                ids, names = names.indices.to_numpy(), names.dictionary
                symbols, place = counts.symbol(names)
                log = np.where(place >= 0, logs[np.maximum(place, 0)], 0.0) if len(logs) else np.zeros(len(names))
                rest = np.where(symbols < FIRST + ENDINGS, log - shares[symbols], 0.0)
                tail = (place < 0)[ids]
                codes = np.insert(symbols[ids].astype(np.int16), starts[1:], END)
                size = len(starts) - 1
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), part.column("held_out"), pa.array(np.diff(starts) + 1),
                        pa.array(_summed((place >= 0)[ids], starts).astype(np.int64)), pa.array(_summed(log[ids], starts)), pa.array(_summed(rest[ids], starts)),
                        pa.ListArray.from_arrays(pa.array((starts + np.arange(size + 1)).astype(np.int32)), pa.array(codes)),
                        pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(tail)))[starts].astype(np.int32)), names.take(pa.array(ids[tail]))),
                    ],
                    ["doc_id", "held_out", "n_tokens", "n_hot", "all_log", "rest_log", "codes", "tail"],
                )

    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return small_batches(rows).mapInArrow(code, CODED.format(rows.schema["doc_id"].dataType.simpleString()))


def _summed(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The sum of each run ``values[starts[i]:starts[i + 1]]``."""
    running = np.concatenate(([0], np.cumsum(values, dtype=np.float64)))
    return running[starts[1:]] - running[starts[:-1]]


class Model:
    """Vectors of the symbols before a token (``into``), their weights by distance, output vectors and biases."""

    def __init__(self, prior: np.ndarray):
        rng = np.random.default_rng(12)
        self.prior = prior
        self.into = rng.normal(0, 0.5, (len(prior), SIZE)).astype(np.float32)
        self.out = np.zeros((len(prior), SIZE), np.float32)
        self.bias = np.log(np.maximum(prior, 1e-30)).astype(np.float32)
        self.weight = np.ones((BEFORE, SIZE), np.float32)

    def rows(self) -> np.ndarray:
        """All values as one table: a row for each symbol, and one for each distance."""
        symbols = np.hstack([self.into, self.out, self.bias[:, None]])
        return np.vstack([symbols, np.hstack([self.weight, np.zeros((BEFORE, SIZE + 1), np.float32)])]).astype(np.float64)

    def take(self, rows: np.ndarray) -> None:
        symbols = rows[: len(self.prior)].astype(np.float32)
        self.into, self.out, self.bias = symbols[:, :SIZE].copy(), symbols[:, SIZE : 2 * SIZE].copy(), symbols[:, -1].copy()
        self.weight = rows[len(self.prior) :, :SIZE].astype(np.float32)

    def predicted(self, before: np.ndarray) -> np.ndarray:
        """The vector that the symbols ``before`` (one column a distance) predict."""
        return sum(self.into[before[:, k]] * self.weight[k] for k in range(BEFORE))

    def normalisers(self, before: np.ndarray, block: int = 4096) -> np.ndarray:
        """log of the sum over all symbols of exp(score), for each row of ``before``."""
        found = np.empty(len(before), np.float64)
        predicted = np.flatnonzero(np.arange(len(self.prior)) != START)
        out, bias = np.ascontiguousarray(self.out[predicted].T), self.bias[predicted]
        for k in range(0, len(before), block):
            scores = self.predicted(before[k : k + block]) @ out
            scores += bias
            most = scores.max(axis=1, keepdims=True)
            scores -= most
            np.exp(scores, out=scores)
            found[k : k + block] = np.log(scores.sum(axis=1, dtype=np.float64)) + most[:, 0]
        return found

    def log_probabilities(self, before: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """Natural logs of the tokens' normalised probabilities; each distinct context is normalised once."""
        base = len(self.prior)
        key = before[:, 0].astype(np.int64)
        for k in range(1, BEFORE):
            key = key * base + before[:, k]
        distinct, first, which = np.unique(key, return_index=True, return_inverse=True)
        contexts = before[first]
        score = np.einsum("ij,ij->i", self.predicted(contexts)[which], self.out[symbols], dtype=np.float64) + self.bias[symbols]
        return score - self.normalisers(contexts)[which]


class Trainer:
    """Noise-contrastive steps: a token is told from ``NOISE`` symbols drawn by their shares, the same ones for a step's tokens."""

    def __init__(self, model: Model):
        self.model, self.rng = model, np.random.default_rng(34)
        self.drawn = np.cumsum(model.prior)
        self.level = np.log(NOISE * np.maximum(model.prior, 1e-30)).astype(np.float32)
        self.seen = [np.full_like(x, 1e-2) for x in (model.into, model.out, model.bias, model.weight)]

    def scores(self, before: np.ndarray, symbols: np.ndarray, noise: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Predicted vectors, and how far the tokens and the drawn symbols score above the level of noise."""
        m = self.model
        vector = m.predicted(before)
        good = np.einsum("ij,ij->i", vector, m.out[symbols]) + m.bias[symbols] - self.level[symbols]
        return vector, good, vector @ m.out[noise].T + (m.bias[noise] - self.level[noise])

    def loss(self, before: np.ndarray, symbols: np.ndarray, noise: np.ndarray) -> float:
        """What a step lowers: the mean cost of taking tokens for noise and noise for tokens."""
        _, good, bad = self.scores(before, symbols, noise)
        return float(np.logaddexp(0, -good).sum() + np.logaddexp(0, bad).sum()) / len(symbols)

    def gradients(self, before: np.ndarray, symbols: np.ndarray, noise: np.ndarray) -> list[np.ndarray]:
        """The loss's derivatives by ``into``, ``out``, ``bias`` and ``weight``."""
        m, size = self.model, len(self.model.prior)
        vector, good, bad = self.scores(before, symbols, noise)
        by_good, by_bad = -_sigmoid(-good) / len(symbols), _sigmoid(bad) / len(symbols)
        by_vector = by_good[:, None] * m.out[symbols] + by_bad @ m.out[noise]
        out, bias = _scattered(symbols, by_good[:, None] * vector, size), np.bincount(symbols, by_good, size).astype(np.float32)
        np.add.at(out, noise, by_bad.T @ vector)
        np.add.at(bias, noise, by_bad.sum(axis=0))
        into = sum(_scattered(before[:, k], by_vector * m.weight[k], size) for k in range(BEFORE))
        weight = np.stack([(by_vector * m.into[before[:, k]]).sum(axis=0) for k in range(BEFORE)])
        return [into, out, bias, weight]

    def step(self, before: np.ndarray, symbols: np.ndarray) -> None:
        noise = np.minimum(np.searchsorted(self.drawn, self.rng.random(NOISE)), len(self.drawn) - 1)
        by, m = self.gradients(before, symbols, noise), self.model
        for x, seen, g in zip((m.into, m.out, m.bias, m.weight), self.seen, by):
            seen += g * g * len(symbols)
            x -= RATE * np.sqrt(len(symbols)) * g / np.sqrt(seen)

    def learn(self, before: np.ndarray, symbols: np.ndarray) -> None:
        order = self.rng.permutation(len(symbols))
        for k in range(0, len(order), STEP):
            at = order[k : k + STEP]
            self.step(before[at], symbols[at])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def _scattered(at: np.ndarray, rows: np.ndarray, size: int) -> np.ndarray:
    return np.stack([np.bincount(at, rows[:, k], size) for k in range(rows.shape[1])], axis=1).astype(np.float32)


def _flat(codes: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(before, symbols, starts) of a batch of coded texts, each of one symbol at least."""
    starts = (np.asarray(codes.offsets) - codes.offsets[0].as_py()).astype(np.int64)
    symbols = codes.flatten().to_numpy().astype(np.int64)
    before = np.full((len(symbols), BEFORE), START)
    place = np.arange(len(symbols)) - np.repeat(starts[:-1], np.diff(starts))
    for k in range(BEFORE):
        inside = place > k
        before[inside, k] = symbols[np.flatnonzero(inside) - k - 1]
    return before, symbols, starts


def fit(texts: DataFrame, counts: Counts) -> Model:
    """A model from all of ``texts(codes)``; one row for each symbol comes to the driver. Without texts the starting values stay."""
    names = [f"v{k}" for k in range(2 * SIZE + 1)]

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, tokens = Model(counts.prior()), 0
        trainer = Trainer(model)
        for batch in batches:
            before, symbols, _ = _flat(batch.column("codes"))
            trainer.learn(before, symbols)
            tokens += len(symbols)
        if tokens:
            rows = model.rows()
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(rows))), pa.array(np.full(len(rows), tokens)), *[pa.array(c) for c in rows.T]], ["row", "tokens", *names]
            )

    learnt = texts.select("codes").mapInArrow(train, "row long, tokens long, " + ", ".join(f"{n} double" for n in names))
    means = [(F.sum(F.col(n) * F.col("tokens")) / F.sum("tokens")).alias(n) for n in names]
    found = learnt.groupBy("row").agg(*means).orderBy("row").toArrow()
    model = Model(counts.prior())
    if found.num_rows:
        model.take(np.column_stack([found.column(n).to_numpy() for n in names]))
    return model


def score(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row of ``docs``.

    Null texts are empty and have one token, the end. Repeated ids are rows of their own. Without training texts no word is
    known and all symbols are equally likely; an empty table gives no rows.
    """
    scratch = Scratch(spark, "bilinear")
    docs = docs.select("doc_id", "text")
    learning = docs.where(~held_out(F.col("doc_id")))
    counts = scratch.keep(word_counts(learning), "counts")
    of = gather(counts, learning.count())
    texts = scratch.keep(coded(docs, of).withColumn("row", F.monotonically_increasing_id()), "texts")
    model = fit(texts.where("not held_out"), of)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            before, symbols, starts = _flat(batch.column("codes"))
            logs = _summed(model.log_probabilities(before, symbols) / np.log(10), starts) if len(symbols) else np.zeros(0)
            columns = [batch.column(c) for c in batch.schema.names if c != "codes"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(logs)], [*[c for c in batch.schema.names if c != "codes"], "symbol_log"])

    kept = texts.select("row", "doc_id", "held_out", "n_tokens", "n_hot", "all_log", "rest_log", "codes")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept.schema.fields if f.name != "codes")
    judged = kept.mapInArrow(judge, f"{schema}, symbol_log double")
    tail = texts.select("row", F.explode("tail").alias("word")).join(counts, "word").select("row", "n")
    tail = tail.groupBy("row").agg(F.count(F.lit(1)).alias("n_tail"), F.sum(F.log10(F.col("n") + 1)).alias("tail_log"))
    ends = 1 if of.texts else 0
    zero = F.lit(0)
    tail_log = F.coalesce("tail_log", zero.cast("double"))
    return judged.join(tail, "row", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("n_hot") + F.coalesce("n_tail", zero) + ends).cast("long").alias("n_known"),
        F.lit(of.tokens).cast("long").alias("train_tokens"),
        (F.col("all_log") + tail_log + float(np.log10(of.texts + 1)) - F.col("n_tokens") * float(np.log10(of.tokens + of.types + 1))).alias("base_score"),
        (F.col("symbol_log") + F.col("rest_log") + tail_log).alias("score"),
    )
