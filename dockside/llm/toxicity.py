"""Toxicity of whole texts: a bidirectional gated recurrent network with attention pooling, trained and run in numpy.

A word enters as its hashed embedding, the mean of its hashed character n-gram embeddings, and two fixed numbers that the
training sample's label counts give for the word and for its most telling n-gram. A text is cut into windows of ``WINDOW``
words, ``STRIDE`` apart, so that neighbours overlap by half; every window is scored and the text takes the highest score.
Only the text is read. The labels say which texts are toxic, not where: training turns between finding each text's
highest window and fitting the network to those windows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from dockside.llm.storage import small_batches, text_slices
from dockside.llm.words import read_words, runs

WINDOW, STRIDE = 32, 16
WORD_BUCKETS, GRAM_BUCKETS, GRAMS = 1 << 14, 1 << 15, (3, 4, 5)
EMBED, HIDDEN = 8, 8
SAMPLE = 1500  # labelled texts of each class that training takes at most
SAMPLE_CHARS = 20_000  # longer texts are scored whole, but not trained on
ROUNDS, MOST_ROUNDS, STEPS, BATCH, RATE = 6, 30, 300, 128, 0.01  # a small sample gets more rounds, up to STEPS steps
_SLICE = 2 << 20  # bytes of text whose words are coded together
_CHUNK = 2048  # windows that pass through the network together
_MIX = np.uint64(0x9E3779B97F4A7C15)


# ---- words ----------------------------------------------------------------------------------------------------------


@dataclass
class Words:
    """The texts of a batch as runs of distinct words: text i is ``ids[starts[i]:starts[i + 1]]``."""

    ids: np.ndarray
    starts: np.ndarray
    word: np.ndarray  # bucket of each distinct word
    gram: np.ndarray  # buckets of its character n-grams, one word after the other
    gram_starts: np.ndarray


def coded(texts: pa.Array) -> Words:
    ids, starts, names = read_words(texts)
    return Words(ids, starts, *_buckets(names.to_pylist()))


def _buckets(names: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word buckets, n-gram buckets, and where each word's n-grams begin; some thousand words at a time."""
    parts = [_some_buckets(names[k : k + 8 * _CHUNK]) for k in range(0, len(names), 8 * _CHUNK)] or [_some_buckets([])]
    before = np.cumsum([0, *[len(gram) for _, gram, _ in parts]])
    starts = [s[:-1] + b for (_, _, s), b in zip(parts, before)]
    return np.concatenate([w for w, _, _ in parts]), np.concatenate([g for _, g, _ in parts]), np.concatenate([*starts, before[-1:]])


def _some_buckets(names: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    codes = np.frombuffer("".join(f"\x02{n}\x03" for n in names).encode("utf-32-le"), np.uint32).astype(np.uint64)
    lengths = np.fromiter((len(n) + 2 for n in names), np.int64, len(names))
    starts = np.concatenate(([0], np.cumsum(lengths)))
    place = np.arange(len(codes)) - np.repeat(starts[:-1], lengths)
    mixed = (codes + np.uint64(1)) * (_MIX ^ (place.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)) | np.uint64(1))
    mixed = (mixed ^ mixed >> np.uint64(29)) * _MIX
    word = (np.add.reduceat(mixed, starts[:-1]) if len(names) else np.empty(0, np.uint64)) * _MIX >> np.uint64(64 - 14)
    left = np.repeat(starts[1:], lengths) - np.arange(len(codes))  # characters from here to the word's end
    found, owner = [], []
    for n in GRAMS:
        at = np.nonzero(left >= n)[0] if len(codes) else np.empty(0, np.int64)
        h = np.zeros(len(at), np.uint64)
        for k in range(n):
            h = (h ^ codes[at + k]) * _MIX
            h ^= h >> np.uint64(31)
        found.append((h + np.uint64(n)) * _MIX >> np.uint64(64 - 15))
        owner.append(np.searchsorted(starts, at, side="right") - 1)
    gram, owner = np.concatenate(found), np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    return word.astype(np.int32), gram[order].astype(np.int32), np.searchsorted(owner[order], np.arange(len(names) + 1))


def windows_of(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(windows, text of each window): ``WINDOW`` word ids a row, -1 beyond the text's end; every word is in a window."""
    counts = np.diff(words.starts)
    number = np.where(counts > 0, np.maximum(0, -(-(counts - WINDOW) // STRIDE)) + 1, 0)
    text = np.repeat(np.arange(len(counts)), number)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(number) - number, number)
    at = (words.starts[text] + nth * STRIDE)[:, None] + np.arange(WINDOW)
    inside = at < words.starts[text + 1][:, None]
    return np.where(inside, words.ids[np.minimum(at, max(len(words.ids) - 1, 0))] if len(words.ids) else -1, -1), text


# ---- network --------------------------------------------------------------------------------------------------------


def _sigmoid(x):
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _sums(at: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct places of ``at``, and the sum of the rows of each."""
    order = np.argsort(at, kind="stable")
    first = np.nonzero(np.concatenate(([True], np.diff(at[order]) != 0)))[0]
    return at[order][first], np.add.reduceat(rows[order], first, axis=0)


def _start(seed: int) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    inputs, gates = 2 * EMBED + 2, 3 * HIDDEN
    p = {
        "word": rng.normal(0, 0.05, (WORD_BUCKETS, EMBED)),
        "gram": rng.normal(0, 0.05, (GRAM_BUCKETS, EMBED)),
        "attend": rng.normal(0, 0.3, 2 * HIDDEN),
        "out": rng.normal(0, 0.3, 2 * HIDDEN),
        "bias": np.zeros(1),
    }
    for side in ("ahead", "back"):
        p[f"{side}_x"] = rng.normal(0, inputs**-0.5, (inputs, gates))
        p[f"{side}_h"] = rng.normal(0, HIDDEN**-0.5, (HIDDEN, gates))
        p[f"{side}_b"] = np.zeros(gates)
    return {k: v.astype(np.float32) for k, v in p.items()}


@dataclass
class Model:
    p: dict[str, np.ndarray]
    word_odds: np.ndarray  # of each word bucket, from the training sample
    gram_odds: np.ndarray
    empty: float  # score of a text without words
    side: tuple = field(default=("ahead", "back"))

    def inputs(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """One row per distinct word, and a last row of zeros for places beyond a text's end."""
        sizes = np.diff(words.gram_starts)
        out = np.zeros((len(words.word) + 1, 2 * EMBED + 2), np.float32)
        some = np.nonzero(sizes)[0]  # the rest have no letter
        out[:-1, :EMBED] = self.p["word"][words.word]
        out[:-1, -2] = self.word_odds[words.word]
        for at in range(0, len(some), 8 * _CHUNK):
            part = some[at : at + 8 * _CHUNK]
            begin, end = words.gram_starts[part[0]], words.gram_starts[part[-1] + 1]
            gram, starts = words.gram[begin:end], words.gram_starts[part] - begin
            out[part, EMBED : 2 * EMBED] = np.add.reduceat(self.p["gram"][gram], starts, axis=0) / sizes[part][:, None] ** 0.5
            out[part, -1] = np.maximum.reduceat(self.gram_odds[gram], starts)
        return out, sizes

    def run(self, x: np.ndarray, windows: np.ndarray, keep: bool = False):
        """Logits of the windows; with ``keep`` also what the gradients need."""
        n, states, notes = len(windows), [], {}
        inside = (windows >= 0).T[:, :, None]
        full = inside.all(axis=(1, 2))
        for side in self.side:
            gates = x @ self.p[f"{side}_x"] + self.p[f"{side}_b"]
            u, h = self.p[f"{side}_h"], np.zeros((n, HIDDEN), np.float32)
            out, steps = np.empty((WINDOW, n, HIDDEN), np.float32), []
            for t in range(WINDOW) if side == "ahead" else range(WINDOW - 1, -1, -1):
                g, v = gates[windows[:, t]], h @ u
                zr = _sigmoid(g[:, : 2 * HIDDEN] + v[:, : 2 * HIDDEN])
                z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
                c = np.tanh(g[:, 2 * HIDDEN :] + r * v[:, 2 * HIDDEN :])
                new = c + z * (h - c)
                if not full[t]:
                    new = np.where(inside[t], new, h)
                if keep:
                    steps.append((t, h, z, r, c, v[:, 2 * HIDDEN :]))
                out[t] = h = new
            states.append(out)
            notes[side] = steps
        states = np.concatenate(states, axis=2)
        a = np.where(inside[:, :, 0], states @ self.p["attend"], -1e9)
        a = np.exp(a - a.max(axis=0))
        a /= a.sum(axis=0)
        pooled = np.einsum("tn,tnh->nh", a, states)
        logits = pooled @ self.p["out"] + self.p["bias"][0]
        return (logits, states, a, pooled, notes, inside) if keep else logits

    def gradients(self, words: Words, x: np.ndarray, sizes: np.ndarray, windows: np.ndarray, wanted: np.ndarray, weight: np.ndarray) -> dict:
        logits, states, a, pooled, notes, inside = self.run(x, windows, keep=True)
        d = ((_sigmoid(logits) - wanted) * weight / weight.sum()).astype(np.float32)
        g = {"out": pooled.T @ d, "bias": np.array([d.sum()], np.float32)}
        d_pooled = d[:, None] * self.p["out"]
        d_a = np.einsum("nh,tnh->tn", d_pooled, states)
        d_a = a * (d_a - (a * d_a).sum(axis=0))
        g["attend"] = np.einsum("tn,tnh->h", d_a, states)
        d_states = a[:, :, None] * d_pooled + d_a[:, :, None] * self.p["attend"]
        d_x = np.zeros_like(x)
        for k, side in enumerate(self.side):
            u, w = self.p[f"{side}_h"], self.p[f"{side}_x"]
            d_out, d_h = d_states[:, :, k * HIDDEN : (k + 1) * HIDDEN], np.zeros((len(windows), HIDDEN), np.float32)
            g[f"{side}_h"], d_gates, at, rows = np.zeros_like(u), np.zeros((len(x), w.shape[1]), np.float32), [], []
            for t, h, z, r, c, v in reversed(notes[side]):
                d_h = d_h + d_out[t]
                new = np.where(inside[t], d_h, 0)
                d_c = new * (1 - z) * (1 - c * c)
                d_z, d_r = new * (h - c) * z * (1 - z), d_c * v * r * (1 - r)
                d_v = np.concatenate((d_z, d_r, d_c * r), axis=1)
                g[f"{side}_h"] += h.T @ d_v
                at.append(windows[:, t])
                rows.append(np.concatenate((d_z, d_r, d_c), axis=1))
                d_h = np.where(inside[t], new * z, d_h) + d_v @ u.T
            at, rows = _sums(np.concatenate(at), np.concatenate(rows))
            d_gates[at] = rows
            g[f"{side}_x"], g[f"{side}_b"] = x.T @ d_gates, d_gates.sum(axis=0)
            d_x += d_gates @ w.T
        used = np.unique(windows[windows >= 0])
        g["word"] = (words.word[used], d_x[used, :EMBED])
        owner = np.repeat(np.arange(len(used)), sizes[used])
        at = runs(words.gram_starts[used], sizes[used])
        g["gram"] = (words.gram[at], (d_x[used, EMBED : 2 * EMBED] / np.maximum(sizes[used], 1)[:, None] ** 0.5)[owner])
        return g

    def scores(self, texts: pa.Array) -> np.ndarray:
        """The highest window score of each text."""
        words = coded(texts)
        windows, text = windows_of(words)
        x, _ = self.inputs(words)
        best = np.full(len(texts), -np.inf)
        for start in range(0, len(windows), _CHUNK):
            np.maximum.at(best, text[start : start + _CHUNK], self.run(x, windows[start : start + _CHUNK]))
        return np.where(np.isfinite(best), _sigmoid(best), self.empty)


def _odds(buckets: Iterator[np.ndarray], labels: np.ndarray, size: int) -> np.ndarray:
    """Smoothed log odds of label 1 given a bucket, against those of all texts; 0 where label 1 has under three texts."""
    there = np.zeros((2, size))
    for b, label in zip(buckets, labels):
        there[label][b] += 1
    n = np.maximum(np.bincount(labels, minlength=2), 1)
    odds = np.log((there[1] + 0.5) / n[1]) - np.log((there[0] + 0.5) / n[0])
    return np.where(there[1] >= 3, np.clip(odds, 0, 5), 0).astype(np.float32)


def train(texts: list[str], labels: list[int], seed: int = 7) -> Model:
    """Fit the network to whole texts and their labels (0 or 1). Without both labels, every score is the label's share."""
    labels = np.asarray(labels, np.int64)
    share = float(np.clip(labels.mean(), 0.01, 0.99)) if len(labels) else 0.01
    model = Model(_start(seed), np.zeros(WORD_BUCKETS, np.float32), np.zeros(GRAM_BUCKETS, np.float32), min(share, 0.49))
    if len(set(labels.tolist())) < 2:
        model.p["out"][:] = 0
        model.p["bias"][:] = np.log(share / (1 - share))
        return model
    words = coded(pa.array(texts, pa.string()))
    in_text = [np.unique(words.ids[s:e]) for s, e in zip(words.starts, words.starts[1:])]
    model.word_odds = _odds((np.unique(words.word[i]) for i in in_text), labels, WORD_BUCKETS)
    sizes = np.diff(words.gram_starts)
    model.gram_odds = _odds((np.unique(words.gram[runs(words.gram_starts[i], sizes[i])]) for i in in_text), labels, GRAM_BUCKETS)
    windows, text = windows_of(words)
    # before the first round: the window whose words' label counts say most
    strong = model.inputs(words)[0][:, -2:].max(axis=1)
    guess = np.sort(strong[windows], axis=1)[:, -3:].sum(axis=1)
    rng, moments, step = np.random.default_rng(seed), {}, 0
    per_round = -(-(len(texts) + int((labels == 0).sum())) // BATCH)
    rounds = min(max(ROUNDS, -(-STEPS // per_round)), MOST_ROUNDS)
    raised = np.clip(2 * (labels == 0).sum() / (labels == 1).sum(), 2, 8)
    for turn in range(rounds):
        x, sizes = model.inputs(words)
        if turn:
            guess = np.concatenate([model.run(x, windows[s : s + _CHUNK]) for s in range(0, len(windows), _CHUNK)])
        order = np.lexsort((-guess, text))
        top = order[np.concatenate(([True], text[order][1:] != text[order][:-1]))]
        other = rng.choice(len(windows), min(len(windows), len(top)), replace=False)
        chosen = np.concatenate((top, other[labels[text[other]] == 0]))
        rng.shuffle(chosen)
        for start in range(0, len(chosen), BATCH):
            part, step = chosen[start : start + BATCH], step + 1
            local, back = np.unique(windows[part], return_inverse=True)
            x, sizes = model.inputs(small := _only(words, local[local >= 0]))
            small_windows = (back.reshape(windows[part].shape) - (local[0] < 0)).astype(np.int64)
            wanted = labels[text[part]].astype(np.float32)
            weight = np.where(wanted == 1, raised, 1.0)
            g = model.gradients(small, x, sizes, small_windows, wanted, weight)
            _adam(model.p, g, moments, step, RATE * (1 - turn / (rounds + 1)))
    return model


def _only(words: Words, chosen: np.ndarray) -> Words:
    """The words ``chosen``, numbered anew; without texts."""
    sizes = np.diff(words.gram_starts)[chosen]
    starts = np.concatenate(([0], np.cumsum(sizes)))
    at = runs(words.gram_starts[chosen], sizes)
    return Words(np.empty(0, np.int64), np.zeros(1, np.int64), words.word[chosen], words.gram[at], starts)


def _adam(p: dict, g: dict, moments: dict, step: int, rate: float) -> None:
    """One step of Adam; of the embeddings only the rows that the batch has touched move."""
    for name, d in g.items():
        m, v = moments.setdefault(name, (np.zeros_like(p[name]), np.zeros_like(p[name])))
        rows = slice(None)
        if isinstance(d, tuple):
            rows, d = _sums(*d)
        m[rows] = 0.9 * m[rows] + 0.1 * d
        v[rows] = 0.999 * v[rows] + 0.001 * d * d
        p[name][rows] -= rate * (m[rows] / (1 - 0.9**step)) / (np.sqrt(v[rows] / (1 - 0.999**step)) + 1e-8)


# ---- tables ---------------------------------------------------------------------------------------------------------


def held_out(id_column) -> F.Column:
    """Rows that are never learnt from: crc32 of the id's text, mod 5, is 0. A null id counts as the empty text, which is held out."""
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Train on at most ``sample`` labelled texts of each label that are not held out, taken by a hash of their id.

    Texts of over ``SAMPLE_CHARS`` characters are not trained on. Labels other than 0 and 1, null ids and null texts are left
    out; an id with several labels counts as toxic if one of them is 1.
    """
    known = labels.where("doc_id is not null and toxic in (0, 1)").where(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    # labels of texts that are not among ``docs`` must not use up the sample
    known = known.join(docs.where(f"text is not null and length(text) <= {SAMPLE_CHARS}").select("doc_id"), "doc_id", "left_semi")
    chosen = [known.where(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(2 * sample) for k in (0, 1)]
    chosen = chosen[0].unionByName(chosen[1]).withColumnRenamed("doc_id", "_id")
    found = docs.select(F.col("doc_id").alias("_doc"), F.col("text").alias("_text")).where(f"_text is not null and length(_text) <= {SAMPLE_CHARS}")
    # 4 * sample ids and labels: a bounded table
    found = found.join(F.broadcast(chosen), F.col("_doc") == F.col("_id")).select("_id", "_text", "toxic")
    parts = [found.where(F.col("toxic") == k).orderBy(F.xxhash64("_id"), "_id", "_text").limit(sample) for k in (0, 1)]
    rows = parts[0].unionByName(parts[1]).toArrow()
    return train(rows.column("_text").to_pylist(), rows.column("toxic").to_pylist())


def score(docs: DataFrame, model: Model, keep_below: float | None = None) -> DataFrame:
    """``docs`` with a column ``score``; with ``keep_below`` the rows of a lower score only, without it.

    Null and empty texts have the share of toxic texts in the sample as their score, below one half. Every row has its own
    score; repeated rows have the same, and a column of ``docs`` named score gives way to it.
    """
    docs = docs if keep_below is not None else docs.drop("score")
    at = docs.columns.index("text")
    schema = docs.schema if keep_below is not None else docs.withColumn("score", F.lit(0.0)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, batch.schema.names[at], _SLICE):
                values = model.scores(part.column(at))
                if keep_below is not None:
                    yield part.filter(pa.array(values < keep_below))
                else:
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(values)], [*part.schema.names, "score"])

    return small_batches(docs).mapInArrow(run, schema)
