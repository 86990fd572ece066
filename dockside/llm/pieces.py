"""SentencePiece BPE with seeded merge dropout: varied segmentations of the same text that all decode to it.

Merging starts from characters; the agenda holds the neighbours that a piece of the vocabulary could join, best score first,
then leftmost. A candidate is skipped if a hash of its place in its word, the word's number in its text, the text's digest, and
the seed falls below the dropout rate: every occurrence of a word draws for itself, a lost task that runs again gives the same
pieces, and another seed gives others. With no dropout the pieces are those of the library itself.

No piece holds a space after another character, so a text falls into words (spaces, then the rest up to the next space) that
merge on their own. A word that a slice holds more than twice is merged without dropout once; an occurrence that skips none of
these merges has its pieces, as an agenda of its own would give the same. Every other occurrence runs an agenda of its own. Long
words run it as a heap; the others run it side by side as arrays, one merge of each word at a time.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import xxhash
from pyspark.sql import DataFrame, functions as F

from dockside.llm.storage import small_batches, text_slices
from dockside.llm.words import runs

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
RATE, SEED = 0.1, "0"
TOGETHER = 8192  # words whose agendas run side by side: their arrays fit a core's cache
LONG = 96  # characters from which a word runs on the heap
_SLICE, _BLOCK = 4 << 20, 1 << 16
_NONE, _MASK = 1 << 30, (1 << 64) - 1
_A, _B, _C, _D = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93
_SLOTS, _SHIFT = 1 << 18, 64 - 18
_WORD = re.compile(r" +[^ ]*")


def key_of(seed: str) -> int:
    return int.from_bytes(hashlib.blake2b(seed.encode(), digest_size=8).digest(), "little")


def _mixed(h):
    """The same finish for numbers and arrays of 64 bits."""
    if isinstance(h, np.ndarray):
        h = (h ^ h >> np.uint64(32)) * np.uint64(_D)
        h = (h ^ h >> np.uint64(29)) * np.uint64(_B)
        return h ^ h >> np.uint64(32)
    h = (h ^ h >> 32) * _D & _MASK
    h = (h ^ h >> 29) * _B & _MASK
    return h ^ h >> 32


def _draws(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A number for each word of texts that have ``counts`` words, from the text's key and the word's place."""
    place = runs(np.ones(len(counts), np.int64), counts).astype(np.uint64)
    return _mixed(np.repeat(_mixed(keys), counts) + place * np.uint64(_A))


def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    return codes, sizes, np.cumsum(sizes) - sizes


class Pieces:
    """The vocabulary's merges as sorted arrays. Character c without a piece has the id ``size`` + c until the end."""

    def __init__(self, path: str = MODEL):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = model.get_piece_size()
        plain = [k for k in range(self.size) if not (model.is_byte(k) or model.is_control(k) or model.is_unknown(k))]
        name = {k: model.id_to_piece(k) for k in plain}
        self.id = {v: k for k, v in name.items()}
        self.byte = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)])
        scores = sorted({model.get_score(k) for k in plain}, reverse=True)
        place = {s: k for k, s in enumerate(scores)}
        rank = {k: place[model.get_score(k)] for k in plain}
        merges = {}
        for k, v in name.items():
            for cut in range(1, len(v)):
                left, right = self.id.get(v[:cut]), self.id.get(v[cut:])
                if left is not None and right is not None:
                    merges[left * self.size + right] = (rank[k], k)
        self.merges = merges
        self.table = np.full((_SLOTS, 3), -1, np.int64)  # key, rank, piece; a slot that is taken leads to the next
        self.steps = 0
        for key, found in merges.items():
            slot, step = (key * _A & _MASK) >> _SHIFT, 0
            while self.table[(slot + step) % _SLOTS, 0] >= 0:
                step += 1
            self.table[(slot + step) % _SLOTS] = key, *found
            self.steps = max(self.steps, step)
        self.char = np.arange(0x110000, dtype=np.int64) + self.size
        for v, k in self.id.items():
            if len(v) == 1:
                self.char[ord(v)] = k
        self.char[ord(" ")] = self.char[0x2581]
        self.char[0x2581] = 0x2581 + self.size  # the character itself goes out as bytes, or it would come back as a space
        texts = [name.get(k, "").replace("▁", " ").encode() for k in range(self.size)]
        for b, k in enumerate(self.byte):
            texts[k] = bytes([b])
        self.bytes, self.byte_size = np.frombuffer(b"".join(texts), np.uint8), np.fromiter(map(len, texts), np.int64)
        self.byte_start = np.cumsum(self.byte_size) - self.byte_size

    # ---- merging ----

    def _place(self, start: np.ndarray, middle: np.ndarray, end: np.ndarray) -> np.ndarray:
        return start.astype(np.uint64) * np.uint64(_A) + middle.astype(np.uint64) * np.uint64(_B) + end.astype(np.uint64) * np.uint64(_C)

    def _skipped(self, h, rate: float):
        bar = min(int(rate * 2.0**64), _MASK)
        return _mixed(h) <= np.uint64(bar) if isinstance(h, np.ndarray) else _mixed(h) <= bar

    def heap(self, codes: np.ndarray, seed: int, rate: float) -> list[int]:
        """The agenda of one word as a heap."""
        ids, n = self.char[codes].tolist(), len(codes)
        before, after, end = list(range(-1, n - 1)), [*range(1, n), -1], list(range(1, n + 1))
        agenda: list[tuple] = []

        def push(left: int) -> None:
            right = after[left]
            if right >= 0 and ids[left] < self.size and ids[right] < self.size:
                if found := self.merges.get(ids[left] * self.size + ids[right]):
                    heapq.heappush(agenda, (found[0], left, right, end[right], found[1]))

        for k in range(n - 1):
            push(k)
        while agenda:
            _, left, right, stop, piece = heapq.heappop(agenda)
            if ids[left] < 0 or ids[right] < 0 or after[left] != right or end[right] != stop:
                continue  # one of the two has been merged meanwhile
            if self.merges.get(ids[left] * self.size + ids[right], (0, -1))[1] != piece or (rate and self._skipped((seed + left * _A + right * _B + stop * _C) & _MASK, rate)):
                continue
            ids[left], ids[right], end[left], after[left] = piece, -1, stop, after[right]
            if after[left] >= 0:
                before[after[left]] = left
                push(left)
            if before[left] >= 0:
                push(before[left])
        return [k for k in ids if k >= 0]

    def _ranked(self, ids, word, start, end, at, seeds, rate) -> tuple[np.ndarray, np.ndarray]:
        """Rank and piece of joining each symbol of ``at`` to its right neighbour; ``_NONE`` where nothing joins them."""
        rank, piece = np.full(len(at), _NONE, np.int64), np.zeros(len(at), np.int64)
        fit = at + 1 < len(ids)
        fit[fit] = word[at[fit]] == word[at[fit] + 1]
        left, right = ids[at[fit]], ids[at[fit] + 1]
        known = (left < self.size) & (right < self.size)
        where = np.nonzero(fit)[0][known]
        keys = left[known] * self.size + right[known]
        slot, hits = (keys.astype(np.uint64) * np.uint64(_A) >> np.uint64(_SHIFT)).astype(np.int64), []
        for _ in range(self.steps + 1):
            there = self.table[slot, 0]
            hit = there == keys
            rank[where[hit]], piece[where[hit]] = self.table[slot[hit], 1], self.table[slot[hit], 2]
            hits.append(where[hit])
            left_over = (there >= 0) & ~hit
            if not left_over.any():
                break
            where, keys, slot = where[left_over], keys[left_over], (slot[left_over] + 1) % _SLOTS
        where = np.concatenate(hits)
        if rate:
            k = at[where]
            rank[where[self._skipped(seeds[word[k]] + self._place(start[k], start[k + 1], end[k + 1]), rate)]] = _NONE
        return rank, piece

    def side_by_side(
        self, codes: np.ndarray, sizes: np.ndarray, seeds: np.ndarray, rate: float, made: list | None = None
    ) -> tuple[np.ndarray, np.ndarray]:
        """(ids, word of each): the agendas of all words, each of which makes its best merge in every round.

        ``made`` takes up (words, places) of each round's merges.
        """
        word, ids = np.repeat(np.arange(len(sizes)), sizes), self.char[codes]
        start = np.arange(len(codes)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        end, done_ids, done_words = start + 1, [], []
        rank, piece = self._ranked(ids, word, start, end, np.arange(len(ids)), seeds, rate)
        while len(ids):
            first = np.nonzero(np.concatenate(([True], word[1:] != word[:-1])))[0]
            best = np.minimum.reduceat(rank << 32 | np.arange(len(ids)), first)
            going = best >> 32 < _NONE
            keep = np.repeat(going, np.diff(np.append(first, len(ids))))
            done_ids.append(ids[~keep])
            done_words.append(word[~keep])
            at = best[going] & 0xFFFFFFFF
            if made is not None:
                made.append((word[at], self._place(start[at], start[at + 1], end[at + 1])))
            ids[at], end[at] = piece[at], end[at + 1]
            keep[at + 1] = False
            now = np.cumsum(keep)[at] - 1
            ids, word, start, end, rank, piece = (x[keep] for x in (ids, word, start, end, rank, piece))
            if not len(ids):
                break
            again = np.concatenate((now, now[now > 0] - 1))
            rank[again], piece[again] = self._ranked(ids, word, start, end, again, seeds, rate)
        if not done_ids:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        out, owner = np.concatenate(done_ids), np.concatenate(done_words)
        order = np.argsort(owner, kind="stable")
        return out[order], owner[order]

    def _as_bytes(self, ids: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Characters without a piece become their bytes' pieces."""
        odd = np.nonzero(ids >= self.size)[0]
        if not len(odd):
            return ids, owner
        texts = [chr(c).encode() for c in (ids[odd] - self.size).tolist()]
        sizes = np.ones(len(ids), np.int64)
        sizes[odd] = np.fromiter(map(len, texts), np.int64, len(texts))
        out = np.repeat(ids, sizes)
        out[runs((np.cumsum(sizes) - sizes)[odd], sizes[odd])] = self.byte[np.frombuffer(b"".join(texts), np.uint8)]
        return out, np.repeat(owner, sizes)

    def _agendas(self, coded: tuple, words: np.ndarray, seeds: np.ndarray, rate: float, made: list | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(ids, sizes): the pieces of ``words``, numbers in the coded table, one word's after the other's."""
        codes, sizes, starts = coded
        size = sizes[words]
        ids, owner = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        by_size = np.nonzero(size < LONG)[0]
        by_size = by_size[np.argsort(size[by_size], kind="stable")]
        for at in range(0, len(by_size), TOGETHER):
            part, merges = by_size[at : at + TOGETHER], None if made is None else []
            own = words[part]
            found, place = self.side_by_side(codes[runs(starts[own], sizes[own])], sizes[own], seeds[part], rate, merges)
            ids.append(found)
            owner.append(part[place])
            if made is not None:
                made += [(part[w], places) for w, places in merges]
        for k in np.nonzero(size >= LONG)[0].tolist():
            start = starts[words[k]]
            found = self.heap(codes[start : start + size[k]], int(seeds[k]), rate)
            ids.append(np.array(found, np.int64))
            owner.append(np.full(len(found), k))
        ids, owner = np.concatenate(ids), np.concatenate(owner)
        order = np.argsort(owner, kind="stable")
        ids, owner = self._as_bytes(ids[order], owner[order])
        return ids, np.bincount(owner, minlength=len(words))

    def merge(self, words: list[str], key: int, rate: float) -> tuple[np.ndarray, np.ndarray]:
        """(ids, sizes): the pieces of the words of one text, each by an agenda of its own."""
        seeds = _draws(np.array([key], np.uint64), np.array([len(words)]))
        return self._agendas(_codes(words), np.arange(len(words)), seeds, rate)

    def occurrences(self, table: list[str], number: np.ndarray, seeds: np.ndarray, rate: float) -> tuple[np.ndarray, np.ndarray]:
        """(ids, sizes): the pieces of the words ``table[k]`` for k in ``number``, as an agenda with its seed gives for each."""
        coded = _codes(table)
        count = np.bincount(number, minlength=len(table))
        shared = np.nonzero((count > 2) & (coded[1] < LONG) if rate else count)[0]
        made: list[tuple[np.ndarray, np.ndarray]] = [(np.empty(0, np.int64), np.empty(0, np.uint64))]
        ids, sizes = self._agendas(coded, shared, np.zeros(len(shared), np.uint64), 0.0, made if rate else None)
        where = np.full(len(table), -1)
        where[shared] = np.arange(len(shared))
        took = where[number]
        if rate:
            owner, places = (np.concatenate(x) for x in zip(*made))
            order = np.argsort(owner, kind="stable")
            places, n_made = places[order], np.bincount(owner, minlength=len(shared))
            first = np.cumsum(n_made) - n_made
            for at in range(0, len(number), _BLOCK):
                k = at + np.nonzero(took[at : at + _BLOCK] >= 0)[0]
                n = n_made[took[k]]
                took[np.repeat(k, n)[self._skipped(np.repeat(seeds[k], n) + places[runs(first[took[k]], n)], rate)]] = -1
            own = np.nonzero(took < 0)[0]
            took[own] = len(shared) + np.arange(len(own))
            own_ids, own_sizes = self._agendas(coded, number[own], seeds[own], rate)
            ids, sizes = np.concatenate((ids, own_ids)), np.concatenate((sizes, own_sizes))
        begin = np.cumsum(sizes) - sizes
        return ids[runs(begin[took], sizes[took])], sizes[took]

    # ---- texts ----

    def encode(self, texts: list[str | None], seed: str = SEED, rate: float = RATE) -> tuple[np.ndarray, np.ndarray]:
        """(ids, sizes): the pieces of all texts, one text's after the other's. Null and empty texts have none."""
        full = np.array([k for k, t in enumerate(texts) if t], np.int64)
        out = np.zeros(len(texts), np.int64)
        if not len(full):
            return np.empty(0, np.int64), out
        table, words_of = self._words(pa.array([texts[k] for k in full], pa.string()))
        counts = np.fromiter(map(len, words_of), np.int64, len(full))
        keys = np.fromiter((xxhash.xxh64_intdigest(texts[k]) for k in full), np.uint64, len(full)) + np.uint64(key_of(seed))
        ids, sizes = self.occurrences(table, np.concatenate(words_of), _draws(keys, counts), rate)
        out[full] = np.add.reduceat(sizes, np.cumsum(counts) - counts)
        return ids, out

    def _words(self, texts: pa.Array) -> tuple[list[str], list[np.ndarray]]:
        """The distinct words of texts, each with the spaces before it, and each text as their numbers."""
        lists = pc.split_pattern(texts, " ")
        coded = lists.flatten().dictionary_encode()
        table, number = [f" {w}" for w in coded.dictionary.to_pylist()], coded.indices.to_numpy().astype(np.int64)
        offsets = np.asarray(lists.offsets)
        found = [number[s:e] for s, e in zip(offsets, offsets[1:])]
        known: dict[str, int] = {}
        spaced = pc.or_(pc.match_substring(texts, "  "), pc.or_(pc.starts_with(texts, " "), pc.ends_with(texts, " ")))
        for k in np.nonzero(spaced.to_numpy(zero_copy_only=False))[0].tolist():  # several spaces belong to one word
            found[k] = np.array([len(table) + known.setdefault(w, len(known)) for w in _WORD.findall(" " + texts[k].as_py())], np.int64)
        return table + list(known), found

    def decode(self, ids: np.ndarray) -> str:
        """The text of one text's pieces."""
        raw = self.bytes[runs(self.byte_start[ids], self.byte_size[ids])].tobytes()
        return raw[1:].decode() if len(ids) else ""


@functools.lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    """The vocabulary, once in each worker process."""
    return Pieces(path)


def encode(
    docs: DataFrame, seed: str = SEED, rate: float = RATE, model: str = MODEL, digest_only: bool = False
) -> DataFrame:
    """(doc_id, n_pieces, pieces or digest, lossless): one row per row of ``docs``, over whole texts.

    ``lossless`` says whether the pieces decode to the text; ``digest`` is SHA-256 of the pieces as 32-bit little-endian numbers.
    Null and empty texts have no pieces (null decodes as empty). Equal texts have equal pieces under one seed; repeated rows stay; a
    null doc_id stays null. Other columns are not read. ``model`` must be readable by every executor.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    third = "digest string" if digest_only else "pieces array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pieces(model)
        for batch in batches:
            for part in text_slices(batch, "text", _SLICE):
                texts = part.column("text").to_pylist()
                ids, sizes = own.encode(texts, seed, rate)
                ends = np.concatenate(([0], np.cumsum(sizes)))
                each = [ids[s:e] for s, e in zip(ends, ends[1:])]
                same = [own.decode(x) == (t or "") for x, t in zip(each, texts)]
                if digest_only:
                    result = pa.array([hashlib.sha256(x.astype("<i4").tobytes()).hexdigest() for x in each])
                else:
                    result = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(sizes), result, pa.array(same, pa.bool_())], ["doc_id", "n_pieces", third.split()[0], "lossless"]
                )

    return small_batches(source).mapInArrow(run, f"doc_id long, n_pieces long, {third}, lossless boolean")
