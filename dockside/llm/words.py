"""Words of a batch of texts, coded once per batch."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def read_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(ids, starts, names): text i has the words ``names[k]`` for k in ``ids[starts[i]:starts[i + 1]]``.

    Words stand between white space; they are lowered and keep only letters and digits. A word without any is left out. Null
    is read as empty.
    """
    lists = pc.utf8_split_whitespace(pc.fill_null(texts, ""))
    coded = lists.flatten().dictionary_encode()
    raw = pc.replace_substring_regex(pc.utf8_lower(coded.dictionary), r"[^\p{L}\p{N}]+", "").dictionary_encode()
    names = raw.dictionary
    ids = raw.indices.to_numpy()[coded.indices.to_numpy()] if len(coded) else np.empty(0, np.int32)
    keep = ids != pc.index(names, "").as_py()
    offsets = np.asarray(lists.offsets) - lists.offsets[0].as_py()
    return ids[keep].astype(np.int64), np.concatenate(([0], np.cumsum(keep)))[offsets], names


def runs(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of each run, one run after the other."""
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(starts, sizes)
