"""Sets of word shingles as 64-bit hashes, computed for many texts at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from tourlens.llm.common import bytes_and_offsets

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
#: Bytes of text whose shingles are made together: some hundred bytes are held for each.
TOGETHER = 1 << 18


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, A-Z lower-cased, and the number of words of each text.

    Words are runs without ASCII white space.
    """
    raw, offsets = bytes_and_offsets(array)
    raw = _LOWER[raw]
    word = ~_SPACE[raw]
    begins = word.copy()
    begins[1:] &= ~word[:-1]
    begins[offsets[:-1][offsets[:-1] < len(raw)]] = True  # a text's first word is no part of the last one before
    begins &= word
    starts = np.flatnonzero(begins)
    n_words = np.diff(np.searchsorted(starts, offsets))
    if not len(starts):
        return np.empty(0, np.uint64), n_words
    raw = raw[word].astype(np.uint64) + np.uint64(1)
    starts = (np.cumsum(word) - 1)[starts]
    lengths = np.diff(starts, append=len(raw))
    with np.errstate(over="ignore"):
        powers = np.full(lengths.max(), _BASE, np.uint64)
        powers[0] = 1
        powers = np.multiply.accumulate(powers)
        raw *= powers[np.arange(len(raw)) - np.repeat(starts, lengths)]
        return mixed(np.add.reduceat(raw, starts) + lengths.astype(np.uint64)), n_words


def shingle_sets(array: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of k-word shingles of each text, ascending, and where each text's begin.

    A text with fewer words is one shingle.
    """
    words, n_words = word_hashes(array)
    doc = np.repeat(np.arange(len(array)), n_words)
    first = np.cumsum(n_words) - n_words
    place = np.arange(len(words)) - first[doc]
    left = n_words[doc] - place
    with np.errstate(over="ignore"):
        hashes = np.full(len(words), k, np.uint64)
        for j in range(k):
            step = np.zeros(len(words), np.uint64)
            step[: max(len(words) - j, 0)] = words[j:]
            step[left <= j] = j  # beyond the text's last word
            hashes = mixed(hashes * np.uint64(0xD6E8FEB86659FD93) + step)
    keep = (left >= k) | ((n_words[doc] < k) & (place == 0))
    hashes, doc = hashes[keep], doc[keep]
    order = np.lexsort((hashes, doc))
    hashes, doc = hashes[order], doc[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
    sizes = np.bincount(doc[new], minlength=len(array))
    return hashes[new], np.concatenate([[0], np.cumsum(sizes)])
