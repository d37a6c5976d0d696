"""Word shingles of texts as 64-bit hashes, vectorised over many texts at once."""

from __future__ import annotations

import numpy as np

from .common import GOLDEN, RollingHash, mix64, text_runs

SHINGLE_WORDS = 5

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Lower-cases A-Z only.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def word_bounds(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, past, text number) of all words; words are split at white space and at the ends of texts."""
    space = _SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.concatenate([[True], space])
    start = np.flatnonzero(~space & (before[:-1] | edge[:-1]))
    after = np.concatenate([space, [True]])
    past = np.flatnonzero(~space & (after[1:] | edge[1:])) + 1
    return start, past, np.searchsorted(offsets, start, side="right") - 1


def shingle_sets(array, words: int = SHINGLE_WORDS):
    """Yield (first row, counts, hashes): for each text of a run its number of distinct shingles; the sorted distinct hashes
    follow one another. A text with fewer words (but some) has its whole sequence as its one shingle."""
    for row, past, offsets, data in text_runs(array):
        data = LOWER[data]
        texts = past - row
        start, end, text = word_bounds(offsets, data)
        if not len(start):
            yield row, np.zeros(texts, np.int64), np.zeros(0, np.uint64)
            continue
        word = RollingHash(data).spans(start, end)
        n = np.bincount(text, minlength=texts)
        first = np.cumsum(n) - n
        size = np.minimum(n, words)[text]
        # the shingle that starts at each word, where enough words follow
        place = np.arange(len(word)) - first[text]
        whole = place + size <= n[text]
        padded = np.concatenate([word, np.zeros(words, np.uint64)])
        value = np.zeros(len(word), np.uint64)
        for k in range(words):
            value = np.where(k < size, mix64(value * GOLDEN + padded[k : k + len(word)]), value)
        value, text = value[whole] + size[whole].astype(np.uint64), text[whole]
        order = np.lexsort((value, text))
        value, text = value[order], text[order]
        fresh = np.concatenate([[True], (value[1:] != value[:-1]) | (text[1:] != text[:-1])])
        yield row, np.bincount(text[fresh], minlength=texts), value[fresh]
