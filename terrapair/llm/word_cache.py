"""Per-worker cache from word hashes to token ids or counts."""

from __future__ import annotations

import numpy as np

from terrapair.llm import _text as T


class WordCache:
    """Sorted word hashes with a run of values each; emptied when MAX_WORDS are held."""

    MAX_WORDS = 1_500_000

    def __init__(self, dtype):
        self.dtype = dtype
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(0, T.U64)
        self.first = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)
        self.flat: np.ndarray = np.zeros(1 << 16, self.dtype)
        self.used = 0

    def rows(self, words: T.Words, raw: bytes, encode) -> np.ndarray:
        """The row of each word; words that are new go through encode(list of bytes)."""
        uniq, at, inverse = np.unique(words.hash, return_index=True, return_inverse=True)
        if len(self.keys) + len(uniq) > self.MAX_WORDS:
            self._clear()
        where = np.searchsorted(self.keys, uniq)
        if len(self.keys):
            have = self.keys[np.minimum(where, len(self.keys) - 1)] == uniq
        else:
            have = np.zeros(len(uniq), bool)
        new = np.flatnonzero(~have)
        if len(new):
            got = encode([raw[a:b] for a, b in zip(words.start[at[new]].tolist(), words.end[at[new]].tolist())])
            sizes = np.fromiter(map(len, got), np.int64, len(got))
            values = np.concatenate([np.asarray(x, self.dtype) for x in got]) if isinstance(got[0], np.ndarray) else np.fromiter((y for x in got for y in x), self.dtype, int(sizes.sum()))
            while self.used + len(values) > len(self.flat):
                self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
            self.flat[self.used : self.used + len(values)] = values
            first = self.used + np.cumsum(sizes) - sizes
            self.used += len(values)
            self.keys = np.insert(self.keys, where[new], uniq[new])
            self.first = np.insert(self.first, where[new], first)
            self.size = np.insert(self.size, where[new], sizes)
            where = np.searchsorted(self.keys, uniq)
        return where[inverse.reshape(-1)]
