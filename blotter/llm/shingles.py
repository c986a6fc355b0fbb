"""Word shingles of whole texts as sorted 64-bit hashes, with numpy over many texts at a time."""

from __future__ import annotations

import numpy as np

from blotter.llm.common import distinct, mix64, slices

SHINGLE = 5
CHUNK_BYTES = 1 << 19  # text hashed together, which bounds a task's memory
_BASE = 0x9E3779B97F4A7C15 | 1


class WordHasher:
    """Hashes of the ``[^\\x20\\x09-\\x0D]+`` words of UTF-8 texts; A-Z count as a-z."""

    def __init__(self) -> None:
        lower = np.arange(256, dtype=np.uint64)
        lower[65:91] += np.uint64(32)
        self.code = mix64(lower + np.uint64(0xD1B54A32D192ED03)) | np.uint64(1)
        self.space = np.zeros(256, bool)
        self.space[[9, 10, 11, 12, 13, 32]] = True
        self.up = self.down = np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.up) < n:
            n = max(n, 2 * len(self.up), 2 * CHUNK_BYTES)
            with np.errstate(over="ignore"):
                up = np.full(n, _BASE, np.uint64)
                down = np.full(n, pow(_BASE, -1, 1 << 64), np.uint64)
                up[0] = down[0] = 1
                self.up, self.down = np.cumprod(up), np.cumprod(down)

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(hash of each word, number of words of each text), in order."""
        data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        self._powers(len(data) + 1)
        gap = self.space[data]
        edges = np.flatnonzero(np.diff(np.concatenate([[True], gap, [True]]).astype(np.int8)))
        starts, ends = edges[::2], edges[1::2]
        with np.errstate(over="ignore"):
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.code[data] * self.up[:len(data)])])
            words = mix64((sums[ends] - sums[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))
        bounds = np.cumsum([0] + [len(t) + 1 for t in texts])
        return words, np.diff(np.searchsorted(starts, bounds))


def _shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    n = len(words) - size + 1
    with np.errstate(over="ignore"):
        total = np.full(n, size, np.uint64)
        factors = mix64(np.arange(1, size + 1, dtype=np.uint64)) | np.uint64(1)  # unrelated, so order counts
        for k in range(size):
            total += words[k:n + k] * factors[k]
    return mix64(total)


def shingle_sets(column: list[bytes], hasher: WordHasher):
    """For each text the sorted distinct hashes of its 5-word shingles; of a
    text with fewer words, the one hash of its whole sequence; none without words."""
    for a, z in slices(np.array([len(t) for t in column], np.int64), CHUNK_BYTES):
        words, counts = hasher(column[a:z])
        every = _shingle_hashes(words, SHINGLE) if len(words) >= SHINGLE else np.zeros(0, np.uint64)
        at = 0
        for n in counts.tolist():
            if n >= SHINGLE:
                yield distinct(every[at:at + n - SHINGLE + 1])[0]
            elif n:
                yield _shingle_hashes(words[at:at + n], n)
            else:
                yield np.zeros(0, np.uint64)
            at += n


def set_id(tokens: np.ndarray) -> int:
    """One 64-bit id per set of tokens."""
    with np.errstate(over="ignore"):
        return int(mix64(np.array([mix64(tokens).sum() + np.uint64(len(tokens))], np.uint64))[0])
