"""Words and word shingles of many texts at once, on their UTF-8 bytes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_UNBASE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
STEP = np.uint64(0xD6E8FEB86659FD93)


class Words:
    """The words of some texts: where they are, a hash of each, and the document each belongs to.

    Words are runs of digits, letters and non-ASCII characters after A-Z are
    lower-cased. Everything works on the UTF-8 bytes of all texts at once.
    """

    def __init__(self, texts: pa.Array):
        texts = texts.fill_null("").cast(pa.large_string())
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        first = int(offsets[0]) if len(texts) else 0
        size = int(offsets[-1]) - first if len(texts) else 0
        raw = np.frombuffer(texts.buffers()[2], np.uint8)[first : first + size] if size else np.zeros(0, np.uint8)
        self.lower = _LOWER[raw]
        word = _WORD[self.lower]
        cut = np.zeros(size + 1, bool)
        cut[offsets - first] = True
        before = np.concatenate([[False], word[:-1]]) if size else word
        after = np.concatenate([word[1:], [False]]) if size else word
        self.starts = np.flatnonzero(word & (~before | cut[:-1]))
        self.ends = np.flatnonzero(word & (~after | cut[1:])) + 1
        self.first = np.searchsorted(self.starts, offsets - first)
        self.doc = np.repeat(np.arange(len(texts)), np.diff(self.first))
        powers = np.full(size + 1, _BASE, np.uint64)
        powers[0] = 1
        np.multiply.accumulate(powers, out=powers)
        sums = np.zeros(size + 1, np.uint64)
        np.cumsum((self.lower.astype(np.uint64) + np.uint64(1)) * powers[:-1], out=sums[1:])
        shift = np.full(size + 1, _UNBASE, np.uint64)
        shift[0] = 1
        np.multiply.accumulate(shift, out=shift)
        self.hash = mixed((sums[self.ends] - sums[self.starts]) * shift[self.starts])

    def shingles(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(first word, hash) of each run of k words inside one document."""
        n = len(self.hash) - k + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        total = self.hash[:n].copy()
        for j in range(1, k):
            total *= STEP
            total += self.hash[j : j + n]
        inside = self.doc[:n] == self.doc[k - 1 :]
        at = np.flatnonzero(inside)
        return at, mixed(total[at] + np.uint64(k))

    def run(self, first: int, n: int) -> tuple[bytes, ...]:
        """The words themselves."""
        return tuple(self.lower[a:b].tobytes() for a, b in zip(self.starts[first : first + n], self.ends[first : first + n], strict=True))


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x7FB5D329728EA185)
    return h ^ (h >> np.uint64(27))
