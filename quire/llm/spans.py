"""Words and n-grams of a whole Arrow batch as numpy arrays, without a Python string per word.

Texts stay in their UTF-8 buffer. Every separator used here is ASCII, so byte
positions are exact for any script. Hashes are polynomials over Z/2**64 with a
random 64-bit value for each byte, finished by a bijective mixer.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

#: ``[\x20\x09-\x0D]``
SPACES = bytes([0x20, *range(0x09, 0x0E)])
#: Every ASCII character that is neither a letter nor a digit.
NOT_ALNUM = bytes(b for b in range(128) if not chr(b).isalnum())

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
#: Texts are handled in runs of about so many bytes; a longer text is a run of its own.
RUN_BYTES = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words whose output bits depend on all input bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _byte_values(fold_case: bool) -> np.ndarray:
    values = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
    if fold_case:
        values[65:91] = values[97:123]
    return values


class _Powers:
    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, RUN_BYTES + 1)
            up, down = np.full(size, _BASE, np.uint64), np.full(size, _BASE_INVERSE, np.uint64)
            up[0] = down[0] = 1
            self.up, self.down = np.multiply.accumulate(up), np.multiply.accumulate(down)
        return self.up, self.down


_powers = _Powers()


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts one after the other, and len + 1 offsets; a null text is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def runs(offsets: np.ndarray, size: int = RUN_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts that hold about ``size`` bytes each."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
        yield first, min(last, n)
        first = min(last, n)


def words(data: np.ndarray, offsets: np.ndarray, separators: bytes = SPACES, fold_case: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of each word, first word index of each text and the total), in text order."""
    hashes, first, _ = word_spans(data, offsets, separators, fold_case)
    return hashes, np.searchsorted(first, offsets)


def word_spans(data: np.ndarray, offsets: np.ndarray, separators: bytes = SPACES, fold_case: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(64-bit hash of each word, its first byte, the byte after its last), in text order."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = np.ones(256, bool)
    inside[list(separators)] = False
    here = inside[data]
    starts, ends = here.copy(), here.copy()
    starts[1:] &= ~here[:-1]
    ends[:-1] &= ~here[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < n)]
    starts[edges] = here[edges]
    ends[edges - 1] = here[edges - 1]
    first, last = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    up, down = _powers.upto(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_byte_values(fold_case)[data] * up[:n], out=sums[1:])
    return mix((sums[last] - sums[first]) * down[first] + (last - first).astype(np.uint64)), first, last


def shingles(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the k-word windows of one text; a shorter text is one window, an empty one none."""
    n = len(hashes)
    if n == 0:
        return hashes
    width = min(k, n)
    out = np.full(n - width + 1, width, np.uint64)
    for i in range(width):
        out = mix(out ^ hashes[i : n - width + 1 + i]) * np.uint64(0xC2B2AE3D27D4EB4F)
    return mix(out)


class Memo:
    """Values of words by hash, found for whole arrays at once and forgotten all at once when there are too many."""

    def __init__(self, most: int = 3_000_000) -> None:
        self.most = most
        self.keys, self.values = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def full(self) -> bool:
        return len(self.keys) > self.most

    def clear(self) -> None:
        self.__init__(self.most)

    def get(self, keys: np.ndarray, make: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """The value of every key; ``make`` gets where the unknown ones first stand and returns their values."""
        distinct, where, back = np.unique(keys, return_index=True, return_inverse=True)
        at = np.searchsorted(self.keys, distinct)
        known = at < len(self.keys)
        known[known] = self.keys[at[known]] == distinct[known]
        found = np.zeros(len(distinct), np.int64)
        found[known] = self.values[at[known]]
        if not known.all():
            new = ~known
            found[new] = make(where[new])
            self.keys, self.values = np.insert(self.keys, at[new], distinct[new]), np.insert(self.values, at[new], found[new])
        return found[back]
