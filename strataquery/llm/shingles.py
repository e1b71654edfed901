"""Word shingles of whole texts as 64-bit hashes, computed on bytes.

A-Z are lower-cased; words are runs of bytes other than 0x20 and 0x09 to 0x0D (no byte of a longer UTF-8
sequence is one of these). Word hashes are differences of a running sum of random values, one for each byte
at each offset in a word, so the cost of a text follows its bytes, whatever its words, and no texts are known
to collide (a polynomial modulo a power of two has such texts).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from .common import slices

_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_POWERS: dict[str, np.ndarray] = {}

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, n of each."""
    if len(_POWERS.get("base", ())) < n:
        for name, base in (("base", _BASE), ("inverse", pow(_BASE, -1, 1 << 64))):
            x = np.full(max(n, 1 << 21), base, np.uint64)
            x[0] = 1
            _POWERS[name] = np.multiply.accumulate(x)
    return _POWERS["base"][:n], _POWERS["inverse"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Offsets in a word whose random values stand in a table.
_TABLED = 64


def _value(byte_at: np.ndarray) -> np.ndarray:
    """A random value for each offset in a word and byte, given as 256 * offset + byte."""
    return mix(mix(byte_at.astype(np.uint64) + np.uint64(_BASE)) ^ np.uint64(0x94D049BB133111EB))


_TABLE = _value(np.arange(_TABLED << 8))


def running_hash(data: np.ndarray) -> np.ndarray:
    """g with n + 1 entries: (g[b] - g[a]) * inverse[a] depends on data[a:b] alone."""
    base, _ = _powers(len(data))
    g = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * base, out=g[1:])
    return g


def _bytes_of(texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts and where each text begins, with the end."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, 4 * texts.offset)
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], (offsets - offsets[0]).astype(np.int64)


def word_hashes(texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and the number of the first word of each text, with the end."""
    data, offsets = _bytes_of(texts)
    word = ~_SPACE[data]
    if not len(data):
        return np.empty(0, np.uint64), np.zeros(len(offsets), np.int64)
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    begins = word.copy()
    begins[1:] &= ~word[:-1] | first[1:-1]
    ends = word.copy()
    ends[:-1] &= ~word[1:] | first[1:-1]
    a, b = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    # a word's hash is the sum of a random value for each byte at its offset: differences of a running sum
    first_at = np.r_[0, a]
    kind = np.int32 if len(data) < 1 << 23 else np.int64
    offset = np.arange(len(data), dtype=kind) - np.repeat(first_at, np.diff(np.r_[first_at, len(data)])).astype(kind)
    at, beyond = (offset << 8) | _LOWER[data], np.flatnonzero((offset >= _TABLED) & word)
    values = _TABLE.take(at, mode="clip")
    values[beyond] = _value(at[beyond])
    g = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(values, out=g[1:])
    h = mix(g[b] - g[a] + (b - a).astype(np.uint64))
    return h, np.searchsorted(a, offsets)


def shingle_sets(texts: pa.StringArray, n: int) -> Iterator[np.ndarray]:
    """For each text its distinct shingles of n words, sorted; of fewer words the whole sequence is one."""
    sizes = np.diff(_bytes_of(texts)[1])
    for lo, hi in slices(sizes):
        h, at = word_hashes(texts.slice(lo, hi - lo))
        count = len(h) - n + 1
        full = np.full(max(count, 0), n, np.uint64)
        for j in range(n if count > 0 else 0):
            full = mix(full * np.uint64(0xD6E8FEB86659FD93) ^ h[j : j + count])
        for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            if b - a >= n:
                yield np.unique(full[a : b - n + 1])
            elif b > a:
                x = b - a
                for w in h[a:b].tolist():
                    x = int(mix(np.array([(x * 0xD6E8FEB86659FD93 & _MASK) ^ w], np.uint64))[0])
                yield np.array([x], np.uint64)
            else:
                yield np.empty(0, np.uint64)


def set_key(values: np.ndarray) -> tuple[int, int]:
    """Two 64-bit hashes of a sorted set, signed."""
    if not len(values):
        return 0, 0
    a, b = np.bitwise_xor.reduce(mix(values)), np.add.reduce(mix(values ^ np.uint64(0xA5A5A5A5A5A5A5A5)))
    return tuple(np.array([a, b], np.uint64).view(np.int64).tolist())
