"""Words and shingles of whole texts as 64-bit hashes, an Arrow batch at a time.

A word is a maximal run of bytes outside space and \\t\\n\\v\\f\\r, with A-Z
lower-cased and all other bytes as they are. Everything is computed on the
UTF-8 buffer of a slice of rows, so no Python object is made per word.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of text that are hashed at once; a longer text is a slice of its own.
SLICE_BYTES = 1 << 20
_POSITIONS = 1 << 14
# Bytes of a word that are hashed together with those of the other words.
_LONG = 48


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective mixing of unsigned 64-bit integers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _draws(n: int, seed: int) -> np.ndarray:
    steps = np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed) * np.uint64(1 << 32)
    return mix(steps * np.uint64(0x9E3779B97F4A7C15))


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Separators of words that consist of letters: all of ASCII but A-Z and a-z.
NO_LETTER = np.zeros(256, dtype=bool)
NO_LETTER[:128] = True
NO_LETTER[65:91] = NO_LETTER[97:123] = False
_LOWER = np.arange(256)
_LOWER[65:91] += 32
_OF_BYTE = _draws(256, 1)[_LOWER]
_OF_POSITION = _draws(_POSITIONS, 2) | np.uint64(1)
_OF_PLACE = _draws(64, 3) | np.uint64(1)


class Slice(NamedTuple):
    """Rows lo..hi of a batch: their bytes, word hashes, and where each row's words start."""

    lo: int
    hi: int
    data: np.ndarray
    bounds: np.ndarray  # byte offset of each row, and the end
    words: np.ndarray  # hash of each word
    starts: np.ndarray  # first byte of each word
    ends: np.ndarray  # byte after each word
    first: np.ndarray  # first word of each row, and the end


def _hash_words(data: np.ndarray, bounds: np.ndarray, between: np.ndarray) -> tuple[np.ndarray, ...]:
    outside = between[data]
    opens, closes = ~outside, ~outside
    opens[1:] &= outside[:-1]
    closes[:-1] &= outside[1:]
    first, last = bounds[:-1][bounds[:-1] < len(data)], bounds[1:][bounds[1:] > 0] - 1
    opens[first], closes[last] = ~outside[first], ~outside[last]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    lengths = ends - starts
    # Longest words first, so those with a byte at a place are the first ones; what is above _LONG bytes, word by word.
    short = np.minimum(lengths, _LONG + 1).astype(np.uint8)
    order = np.argsort(_LONG + 1 - short, kind="stable")
    at = starts[order]
    longer = len(at) - np.cumsum(np.bincount(short, minlength=_LONG + 2))
    sums = np.zeros(len(at), dtype=np.uint64)
    for place in range(_LONG):
        n = longer[place]
        if not n:
            break
        sums[:n] += _OF_BYTE[data[at[:n] + place]] * _OF_POSITION[place]
    for k in range(longer[_LONG]):
        rest = data[at[k] + _LONG : ends[order[k]]]
        sums[k : k + 1] += (_OF_BYTE[rest] * _OF_POSITION[np.arange(_LONG, _LONG + len(rest)) % _POSITIONS]).sum(dtype=np.uint64)
    total = np.empty_like(sums)
    total[order] = sums
    return mix(total + lengths.astype(np.uint64)), starts, ends


def slices(column: pa.Array, limit: int = SLICE_BYTES, between: np.ndarray = _SPACE) -> Iterator[Slice]:
    """Hashed words of a text column, in slices of whole rows; null counts as empty.

    ``between`` tells for each byte value whether it separates words.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    if not n:
        return
    _, offsets, values = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(values, dtype=np.uint8) if values else np.zeros(0, dtype=np.uint8)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(n, max(lo + 1, hi))
        part = data[offsets[lo] : offsets[hi]]
        bounds = offsets[lo : hi + 1] - offsets[lo]
        words, starts, ends = _hash_words(part, bounds, between)
        yield Slice(lo, hi, part, bounds, words, starts, ends, np.searchsorted(starts, bounds))
        lo = hi


def stems(part: Slice, size: int) -> np.ndarray:
    """Hash of the first ``size`` bytes of each word, of shorter words as a whole."""
    total = np.zeros(len(part.words), dtype=np.uint64)
    last = max(0, len(part.data) - 1)
    for k in range(size):
        at = part.starts + k
        term = _OF_BYTE[part.data[np.minimum(at, last)]] * _OF_POSITION[k] if len(total) else total
        total += np.where(at < part.ends, term, np.uint64(0))
    return mix(total + np.uint64(size << 32))


def chain(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` consecutive words, by its first word."""
    total = np.zeros(max(0, len(words) - size + 1), dtype=np.uint64)
    for place in range(size):
        total += words[place : place + len(total)] * _OF_PLACE[place % len(_OF_PLACE)]
    return mix(total + np.uint64(size))


def shingle_sets(part: Slice, size: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each row of a slice.

    A row with fewer than ``size`` words has its whole sequence as one shingle;
    one without words has none.
    """
    runs = chain(part.words, size)
    for k in range(part.hi - part.lo):
        a, b = part.first[k], part.first[k + 1]
        if b - a >= size:
            yield np.unique(runs[a : b - size + 1])
        elif b > a:
            yield chain(part.words[a:b], int(b - a))
        else:
            yield np.zeros(0, dtype=np.uint64)
