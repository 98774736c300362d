"""Vectorised byte and word work on Arrow batches of texts, shared by the operators.

A word is a maximal run of ASCII letters, digits and non-ASCII bytes of the
lower-cased text. Hashes are 64-bit polynomial hashes, computed for a whole
batch from prefix sums, so no Python object is made per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20

_MULTIPLIER = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
_ROOM = 64

IS_WORD = np.zeros(256, dtype=bool)
IS_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    h = values.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64))
_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the multiplier and of its inverse, kept for the next call."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, CHUNK_BYTES + _ROOM)
        for values in (_MULTIPLIER, _INVERSE):
            table = np.full(size, values, dtype=np.uint64)
            table[0] = 1
            _powers.append(np.cumprod(table, dtype=np.uint64))
        del _powers[:-2]
    return _powers[0][:n], _powers[1][:n]


def prefix_sums(codes: np.ndarray) -> np.ndarray:
    """Sums from which ``span_hashes`` takes the hash of any span."""
    up, _ = powers(len(codes))
    sums = np.zeros(len(codes) + 1, dtype=np.uint64)
    np.cumsum(codes * up, out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    _, down = powers(len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, row offsets) of pieces with at most ``limit`` bytes; one row is never cut."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)
    at = at[column.offset : column.offset + len(column) + 1].astype(np.int64)
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(at, at[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), len(column))
        yield first, last, whole[at[first] : at[last]], at[first : last + 1] - at[first]
        first = last


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, hashes, first word of each row) of all words; a word never crosses rows."""
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = IS_WORD[data]
    begins = inside[1:] & ~inside[:-1]
    stops = inside[:-1] & ~inside[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    crossing = cuts[inside[cuts] & inside[cuts + 1]]
    begins[crossing] = True
    stops[crossing] = True
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops)
    hashes = span_hashes(prefix_sums(BYTE_CODES[data]), starts, ends) if len(starts) else np.zeros(0, np.uint64)
    return starts, ends, hashes, np.searchsorted(starts, offsets)


def grams(hashes: np.ndarray, steps: tuple[int, ...]) -> np.ndarray:
    """A hash for the words at each position and at the given distances behind it."""
    n = max(len(hashes) - steps[-1], 0) if steps else len(hashes)
    out = hashes[:n] * np.uint64(0xD6E8FEB86659FD93) + np.uint64(len(steps))
    for step in steps:
        out = mix(out + np.uint64(step)) + hashes[step : step + n] * np.uint64(0xA0761D6478BD642F)
    return mix(out)


def row_of(firsts: np.ndarray, n: int) -> np.ndarray:
    """The row of each of n words, given the first word of each row."""
    return np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))[:n]


def shingles(hashes: np.ndarray, firsts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, rows) of the word shingles of every row; a row of fewer words has one shingle of all of them."""
    all_grams = grams(hashes, tuple(range(1, size)))
    rows = row_of(firsts, len(hashes))
    whole = rows[: len(all_grams)] == rows[len(hashes) - len(all_grams) :] if len(all_grams) else np.zeros(0, bool)
    counts = np.diff(firsts)
    short = np.flatnonzero((counts > 0) & (counts < size))
    few = []
    for row in short:
        own = hashes[firsts[row] : firsts[row + 1]]
        few.append(grams(own, tuple(range(1, len(own))))[0])
    values = np.concatenate([all_grams[whole], np.array(few, dtype=np.uint64)])
    at = np.concatenate([rows[: len(all_grams)][whole], short])
    order = np.argsort(at, kind="stable")
    return values[order], at[order]
