"""Byte-level helpers on Arrow text columns, used inside tasks.

All work on UTF-8 bytes of whole texts: a word of the contracts is a run of bytes of one class, as every
non-ASCII code point consists of bytes from 0x80 on.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

CHUNK = 1 << 19  # bytes of text worked on at once; one longer text is a chunk of its own

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

NOT_SPACE = np.ones(256, bool)  # [^\x20\x09-\x0D]
NOT_SPACE[[9, 10, 11, 12, 13, 32]] = False

LETTER_OR_DIGIT = np.zeros(256, bool)  # [^\x00-\x2F\x3A-\x60\x7B-\x7F], once lower-cased
LETTER_OR_DIGIT[48:58] = LETTER_OR_DIGIT[97:123] = LETTER_OR_DIGIT[128:] = True

_BASE = 0x9E3779B97F4A7C15
_STEP = np.uint64(_BASE)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finaliser of a splitmix generator)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE_VALUES = mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * _STEP)


class _Powers:
    """Powers of an odd number modulo 2**64, and of its inverse, as far as they were asked for."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            base = _BASE * 2 + 1 & 0xFFFFFFFFFFFFFFFF
            self.up, self.down = (
                np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, b, np.uint64)]), dtype=np.uint64)
                for b in (base, pow(base, -1, 1 << 64)))
        return self.up[:n], self.down[:n]


_powers = _Powers()


def texts(column: pa.Array, limit: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole texts: first row, row after the last, their bytes, offsets into these. Null is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        yield first, last, data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first]
        first = last


def words(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and for every text edge the number of words before it."""
    inside = is_word[data]
    before, after = np.zeros_like(inside), np.zeros_like(inside)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    before[offsets[:-1][offsets[:-1] < len(data)]] = False
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums of a polynomial over the bytes, modulo 2**64; see :func:`span_hashes`."""
    up, _ = _powers.of(len(data))
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_VALUES[data] * up, out=out[1:])
    return out


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte runs that depend on their bytes alone."""
    _, down = _powers.of(len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * _STEP)


_LANE_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_LONG_WORD = 4096  # bytes; longer ones are hashed one by one


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte runs, eight bytes at a time; runs of equal length up to eight bytes never meet.

    Every step mixes the state before the next bytes come in, so that no fixed pair of strings is known to meet,
    as is the case for polynomials modulo a power of two.
    """
    sizes = ends - starts
    state = mix((sizes + 1).astype(np.uint64) * _STEP)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    lanes = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
    live = np.flatnonzero((sizes > 0) & (sizes <= _LONG_WORD))
    at, left = starts[live], sizes[live]
    while len(live):
        state[live] = mix((state[live] ^ (lanes[at] & _LANE_MASKS[np.minimum(left, 8)])) + _STEP)
        on = left > 8
        live, at, left = live[on], at[on] + 8, left[on] - 8
    for i in np.flatnonzero(sizes > _LONG_WORD):
        state[i] = xxhash.xxh64_intdigest(data[starts[i]:ends[i]])
    return state


def sequence_hashes(items: np.ndarray, length: int, salt: int = 0) -> np.ndarray:
    """Hashes of all runs of ``length`` items, by doubling; runs may cross from one text into the next."""
    count = len(items) - length + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    out, size = mix(items ^ np.uint64(salt)), 1

    def joined(step: int) -> np.ndarray:
        return mix(mix(out[:-step] + _STEP) ^ (out[step:] * np.uint64(_BASE | 1)))

    while size * 2 <= length:
        out, size = joined(size), size * 2
    return joined(length - size) if size < length else out


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """All numbers of the ranges [start, start + count), one range after the other."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    firsts = np.repeat(starts - (np.cumsum(counts) - counts), counts)
    return firsts + np.arange(total)
