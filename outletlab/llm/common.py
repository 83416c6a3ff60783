"""Helpers shared by the operators: byte views of Arrow text columns, texts in
parts, and vectorised 64-bit hashing of byte ranges."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

U64 = np.uint64
BASE = U64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
BASE_INVERSE = U64(pow(int(BASE), -1, 1 << 64))
BYTE_CODES = np.random.Generator(np.random.PCG64(20240501)).integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)

CACHED_POWERS = 1 << 20
WORD_BYTES = 1 << 20  # bytes of words hashed at once
LONG_WORD = 64  # bytes beyond which a word is hashed by XXH3: long words can be built to collide in polynomial hashes modulo 2**64

_powers: dict[str, np.ndarray] = {}


def text_blocks(column: pa.Array, max_bytes: int = 1 << 19) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) for runs of rows of at most
    ``max_bytes`` of UTF-8 (one longer row stands alone). Null counts as empty."""
    arr = pc.fill_null(column.cast(pa.large_string()), "")
    if len(arr) == 0:
        return
    offsets = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset: arr.offset + len(arr) + 1]
    raw = arr.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(arr):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + max_bytes, side="right")) - 1)
        yield lo, hi, data[offsets[lo]: offsets[hi]], offsets[lo: hi + 1] - offsets[lo]
        lo = hi


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser of 64-bit values (splitmix64)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """The first n powers of BASE or of its inverse; at most CACHED_POWERS are kept."""
    key = "inverse" if inverse else "base"
    if key not in _powers or len(_powers[key]) < n:
        steps = np.full(max(n, 1 << 16), BASE_INVERSE if inverse else BASE, np.uint64)
        steps[0] = 1
        made = np.cumprod(steps, dtype=np.uint64)
        if len(made) > CACHED_POWERS:
            return made[:n]
        _powers[key] = made
    return _powers[key][:n]


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """P with P[j] - P[i] = sum of code(data[k]) * BASE**k over i <= k < j."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_CODES[data] * powers(len(data)), out=out[1:])
    return out


def range_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of data[start:end] for each pair: equal bytes give equal hashes."""
    return mix((sums[end] - sums[start]) * powers(len(sums), True)[start] + (end - start).astype(np.uint64) * BASE)


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of data[start:end] for ordered words, WORD_BYTES at a time: equal
    words give equal hashes. Memory doesn't grow with the text but by the result."""
    out = np.empty(len(start), np.uint64)
    i = 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(end, start[i] + WORD_BYTES, side="right")))
        lo = start[i]
        if end[j - 1] - lo <= WORD_BYTES:
            out[i:j] = range_hash(prefix_sums(data[lo: end[j - 1]]), start[i:j] - lo, end[i:j] - lo)
        i = j
    for k in np.flatnonzero(end - start > LONG_WORD):
        out[k] = xxhash.xxh3_64_intdigest(data[start[k]: end[k]].tobytes())
    return out


def bytes_hash(value: bytes) -> int:
    """word_hashes of one word."""
    data = np.frombuffer(value, np.uint8)
    return int(word_hashes(data, np.array([0]), np.array([len(data)]))[0])


def runs(mask: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of True, cut where rows begin."""
    if not len(mask):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    start, end = mask.copy(), np.zeros(len(mask), bool)
    start[1:] &= ~mask[:-1]
    end[:-1] = mask[:-1] & ~mask[1:]
    end[-1] = mask[-1]
    cut = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(mask))]
    start[cut] |= mask[cut]
    end[cut - 1] |= mask[cut - 1]
    return np.flatnonzero(start), np.flatnonzero(end) + 1


BLANK = re.compile(rb"[\x20\x09-\x0d]")
PART_BYTES = 1 << 20


def text_parts(text: bytes, cut: re.Pattern = BLANK, size: int = PART_BYTES) -> Iterator[bytes]:
    """The text in parts of about ``size`` bytes that end where ``cut`` matches,
    so that no word is cut (a longer word makes a longer part)."""
    at = 0
    while at < len(text):
        found = cut.search(text, at + size)
        end = found.start() if found else len(text)
        yield text[at:end] if at or end < len(text) else text
        at = end
