"""Words of UTF-8 text columns as arrays of 64-bit hashes.

A word is a maximal run of ASCII letters, digits and bytes from 0x80 on (any
character beyond ASCII); A-Z count as a-z.  Everything works on the byte
buffer of an Arrow column at once, so no Python object is made per word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

#: Bytes of text handled at a time (one longer text is handled alone).
CHUNK_BYTES = 1 << 19

#: Values of a segment that is hashed as a polynomial at most.
LONG = 256

_MUL = np.uint64(0x9E3779B97F4A7C15)
_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

_BYTES = np.arange(256)
IS_WORD = ((_BYTES >= 48) & (_BYTES <= 57)) | ((_BYTES | 32) >= 97) & ((_BYTES | 32) <= 122) & (_BYTES < 128) | (_BYTES >= 128)
_LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (the splitmix finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_VALUE = mix(_LOWER.astype(np.uint64) + np.uint64(1))
_POW: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the hash's multiplier and of its inverse."""
    if len(_POW.get("up", ())) < n:
        m = max(n, CHUNK_BYTES)
        for key, base in (("up", _MUL), ("down", _INV)):
            p = np.full(m, base, np.uint64)
            p[0] = 1
            _POW[key] = np.multiply.accumulate(p)
    return _POW["up"][:n], _POW["down"][:n]


def segment_hashes(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """One hash for each segment [start, end) of a sequence of 64-bit values,
    the same wherever the segment lies.  Up to LONG values it is a polynomial
    modulo 2^64; some longer segments of two values (the Thue-Morse word and
    its complement, from 1,024 on) have the same one for every odd base, so
    longer ones are hashed by their bytes."""
    up, down = powers(len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:len(values)], out=total[1:])
    out = mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))
    for i in np.flatnonzero(end - start > LONG):
        out[i] = xxhash.xxh3_64_intdigest(np.ascontiguousarray(values[start[i]:end[i]]))
    return out


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; a null counts as empty."""
    column = column.fill_null("") if column.null_count else column
    column = column.cast(pa.large_utf8())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data is not None and at[-1] > at[0] else np.zeros(0, np.uint8)
    return data, at - at[0]


def chunks(batches: Iterator[pa.RecordBatch], text: str = "text", size: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most ``size`` bytes of text each, or one row."""
    for batch in batches:
        _, at = utf8(batch.column(text))
        row = 0
        while row < batch.num_rows:
            to = max(row + 1, int(np.searchsorted(at, at[row] + size, "right")) - 1)
            yield batch.slice(row, to - row)
            row = to
        # The worker lives on for other stages: unused memory goes back.
        pa.default_memory_pool().release_unused()


def word_spans(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, first): byte spans of all words, and the index of each
    row's first word (with the number of words at the end)."""
    n = len(data)
    flag = np.zeros(n + 1, bool)
    flag[:n] = IS_WORD[data]
    cut = np.zeros(n + 1, bool)
    cut[at] = True
    start = flag.copy()
    start[1:] &= ~flag[:-1] | cut[1:]
    start[n] = False
    end = np.zeros(n + 1, bool)
    end[1:] = flag[:-1] & (~flag[1:] | cut[1:])
    start, end = np.flatnonzero(start), np.flatnonzero(end)
    return start, end, np.searchsorted(start, at)


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first): the hashes of all words of a text column in order, and
    the index of each row's first word (with the number of words at the end)."""
    data, at = utf8(column)
    start, end, first = word_spans(data, at)
    return segment_hashes(_VALUE[data], start, end), first


def runs(first: np.ndarray) -> np.ndarray:
    """The row of each word."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))
