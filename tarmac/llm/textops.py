"""Word and shingle hashing of whole Arrow text columns in numpy.

Words are the runs ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z. A word's hash
is a polynomial over its bytes (a random 64-bit value per byte, an odd
multiplier) and a final mix; ``TERMS`` are runs of letters, digits and non-ASCII
characters instead. Texts are worked through in slices of a few MB, so
memory does not follow the batch size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
SHINGLE = 5
_U = np.uint64


def mix64(x: np.ndarray) -> np.ndarray:
    """SplitMix64's finaliser."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> _U(30)
        x *= _U(0xBF58476D1CE4E5B9)
        x ^= x >> _U(27)
        x *= _U(0x94D049BB133111EB)
        x ^= x >> _U(31)
    return x


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))
_BYTE[ord("A"):ord("Z") + 1] = _BYTE[ord("a"):ord("z") + 1]
_BYTE[_SPACE] = 0
#: (separator bytes, value of each byte) of the alphabets that word_hashes knows
WORDS = (_SPACE, _BYTE)
_NO_TERM = np.ones(256, bool)
_NO_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
TERMS = (_NO_TERM, np.where(_NO_TERM, _U(0), _BYTE))
_MULT = 0x5851F42D4C957F2D
_pow = np.ones(1, np.uint64)
_COEF = mix64(np.arange(101, 101 + SHINGLE, dtype=np.uint64)) | _U(1)


def _powers(n: int) -> np.ndarray:
    global _pow
    if len(_pow) < n:
        m = np.full(max(n, 4096), _MULT, np.uint64)
        m[0] = 1
        with np.errstate(over="ignore"):
            _pow = np.cumprod(m, dtype=np.uint64)
    return _pow


def slices(arr: pa.Array, limit: int | None = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yields (first row, end row, bytes, row offsets into them) in slices of about
    ``limit`` bytes (None: all at once); a null is empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if arr.null_count:
        arr = arr.fill_null(b"" if pa.types.is_binary(arr.type) else "")
    big = pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type)
    bufs = arr.buffers()
    offs = np.frombuffer(bufs[1], np.int64 if big else np.int32)[arr.offset:arr.offset + len(arr) + 1].astype(np.int64)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.empty(0, np.uint8)
    i, n = 0, len(arr)
    while i < n:
        j = n if limit is None else min(n, max(i + 1, int(np.searchsorted(offs, offs[i] + limit, "right")) - 1))
        yield i, j, data[offs[i]:offs[j]], offs[i:j + 1] - offs[i]
        i = j


def word_endings(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """A hash of the last two bytes (lower-cased) of each word."""
    word = ~_SPACE[data]
    first = np.zeros(len(data) + 1, bool)
    first[offs[:-1]] = True
    first = first[:len(data)]
    end = word.copy()
    end[:-1] &= ~word[1:] | first[1:]
    e = np.flatnonzero(end)
    alone = first[e] | (e == 0)
    before = data[np.maximum(e - 1, 0)]
    with np.errstate(over="ignore"):
        return mix64(_BYTE[data[e]] * _U(3) + np.where(alone, _U(0), _BYTE[before]))


def word_hashes(data: np.ndarray, offs: np.ndarray, alphabet=WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, first word of each row with the total at the end)."""
    space, byte = alphabet
    word = ~space[data]
    start = word.copy()
    start[1:] &= ~word[:-1]
    first = offs[:-1][offs[:-1] < len(data)]
    start[first] = word[first]
    s = np.flatnonzero(start)
    rows = np.searchsorted(s, offs)
    if not len(s):
        return np.empty(0, np.uint64), rows
    length = np.diff(np.append(s, len(data)))
    pos = np.arange(len(data) - s[0]) - np.repeat(s - s[0], length)
    with np.errstate(over="ignore"):
        v = byte[data[s[0]:]]
        v *= _powers(int(length.max()))[pos]
        h = np.add.reduceat(v, s - s[0])
    return mix64(h), rows


def shingle_hashes(words: np.ndarray) -> np.ndarray:
    """Hashes of the runs of five words, all rows in one go (the caller cuts
    rows: a row of words [a, b) owns the values [a, b - 4))."""
    n = len(words) - SHINGLE + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        out = words[:n] * _COEF[0]
        for k in range(1, SHINGLE):
            out += words[k:k + n] * _COEF[k]
    return mix64(out)


def short_hash(words: np.ndarray) -> int:
    """One hash for a whole sequence of fewer than five words."""
    with np.errstate(over="ignore"):
        x = np.add.reduce(words * _COEF[:len(words)], dtype=np.uint64) + _U(len(words))
    return int(mix64(np.array([x], np.uint64) + _U(0x6A09E667F3BCC909))[0])


def shingle_sets(arr: pa.Array) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each row."""
    for _, _, data, offs in slices(arr):
        words, rows = word_hashes(data, offs)
        sh = shingle_hashes(words)
        for a, b in zip(rows[:-1].tolist(), rows[1:].tolist()):
            if b - a >= SHINGLE:
                yield np.unique(sh[a:b - SHINGLE + 1])
            elif b > a:
                yield np.array([short_hash(words[a:b])], np.uint64)
            else:
                yield np.empty(0, np.uint64)
