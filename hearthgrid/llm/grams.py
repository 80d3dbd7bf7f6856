"""Hashes of words, word windows and byte windows of many texts at a time, on arrays inside tasks."""

import numpy as np
import pyarrow as pa

U = np.uint64
#: Texts are hashed in groups of about so many bytes, which bounds the arrays.
GROUP = 1 << 21
BYTE_BASE, WORD_BASE = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
_TABLE = np.random.default_rng(20).integers(1, 2**63, 256, dtype=np.uint64) * U(2) + U(1)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i up to n."""
    out = []
    for b in (base, pow(base, -1, 2**64)):
        if b not in _powers or len(_powers[b]) <= n:
            _powers[b] = np.cumprod(np.concatenate([[U(1)], np.full(n + 1024, b, dtype=np.uint64)]))
        out.append(_powers[b])
    return out[0], out[1]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread all bits of a hash over all others; never 0."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return (x ^ (x >> U(31))) | U(1)


def prefix(values: np.ndarray, base: int) -> np.ndarray:
    up, _ = powers(base, len(values))
    out = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * up[: len(values)], out=out[1:])
    return out


def window_hashes(sums: np.ndarray, base: int, length: int) -> np.ndarray:
    """Hash of each window of so many values, from prefix(); empty if there are fewer."""
    n = len(sums) - length
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    return mix((sums[length:] - sums[:n]) * powers(base, n)[1][:n])


def sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """Minimum or maximum of each window of `width` values."""
    if len(values) < width:
        return values[:0]
    out, size = values, 1
    while size * 2 <= width:
        out, size = pick(out[:-size], out[size:]), size * 2
    n = len(values) - width + 1
    return pick(out[:n], out[width - size : width - size + n])


def groups(column: pa.Array):
    """(first row, bytes, offsets) of consecutive rows of about GROUP bytes; a null is an empty text."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + GROUP)))
        last = min(last, len(column))
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of a group of texts, and the word offsets of the texts."""
    white = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    after = np.concatenate([[True], white[:-1]]) | edge[:-1] if len(data) else white
    starts = np.flatnonzero(~white & after)
    before = np.concatenate([white[1:], [True]]) | edge[1:] if len(data) else white
    ends = np.flatnonzero(~white & before) + 1
    sums = prefix(_TABLE[data], BYTE_BASE)
    hashes = mix((sums[ends] - sums[starts]) * powers(BYTE_BASE, len(data))[1][starts])
    return hashes, np.searchsorted(starts, offsets)


def byte_values(data: np.ndarray) -> np.ndarray:
    return _TABLE[data]


def minima(hashes: np.ndarray, width: int, valid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest of each `width` hashes (0 where the window is not valid), and which hashes are one of these.

    Equal stretches choose alike, wherever they stand.
    """
    least = np.where(valid, sliding(hashes, width, np.minimum), U(0))
    padded = np.concatenate([np.zeros(width - 1, dtype=np.uint64), least, np.zeros(width - 1, dtype=np.uint64)])
    return least, hashes == sliding(padded, width, np.maximum)


def inside(offsets: np.ndarray, n: int, length: int) -> np.ndarray:
    """Which of the n windows of so many items lie inside one text."""
    out = np.ones(n, dtype=bool)
    for cut in offsets[1:-1]:
        out[max(0, cut - length + 1) : cut] = False
    return out
