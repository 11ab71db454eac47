"""Texts of an Arrow batch as one flat byte array, with words and hashes found by numpy."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

#: Bytes handled at once; one longer text is still handled whole.
BLOCK_BYTES = 2 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_ODD), -1, 1 << 64))

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
PLAIN = np.zeros(256, bool)
PLAIN[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit moves every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@lru_cache(maxsize=4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.ones(n + 1, np.uint64), np.ones(n + 1, np.uint64)
    up[1:] = _ODD
    down[1:] = _INVERSE
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(21, int(n).bit_length())
    up, down = _powers(size)
    return up[: n + 1], down[: n + 1]


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (one more than rows) of a text column; null counts as empty."""
    if column.null_count:
        column = column.fill_null("")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, np.int64)[column.offset : column.offset + len(column) + 1]
    body = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return body, offsets


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) for runs of rows of at most ``limit`` bytes."""
    body, offsets = raw(column)
    row, n = 0, len(column)
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        end = min(n, max(end, row + 1))
        yield row, end, body[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """P with (P[e] - P[s]) * down[s] the polynomial hash of bytes s..e."""
    up, _ = powers(len(data))
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=out[1:])
    return out


def span_hash(p: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Mixed hash of the byte spans, length included."""
    _, down = powers(len(p) - 1)
    return mix((p[end] - p[start]) * down[start] + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each word (a run without ASCII white space inside one text)."""
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    word = ~SPACE[data]
    first = word.copy()
    first[1:] &= ~word[:-1]
    edges = offsets[:-1][offsets[:-1] < n]
    first[edges] = word[edges]
    last = word.copy()
    last[:-1] &= ~word[1:]
    tails = offsets[1:] - 1
    tails = tails[tails >= 0]
    last[tails] = word[tails]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(offsets, start, "right") - 1


def plain_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of digits, letters and non-ASCII characters, A-Z lower-cased, copied one space apart.

    Returns the copy (8 bytes of padding behind) and start, end and row of each word in it.
    """
    data = LOWER[data]
    n = len(data)
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = PLAIN[data]
    rows = len(offsets) - 1
    first, last = inside[1:-1] & ~inside[:-2], inside[1:-1] & ~inside[2:]
    if n:
        edges = offsets[:-1][offsets[:-1] < n]
        first[edges] = inside[1:-1][edges]
        tails = offsets[1:] - 1
        tails = tails[tails >= 0]
        last[tails] = inside[1:-1][tails]
    s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
    row = np.searchsorted(offsets[: rows + 1], s, "right") - 1
    size = e - s
    to = np.cumsum(size + 1) - size - 1
    packed = np.full(int((size + 1).sum()) + 8, 0x20, np.uint8)
    source = np.flatnonzero(inside[1:-1])
    packed[np.arange(len(source)) + np.repeat(np.arange(len(s)), size)] = data[source]
    return packed, to, to + size, row


def shingle_sets(words: np.ndarray, rows: np.ndarray, n_rows: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``size``-word shingle hashes of each row, sorted; offsets of the rows.

    A row of fewer words gives its whole sequence as one shingle; no word, none.
    """
    bounds = np.searchsorted(rows, np.arange(n_rows + 1))
    keys = np.arange(1, size + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F) | np.uint64(1)
    n = len(words)
    if n >= size:
        h = np.zeros(n - size + 1, np.uint64)
        for j in range(size):
            h += words[j : n - size + 1 + j] * keys[j]
        h = mix(h)
    else:
        h = np.zeros(0, np.uint64)
    parts, offsets = [], np.zeros(n_rows + 1, np.int64)
    for i in range(n_rows):
        a, b = int(bounds[i]), int(bounds[i + 1])
        if b - a >= size:
            s = np.sort(h[a : b - size + 1])
            s = s[np.concatenate(([True], s[1:] != s[:-1]))]
        elif b > a:
            s = mix(np.array([(words[a:b] * keys[: b - a]).sum() + np.uint64(b - a)], np.uint64))
        else:
            s = np.zeros(0, np.uint64)
        parts.append(s)
        offsets[i + 1] = offsets[i] + len(s)
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint64)), offsets
