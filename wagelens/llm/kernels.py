"""Array kernels shared by the operators: Arrow text columns as byte
buffers, word boundaries and 64-bit word / shingle hashes, all vectorised
over one Arrow batch at a time."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U64 = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1
BASE_INV = pow(BASE, -1, 1 << 64)

#: Byte classes: True where a byte belongs to a word.
SPACED_WORDS = np.ones(256, bool)
SPACED_WORDS[[0x20, *range(0x09, 0x0E)]] = False
#: Letters, digits and every byte of a non-ASCII character (after lower-casing).
ALNUM_WORDS = np.zeros(256, bool)
ALNUM_WORDS[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def text_buffer(column) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and its ``n + 1`` offsets; null: empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset:column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of the splitmix generator: a bijection on 64-bit values."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_POWERS = [np.ones(1, U64), np.ones(1, U64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``BASE**i`` and ``BASE**-i`` modulo 2**64 for i below ``n``."""
    if len(_POWERS[0]) < n:
        for k, b in enumerate((BASE, BASE_INV)):
            steps = np.full(n, b, U64)
            steps[0] = 1
            _POWERS[k] = np.multiply.accumulate(steps)
    return _POWERS[0], _POWERS[1]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Running polynomial hash; ``span_hash`` cuts spans out of it."""
    up, _ = powers(len(data) + 1)
    out = np.zeros(len(data) + 1, U64)
    np.cumsum((data.astype(U64) + U64(1)) * up[:len(data)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span; equal spans have equal hashes."""
    _, down = powers(len(prefix))
    h = (prefix[end] - prefix[start]) * down[start]
    return mix(h ^ ((end - start).astype(U64) << U64(48)))


def word_spans(data: np.ndarray, off: np.ndarray, word: np.ndarray):
    """Starts, ends and row numbers of the maximal runs of word bytes in each row."""
    if len(data) == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    inside = word[data]
    first = np.zeros(len(data) + 1, bool)
    first[off] = True
    before = np.concatenate(([False], inside[:-1]))
    start = np.flatnonzero(inside & (~before | first[:-1]))
    after = np.concatenate((inside[1:], [False]))
    end = np.flatnonzero(inside & (~after | first[1:])) + 1
    row = np.searchsorted(off, start, side="right") - 1
    return start, end, row


def word_hashes(column, word: np.ndarray):
    """(word hash, row, word count per row) over a lower-cased string column."""
    data, off = text_buffer(column)
    data = LOWER[data]
    start, end, row = word_spans(data, off, word)
    h = span_hash(prefix_hash(data), start, end) if len(start) else np.zeros(0, U64)
    return h, row, np.bincount(row, minlength=len(off) - 1)


def shingle_sets(column, width: int, word: np.ndarray = SPACED_WORDS):
    """Distinct ``width``-word shingles of each row as sorted 64-bit hashes.

    Returns (hashes, offsets): row i owns ``hashes[offsets[i]:offsets[i+1]]``.
    A row with fewer words has its whole word sequence as one shingle; a row
    without words has none."""
    h, row, count = word_hashes(column, word)
    n = len(count)
    first = np.concatenate(([0], np.cumsum(count)))
    if len(h) == 0:
        return np.zeros(0, U64), np.zeros(n + 1, np.int64)
    factor = [U64(pow(BASE, 2 * j + 3, 1 << 64)) for j in range(width)]
    padded = np.concatenate((h, np.zeros(width, U64)))
    at = np.arange(len(h))
    last = first[row + 1]
    length = np.minimum(width, count[row])
    total = np.zeros(len(h), U64)
    for j in range(width):
        total += np.where(j < length, padded[j:j + len(h)] * factor[j], U64(0))
    value = mix(total ^ (length.astype(U64) << U64(56)))
    keep = (at + width <= last) | ((count[row] < width) & (at == first[row]))
    value, row = value[keep], row[keep]
    order = np.lexsort((value, row))
    value, row = value[order], row[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (row[1:] != row[:-1])
    value, row = value[new], row[new]
    return value, np.concatenate(([0], np.cumsum(np.bincount(row, minlength=n))))


def fold64(values: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Order-free 64-bit digest of each row's set of hashes."""
    out = np.zeros(len(off) - 1, U64)
    if len(values):
        full = off[:-1] < off[1:]
        out[full] = np.add.reduceat(mix(values ^ U64(0x5851F42D4C957F2D)), off[:-1][full])
    return out
