"""Words, shingles and their 64-bit hashes for whole batches of texts, in numpy.

Texts travel as UTF-8 bytes. A batch is cut into blocks of whole texts; the words of a block are
hashed together by one prefix sum of a polynomial modulo 2**64, so the cost per byte is a few
array operations. Hashes are the same on every executor and in every run.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 18
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit values over all bits (a bijection)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _power_table(base: int, n: int) -> np.ndarray:
    """base**0 ... base**(n-1) modulo 2**64, kept for the largest n so far up to a block's size."""
    known = _powers.get(base)
    if known is not None and len(known) >= n:
        return known[:n]
    size = max(n, BLOCK_BYTES + 1)
    table = np.full(size, base, np.uint64)
    table[0] = 1
    np.cumprod(table, out=table)
    if size <= 4 * BLOCK_BYTES:
        _powers[base] = table
    return table[:n]


_BYTES = np.arange(256)
_LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES)
VALUE_OF_BYTE = mix(_BYTES.astype(np.uint64) + np.uint64(1))
VALUE_OF_LOWER = VALUE_OF_BYTE[_LOWER]
#: Words are runs of anything but space, tab, line feed, vertical tab, form feed, carriage return.
NOT_SPACE = ~((_BYTES == 32) | ((_BYTES >= 9) & (_BYTES <= 13)))


class Words(NamedTuple):
    """Words of a block: row of the text, place in it, hash, and bytes from start to end."""

    first: np.ndarray  # per text: number of the first word; one more entry at the end
    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    data: np.ndarray
    text_start: np.ndarray


def prefix_hashes(values: np.ndarray) -> np.ndarray:
    """Running sums from which the hash of any run follows by :func:`run_hashes`."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _power_table(_BASE, len(values)), out=sums[1:])
    return sums


def run_hashes(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mix((sums[end] - sums[start]) * _power_table(_INVERSE, len(sums))[start]
               + (end - start).astype(np.uint64))


def words_of(texts: list[bytes], word_bytes: np.ndarray = NOT_SPACE,
             values: np.ndarray = VALUE_OF_LOWER) -> Words:
    """All words of some texts; A-Z count as a-z unless ``values`` says otherwise."""
    lengths = np.fromiter((len(text) + 1 for text in texts), np.int64, len(texts))
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    text_start = np.concatenate(([0], np.cumsum(lengths)))
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = word_bytes[data]
    edges = np.flatnonzero(np.diff(inside))
    start, end = edges[::2], edges[1::2]
    hashes = run_hashes(prefix_hashes(values[data]), start, end)
    return Words(np.searchsorted(start, text_start), hashes, start, end, data, text_start)


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words of one text; of the whole text if it is shorter."""
    if len(words) == 0:
        return words
    size = min(size, len(words))
    total = np.full(len(words) - size + 1, size, np.uint64)
    for place in range(size):
        factor = np.uint64(pow(_BASE, 2 * place + 1, 1 << 64))
        total += words[place:len(words) - size + 1 + place] * factor
    return mix(total)


def blocks(batches: Iterable[pa.RecordBatch], column: str, size: int = BLOCK_BYTES,
           ) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of batches with about ``size`` bytes of whole texts each; null counts as empty."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy()
        block = (np.cumsum(sizes + 1) - 1) // size
        edges = [0, *(np.flatnonzero(np.diff(block)) + 1), len(sizes)]
        for begin, end in zip(edges[:-1], edges[1:]):
            if end > begin:
                part = batch.slice(begin, end - begin)
                yield part, [value or b"" for value in part.column(column).to_pylist()]
