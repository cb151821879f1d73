"""Words of a column of texts as numpy arrays, without a Python object per word.

Texts stay UTF-8 bytes. Every word gets a 64-bit hash, computed for all words of a slice of rows at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once; bounds the memory of a task (a longer single text is a slice of its own).
SLICE_BYTES = 1024 * 1024

_ODD = np.uint64(0x9E3779B97F4A7C15)


def byte_table(*ranges: tuple[int, int]) -> np.ndarray:
    """Which of the 256 bytes lie in any of the ranges, both ends included."""
    table = np.zeros(256, dtype=bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


#: ASCII letters in lower case, all other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

SPACE = byte_table((0x20, 0x20), (0x09, 0x0D))
NOT_SPACE = ~SPACE
#: Letters and digits of ASCII (after lower-casing) and all bytes of longer characters.
ALPHANUMERIC = byte_table((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (a bijection)."""
    values = np.asarray(values, dtype=np.uint64).copy()
    values ^= values >> np.uint64(30)
    values *= np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(31)
    return values


_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * _ODD)


def powers(n: int, base: np.uint64 = _ODD) -> np.ndarray:
    """base**0 to base**(n - 1), modulo 2**64."""
    out = np.full(max(n, 1), base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


@dataclass
class Texts:
    """A slice of a text column: all bytes, and where each row starts (one more offset than rows)."""

    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def raw(self, row: int) -> bytes:
        return self.data[self.offsets[row] : self.offsets[row + 1]].tobytes()


def texts_of(column: pa.Array) -> Texts:
    """Null counts as empty."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return Texts(whole[offsets[0] : offsets[-1]], offsets - offsets[0])


def slices(batches, text: str, limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """Cut record batches into runs of rows with about ``limit`` bytes of text."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        texts = texts_of(batch.column(batch.schema.get_field_index(text)))
        first = 0
        while first < len(texts):
            end = int(np.searchsorted(texts.offsets, texts.offsets[first] + limit, side="right")) - 1
            end = max(end, first + 1)
            offsets = texts.offsets[first : end + 1]
            yield (
                batch.slice(first, end - first),
                Texts(texts.data[offsets[0] : offsets[-1]], offsets - offsets[0]),
            )
            first = end


@dataclass
class Words:
    """Words in reading order: row, first byte, length in bytes and hash; ``bounds[r]:bounds[r+1]`` are row r's."""

    start: np.ndarray
    length: np.ndarray
    hash: np.ndarray
    bounds: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts)


def words_of(texts: Texts, is_word: np.ndarray, lower: bool = True) -> Words:
    """Maximal runs of bytes for which ``is_word`` holds; a word never goes on in the next row."""
    data = texts.data
    inside = (is_word[LOWER] if lower else is_word)[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    firsts = texts.offsets[:-1]
    firsts = firsts[firsts < len(data)]
    begins[firsts] = inside[firsts]
    lasts = firsts[firsts > 0] - 1
    ends[lasts] = inside[lasts]
    start = np.flatnonzero(begins)
    length = np.flatnonzero(ends) + 1 - start
    bounds = np.searchsorted(start, texts.offsets)
    return Words(start, length, hash_runs(data, start, length, lower), bounds)


_INVERSE = np.uint64(pow(int(_ODD), -1, 2**64))
_LOWER_VALUES = _BYTE_VALUES[LOWER]


@lru_cache(1)
def _slice_powers() -> tuple[np.ndarray, np.ndarray]:
    return powers(SLICE_BYTES), powers(SLICE_BYTES, _INVERSE)


def _power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Those of a slice are kept by the worker, those of a longer text are not."""
    return _slice_powers() if size <= SLICE_BYTES else (powers(size), powers(size, _INVERSE))


def hash_runs(data: np.ndarray, start: np.ndarray, length: np.ndarray, lower: bool = False) -> np.ndarray:
    """Hash of each run of bytes: the sum of a value per byte times a power of its place, mixed with the length.

    Sums come from one running sum over all bytes; what the place in ``data`` adds is divided out.
    """
    if len(start) == 0:
        return np.zeros(0, dtype=np.uint64)
    up, down = _power_tables(len(data))
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.multiply((_LOWER_VALUES if lower else _BYTE_VALUES)[data], up[: len(data)], out=sums[1:])
    np.cumsum(sums, out=sums)
    found = (sums[start + length] - sums[start]) * down[start]
    return mix(found + length.astype(np.uint64) * _ODD)


def hash_text(word: str) -> int:
    """The hash that ``words_of`` gives to the same bytes."""
    data = np.frombuffer(word.encode(), dtype=np.uint8)
    return int(hash_runs(data, np.array([0]), np.array([len(data)]))[0])


def shingle_hashes(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``width`` words, and the bounds of each row's.

    A row with fewer words has its whole sequence as its only one; a row without words has none.
    """
    counts = words.counts
    n = len(words.hash)
    combined = np.zeros(max(n - width + 1, 0), dtype=np.uint64)
    for k in range(width):
        combined *= np.uint64(0xD1342543DE82EF95)
        combined += words.hash[k : k + len(combined)]
    combined = mix(combined)
    per_row = np.where(counts >= width, counts - width + 1, (counts > 0).astype(np.int64))
    bounds = np.concatenate([[0], np.cumsum(per_row)])
    out = np.zeros(bounds[-1], dtype=np.uint64)
    long_rows = counts >= width
    keep = np.repeat(per_row, per_row) > 0
    place = np.arange(bounds[-1]) - np.repeat(bounds[:-1], per_row)
    source = np.repeat(words.bounds[:-1], per_row) + place
    from_long = np.repeat(long_rows, per_row) & keep
    out[from_long] = combined[source[from_long]]
    for row in np.flatnonzero((counts > 0) & ~long_rows):
        value = counts[row : row + 1].astype(np.uint64)
        for word in words.hash[words.bounds[row] : words.bounds[row + 1]]:
            value = mix(value) ^ word
        out[bounds[row]] = mix(value + _ODD)[0]
    return out, bounds


def to_signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)
