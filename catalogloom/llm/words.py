"""Vectorised word, hash and shingle helpers for Arrow batches.

Texts arrive as Arrow string arrays; their UTF-8 bytes are cut into words by a
byte table and hashed with numpy, a bounded number of bytes at a time, so the
memory of a task does not follow the batch size. All delimiters are ASCII, and
no byte of a longer UTF-8 sequence is ASCII, so cutting bytes cuts characters.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once; a longer text is one block of its own.
BLOCK_BYTES = 1 << 21

_RANDOM = np.random.default_rng(20240607)
_BYTE_VALUES = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACES = _RANDOM.integers(1, 1 << 63, 1 << 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
GRAM = _RANDOM.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _table(delimiters: list[tuple[int, int]]) -> np.ndarray:
    table = np.ones(256, dtype=bool)
    for low, high in delimiters:
        table[low:high + 1] = False
    return table


#: Words are runs of anything but white space: [^\x20\x09-\x0D]+
SPACED = _table([(0x20, 0x20), (0x09, 0x0D)])
#: Words are runs of lower-cased letters, digits and non-ASCII: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+
LETTERED = _table([(0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lower(data: np.ndarray) -> np.ndarray:
    """The bytes with A-Z in lower case."""
    return _LOWER[data]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser; every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@dataclass
class Block:
    """Words of some consecutive rows of a batch.

    ``rows`` are the batch rows; ``words`` their hashes in order; row ``i`` has
    words ``first[i]:first[i + 1]``; ``starts`` and ``ends`` are byte positions
    in ``data``, and row ``i``'s bytes are ``data[offsets[i]:offsets[i + 1]]``.
    """
    rows: range
    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    words: np.ndarray
    first: np.ndarray

    def row_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.rows)), np.diff(self.first))


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The array's UTF-8 bytes and its n + 1 offsets; a null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    width = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, places, data = texts.buffers()
    n = len(texts)
    if places is None or n == 0:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offsets = np.frombuffer(places, width)[texts.offset:texts.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, offsets


def byte_blocks(texts: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[range, np.ndarray, np.ndarray]]:
    """Consecutive rows of bounded size: row range, their bytes, offsets from 0."""
    raw, offsets = bytes_of(texts)
    n, low = len(offsets) - 1, 0
    while low < n:
        high = int(np.searchsorted(offsets, offsets[low] + limit, side="right")) - 1
        high = min(max(high, low + 1), n)
        yield range(low, high), raw[offsets[low]:offsets[high]], offsets[low:high + 1] - offsets[low]
        low = high


def hashes(data: np.ndarray, starts: np.ndarray, table: np.ndarray) -> np.ndarray:
    """A hash of the bytes from each start to the next, delimiters left out."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    span = np.diff(np.append(starts, len(data)))
    place = np.arange(starts[0], len(data), dtype=np.int32) - np.repeat(starts.astype(np.int32), span)
    value = np.where(table, _BYTE_VALUES, np.uint64(0))[data[starts[0]:]]
    if int(span.max()) > 1 << 16:
        value *= (place >> 16).astype(np.uint64) * np.uint64(2) + np.uint64(1)
        place &= 0xFFFF
    value *= _PLACES[place]
    return mix(np.add.reduceat(value, starts - starts[0]))


def cut(rows: range, data: np.ndarray, offsets: np.ndarray, table: np.ndarray, lower: bool,
        hashed: bool = True) -> Block:
    """Words of one byte block."""
    if lower:
        data = _LOWER[data]
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return Block(rows, data, offsets, none, none, np.zeros(0, np.uint64), np.zeros(len(rows) + 1, np.int64))
    inside = table[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = offsets[:-1][offsets[:-1] < n]
    begins[edges] = inside[edges]
    stops = inside.copy()
    stops[:-1] &= ~inside[1:] | begins[1:]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    words = hashes(data, starts, table) if hashed else np.zeros(0, np.uint64)
    return Block(rows, data, offsets, starts, ends, words, np.searchsorted(starts, offsets).astype(np.int64))


def word_blocks(texts: pa.Array, table: np.ndarray = SPACED, lower: bool = False,
                limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """Words of every row, in bounded blocks of consecutive rows."""
    for rows, data, offsets in byte_blocks(texts, limit):
        yield cut(rows, data, offsets, table, lower)


def grams(words: np.ndarray, size: int, salt: int = 0) -> np.ndarray:
    """Hashes of all runs of ``size`` consecutive words (rows are not told apart)."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(n, np.uint64(salt + size), np.uint64)
    for j in range(size):
        total += words[j:j + n] * GRAM[j % 64] * np.uint64(2 * (j // 64) + 1)
    return mix(total)


def whole(words: np.ndarray, salt: int = 0) -> np.uint64:
    """Hash of a whole short word sequence; equal to ``grams`` of its own length."""
    return grams(words, len(words), salt)[0]


def batches_of(columns: dict[str, pa.Array | list | np.ndarray], schema: pa.Schema) -> pa.RecordBatch:
    """A record batch with the schema's types."""
    arrays = [pa.array(columns[f.name], f.type) if not isinstance(columns[f.name], pa.Array)
              else columns[f.name].cast(f.type) for f in schema]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


class Memo:
    """Numbers known by hash, in sorted arrays; new ones wait in a small array until there are many."""

    def __init__(self, waiting: int = 200_000):
        self.waiting = waiting
        self.keys = self.new_keys = np.zeros(0, np.uint64)
        self.values = self.new_values = np.zeros(0, np.int64)

    def __len__(self) -> int:
        return len(self.keys) + len(self.new_keys)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Values of known keys, -1 for others."""
        out = np.full(len(keys), -1, np.int64)
        for known, values in ((self.keys, self.values), (self.new_keys, self.new_values)):
            if len(known):
                at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
                same = known[at] == keys
                out[same] = values[at[same]]
        return out

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        self.new_keys, self.new_values = self._merged(self.new_keys, self.new_values, keys, values)
        if len(self.new_keys) > self.waiting:
            self.keys, self.values = self._merged(self.keys, self.values, self.new_keys, self.new_values)
            self.new_keys, self.new_values = self.new_keys[:0], self.new_values[:0]

    @staticmethod
    def _merged(keys, values, more_keys, more_values):
        keys, values = np.concatenate([keys, more_keys]), np.concatenate([values, more_values])
        order = np.argsort(keys, kind="stable")
        return keys[order], values[order]
