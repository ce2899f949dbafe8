"""Words of whole texts as arrays: the numpy kernel of the text operators.

A word is a longest run of bytes outside 0x20 and 0x09-0x0D, as in the pattern
``[^\\x20\\x09-\\x0D]+``: white space is ASCII, so UTF-8 bytes can be scanned
directly. A chunk of texts lies in one byte buffer; each step is one array
operation over the chunk, and a chunk holds about a megabyte (or one text), so
memory follows the chunk and not the partition.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)

CHUNK_BYTES = 1 << 20

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

# A byte's value in hashes: random odd 64-bit numbers of a fixed seed.
_RANDOM = np.random.Generator(np.random.PCG64(20240229))
_BYTE_VALUE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE_VALUE[SPACE] = 0
_LOWER_VALUE = _BYTE_VALUE.copy()
_LOWER_VALUE[65:91] = _BYTE_VALUE[97:123]
_WINDOW_VALUE = _RANDOM.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def powers_of(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64; grown when needed."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, CHUNK_BYTES + 1)
        have = np.full(size, base, dtype=np.uint64)
        have[0] = 1
        _powers[base] = have = np.multiply.accumulate(have)
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


@dataclass
class Words:
    """Words of a chunk. ``first[i]`` is the first word of text i; ``first`` has
    one entry more than there are texts."""

    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def n_texts(self) -> int:
        return len(self.offsets) - 1

    def text_of(self) -> np.ndarray:
        """Number of the text that each word is in."""
        return np.repeat(np.arange(self.n_texts), np.diff(self.first))

    def hashes(self, lower: bool = False) -> np.ndarray:
        """A 64-bit hash per word; A-Z count as a-z if ``lower``."""
        if not len(self.starts):
            return np.empty(0, dtype=np.uint64)
        value = (_LOWER_VALUE if lower else _BYTE_VALUE)[self.data]
        value *= powers_of(_BASE, len(self.data))
        sums = np.add.reduceat(value, self.starts)
        return mix(sums * powers_of(_BASE_INVERSE, len(self.data))[self.starts])


def buffer_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text column; a null is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None:
        return np.empty(0, dtype=np.uint8), offsets - offsets[0]
    data = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def words_of(texts: pa.Array) -> Words:
    data, offsets = buffer_of(texts)
    n = len(data)
    if not n:
        none = np.empty(0, dtype=np.int64)
        return Words(data, offsets, none, none, np.zeros(len(offsets), dtype=np.int64))
    space = SPACE[data]
    before = np.empty(n, dtype=bool)  # white space or a text's end stands before
    before[0] = True
    before[1:] = space[:-1]
    before[offsets[:-1][offsets[:-1] < n]] = True
    after = np.empty(n, dtype=bool)
    after[-1] = True
    after[:-1] = space[1:]
    after[offsets[1:][offsets[1:] > 0] - 1] = True
    word = ~space
    starts = np.flatnonzero(word & before)
    ends = np.flatnonzero(word & after) + 1
    return Words(data, offsets, starts, ends, np.searchsorted(starts, offsets))


def windows(word_hash: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every window of ``size`` consecutive words, by its first word, and
    whether the window lies inside one text. Windows that run over the end of
    all words are absent, so both arrays are ``len(word_hash) - size + 1`` long."""
    n = max(len(word_hash) - size + 1, 0)
    total = np.zeros(n, dtype=np.uint64)
    for i in range(size):
        total += word_hash[i : i + n] * _WINDOW_VALUE[i]
    lengths = np.diff(first)
    for_start = np.repeat(first[1:], lengths)[:n] - np.arange(n)  # words left in the text
    inside = for_start >= size
    return mix(total), inside


def chunks(batches: Iterable[pa.RecordBatch], text: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in slices whose texts have about ``limit`` bytes, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(batch.schema.get_field_index(text))
        sizes = np.asarray(pa.compute.binary_length(column.cast(pa.large_binary())).fill_null(0))
        group = np.cumsum(sizes + 64) // limit
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1), batch.num_rows]
        for start, end in zip(cuts, cuts[1:]):
            yield batch.slice(start, end - start)
