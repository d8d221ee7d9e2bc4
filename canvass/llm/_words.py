"""Words and word windows of whole Arrow batches as numpy arrays of 64-bit hashes.

Spark deals out the rows; these helpers replace a Python loop over characters inside one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

BATCH_BYTES = 8 * 1024 * 1024
SLICE_BYTES = 1_000_000

_BASE = 0x9E3779B97F4A7C15
_STEP = np.uint64(0xD6E8FEB86659FD93)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _table(*ranges: tuple[int, int]) -> np.ndarray:
    out = np.zeros(256, bool)
    for low, high in ranges:
        out[low : high + 1] = True
    return out


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: [^\x20\x09-\x0D]+
NOT_SPACE = ~_table((0x20, 0x20), (0x09, 0x0D))
#: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after A-Z have become a-z; bytes of other code points are 0x80 and above
LETTERS_DIGITS = _table((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over 64 output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse, modulo 2**64."""
    if len(_powers[0]) < n:
        n = max(n, SLICE_BYTES + 1)
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0], _powers[1]


def in_batches(df: DataFrame) -> DataFrame:
    """``df``, whose rows will go to Python in Arrow batches of at most BATCH_BYTES where the session names no
    bound of its own: workers' memory is then bounded however long the texts are.  A bound that the user has
    set stays; ours is the session's from the first operator on, as a setting can only hold for a session."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if conf.get(key, None) is None:
        conf.set(key, str(BATCH_BYTES))
    return df


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts end to end, and the n + 1 offsets; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(offsets, width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets): runs of whole texts of about ``most`` bytes, one text at least."""
    data, offsets = text_bytes(column)
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + most, "right")) - 1)
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


class Words:
    """Words of a run of texts.  start, end: byte places; hash: of the word, lower-cased by default; first: n + 1 word offsets."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, kind: np.ndarray, lower: bool = True) -> None:
        self.data, self.offsets = data, offsets
        inside = np.zeros(len(data) + 2, bool)
        inside[1:-1] = kind[data]
        starts = inside[1:-1] & ~inside[:-2]
        ends = inside[1:-1] & ~inside[2:]
        heads = offsets[:-1][offsets[:-1] < offsets[1:]]  # of texts that have bytes
        starts[heads] = inside[1:-1][heads]
        tails = offsets[1:][offsets[:-1] < offsets[1:]] - 1
        ends[tails] = inside[1:-1][tails]
        self.start, self.end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, offsets)
        up, down = powers(len(data) + 1)
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(((LOWER[data] if lower else data).astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=total[1:])
        self._total, self._down = total, down
        self.hash = mix((total[self.end] - total[self.start]) * down[self.start])

    def prefix(self, at: np.ndarray, k: int) -> np.ndarray:
        """Hash of the first k bytes of the words ``at``, each of k bytes at least: that of a word of these bytes."""
        start = self.start[at]
        return mix((self._total[start + k] - self._total[start]) * self._down[start])

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the k words from each word on, and the first word's index; windows stay inside a text."""
        n = len(self.hash) - k + 1
        if n <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        h = self.hash[:n].copy()
        for j in range(1, k):
            h *= _STEP
            h += self.hash[j : j + n]
        last = np.repeat(self.first[1:], self.counts())[:n]
        at = np.flatnonzero(np.arange(n) + k <= last)
        return mix(h[at] + np.uint64(k)), at

    def of_text(self, at: np.ndarray) -> np.ndarray:
        """The text of each word index."""
        return np.searchsorted(self.first, at, "right") - 1

    def plain(self, at: int, k: int) -> bytes:
        """k words from index ``at`` on, lower-cased, joined by a space."""
        return b" ".join(LOWER[self.data[self.start[i] : self.end[i]]].tobytes() for i in range(at, at + k))
