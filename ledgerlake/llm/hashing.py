"""Vectorised hashes over the raw bytes of an Arrow string column, and texts as compressed bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import RID

#: Any odd numbers with well-mixed bits.
BASE = 0x9E3779B97F4A7C15
STEP = np.array([0xD1342543DE82EF95, 0xAF251AF3B0F025B5, 0xB564EF22EC7AECE5, 0xF7C2EBC08F67F2B5, 0x97C29B3A5F5B3B6D], np.uint64)
#: Texts are hashed together up to this many bytes; a longer one alone.
CHUNK = 2 * 2**20

WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_POWERS: dict[int, np.ndarray] = {}


def powers(n: int, base: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), modulo 2 ** 64; those of a chunk's size are kept."""
    known = _POWERS.get(base)
    if known is None or len(known) < n:
        known = np.full(max(n, CHUNK + 1), base, np.uint64)
        known[0] = 1
        np.multiply.accumulate(known, out=known)
        if n <= CHUNK + 1:
            _POWERS[base] = known
    return known[:n]


class Prefix:
    """Hashes of any substring of a byte buffer, from running sums of byte * base ** position."""

    def __init__(self, data: np.ndarray):
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(len(data), BASE), out=self.sums[1:])
        self.back = powers(len(data) + 1, pow(BASE, -1, 2**64))

    def runs(self, width: int) -> np.ndarray:
        """Hashes of all substrings of one width."""
        n = len(self.sums) - width
        return mix((self.sums[width:] - self.sums[:n]) * self.back[:n] + np.uint64(width))

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.back[start] + (end - start).astype(np.uint64))


def text_chunks(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets into them) of runs of rows; a null text is empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    row = 0
    while row < len(column):
        last = max(row + 1, int(np.searchsorted(offsets, offsets[row] + CHUNK, side="right")) - 1)
        yield row, data[offsets[row]:offsets[last]], offsets[row:last + 1] - offsets[row]
        row = last


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of white-space delimited words, and each row's first word (n + 1 entries)."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    white = WHITE[data]
    before, after = np.empty_like(white), np.empty_like(white)
    before[1:], after[:-1] = white[:-1], white[1:]
    full = offsets[1:] > offsets[:-1]
    before[offsets[:-1][full]] = True
    after[offsets[1:][full] - 1] = True
    starts, ends = np.flatnonzero(~white & before), np.flatnonzero(~white & after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """Each row's distinct shingles as ascending 64-bit hashes, A-Z lower-cased; a row with fewer words
    than ``width``, but not none, is one shingle."""
    data = LOWER[data]
    starts, ends, first = words(data, offsets)
    hashed = Prefix(data).of(starts, ends)
    n = max(0, len(hashed) - width + 1)
    runs = np.zeros(n, np.uint64)
    for k in range(width):
        runs += hashed[k:k + n] * STEP[k % len(STEP)]
    runs = mix(runs)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= width:
            yield np.unique(runs[a:b - width + 1])
        elif b > a:
            yield mix((hashed[a:b] * STEP[:b - a]).sum(keepdims=True, dtype=np.uint64) + np.uint64(b - a))
        else:
            yield np.zeros(0, np.uint64)


def pressed(docs: DataFrame, text_col: str) -> DataFrame:
    """(row id, z): the UTF-8 bytes of each text, compressed for a shuffle; a null text is empty."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            raw = batch.column(1).cast(pa.binary()).fill_null(b"")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([press.compress(x.as_py()) for x in raw], pa.binary())],
                                             [RID, "z"])

    return docs.select(RID, F.col(text_col).cast("string")).mapInArrow(run, f"{RID} long, z binary")


def unpress(column: pa.Array) -> pa.Array:
    """The bytes of a column of ``pressed``."""
    back = zstandard.ZstdDecompressor()
    return pa.array([back.decompress(x.as_py()) for x in column], pa.large_binary())
