"""Words, hashes and keys shared by the operators of this package.

Both kinds of words are told apart by single bytes of UTF-8 (every separator is ASCII), so whole
batches are cut with array operations and no per-word Python.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Regular expressions of the two kinds of words.
ALNUM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SPACED_WORD = r"[^\x20\x09-\x0D]+"

#: Bytes of texts handled at once, and of words hashed at once; both bound memory, not results.
PIECE_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def _bytes_in(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


ALNUM_BYTES = _bytes_in((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))
SPACED_BYTES = ~_bytes_in((0x20, 0x20), (0x09, 0x0D))


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from: crc32 of the id as text, modulo 4, is 2; a null id is not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def packed(docs: DataFrame) -> DataFrame:
    """``row, doc_id, text``: all columns but the text in one struct, so that no name of theirs meets an operator's own."""
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    return docs.select(F.struct(*others).alias("row"), "doc_id", "text")


def unpacked(docs: DataFrame, text: Column) -> list[Column]:
    """The columns of ``docs`` from rows that were packed, with another text."""
    return [text.alias(c) if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns]


def ascii_lower(text: Column) -> Column:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def text_bytes(column: pa.Array) -> list[bytes]:
    """The texts as UTF-8, null as empty."""
    return pc.fill_null(column.cast(pa.binary()), b"").to_pylist()


def pieces(batch: pa.RecordBatch, column: str = "text", size: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in slices of some ``size`` bytes of text; a longer text is a slice of its own."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column).cast(pa.binary())), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths)
    start = 0
    while start < batch.num_rows:
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + size, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values."""
    values = values.astype(np.uint64, copy=True)
    values ^= values >> np.uint64(30)
    values *= np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(31)
    return values


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base modulo 2**64, and their inverses."""
    inverse = pow(_BASE, -1, 1 << 64)
    tables = []
    for base in (_BASE, inverse):
        table = np.empty(size, np.uint64)
        table[0] = 1
        filled = 1
        while filled < size:
            step = np.uint64(pow(base, filled, 1 << 64))
            more = min(filled, size - filled)
            table[filled : filled + more] = table[:more] * step
            filled += more
        tables.append(table)
    return tables[0], tables[1]


class Words:
    """The words of some texts: places in one buffer, and the range of each text's words."""

    def __init__(self, texts: list[bytes], word_bytes: np.ndarray, lower: bool = False):
        joined = b"\n".join(texts)
        self.data = joined.lower() if lower else joined
        self.buffer = np.frombuffer(self.data, np.uint8)
        inside = np.zeros(len(self.buffer) + 2, np.int8)
        inside[1:-1] = word_bytes[self.buffer]
        edges = np.flatnonzero(np.diff(inside))
        self.starts, self.ends = edges[0::2], edges[1::2]
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.text_starts = np.concatenate([[0], np.cumsum(lengths + 1)])
        self.first = np.searchsorted(self.starts, self.text_starts)

    def __len__(self) -> int:
        return len(self.starts)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def of_text(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def words(self, start: int, stop: int) -> list[bytes]:
        return [self.data[a:b] for a, b in zip(self.starts[start:stop].tolist(), self.ends[start:stop].tolist())]

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word: a polynomial of its bytes, taken from running sums."""
        out = np.empty(len(self), np.uint64)
        at = 0
        while at < len(self):
            low = self.starts[at]
            stop = max(at + 1, int(np.searchsorted(self.ends, low + PIECE_BYTES, "right")))
            part = self.buffer[low : self.ends[stop - 1]].astype(np.uint64)
            powers, inverses = _powers(max(PIECE_BYTES, 1 << int(len(part)).bit_length()))
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum((part + np.uint64(1)) * powers[: len(part)], out=sums[1:])
            starts, ends = self.starts[at:stop] - low, self.ends[at:stop] - low
            out[at:stop] = (sums[ends] - sums[starts]) * inverses[starts]
            at = stop
        return mix(out)

    def gram_starts(self, k: int) -> np.ndarray:
        """The words that begin ``k`` consecutive words of one text."""
        last = np.repeat(self.first[1:], self.counts)
        return np.flatnonzero(np.arange(len(self)) + k <= last)


def gram_hashes(hashes: np.ndarray, starts: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of the ``k`` words from each start."""
    out = np.full(len(starts), k, np.uint64)
    for j in range(k):
        out = out * np.uint64(_BASE) + hashes[starts + j]
    return mix(out)


def signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))
