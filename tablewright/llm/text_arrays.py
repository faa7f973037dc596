"""Texts as numpy arrays of code points, and the tables that classify code points.

Operators that look at every character work on one flat array per batch of texts, with the
bounds of each text beside it, so that no Python loop runs per character or per word.
"""

from __future__ import annotations

import ctypes
import sys
import time
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Characters handled at once inside a task, some 100 bytes of arrays each; a longer text is
# handled alone.
BATCH_CHARS = 1_000_000

# Bytes of a text whose words are held as objects at once.
PIECE_BYTES = 4_000_000


class Flat(NamedTuple):
    """Code points of several texts end to end; text i is ``codes[bounds[i]:bounds[i + 1]]``."""

    codes: np.ndarray
    bounds: np.ndarray


def flatten(texts: list[str | None]) -> Flat:
    """Null counts as empty. Lone surrogates, which no Parquet text holds, pass through."""
    parts = [text or "" for text in texts]
    bounds = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(part) for part in parts], out=bounds[1:])
    raw = "".join(parts).encode("utf-32-le", "surrogatepass")
    return Flat(np.frombuffer(raw, np.uint32), bounds)


def slices(lengths: np.ndarray, limit: int = BATCH_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges ``[start, end)`` of neighbours whose lengths add up to about ``limit``."""
    start = total = 0
    for i, length in enumerate(lengths):
        if i > start and total + length > limit:
            yield start, i
            start, total = i, 0
        total += int(length)
    if start < len(lengths):
        yield start, len(lengths)
    give_back()


_given_back = 0.0


def give_back(seconds: float = 3.0) -> None:
    """Return memory that Arrow and the C library keep for later, at most once in some ``seconds``.

    Workers live on between tasks and stages, and what they keep then belongs to others.
    """
    global _given_back
    pa.default_memory_pool().release_unused()
    if time.monotonic() - _given_back > seconds:
        _given_back = time.monotonic()
        trim = getattr(_c_library(), "malloc_trim", None)
        if trim:
            trim(0)


@lru_cache(maxsize=1)
def _c_library():
    return ctypes.CDLL(None)


def byte_lengths(texts: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)


def text_slices(batch: pa.RecordBatch, column: str = "text") -> Iterator[tuple[pa.RecordBatch, list]]:
    """The batch in parts of bounded text size, each with its texts as Python strings."""
    texts = batch.column(column)
    sizes = byte_lengths(texts)
    for start, end in slices(sizes):
        part = batch.slice(start, end - start)
        yield part, part.column(column).to_pylist()


def runs(mask: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True; a run never crosses from one text to the next."""
    if not len(mask):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = mask.copy()
    first[1:] &= ~mask[:-1]
    edges = bounds[:-1]
    edges = edges[edges < len(mask)]
    first[edges] = mask[edges]
    starts = np.flatnonzero(first)
    last = mask.copy()
    last[:-1] &= ~mask[1:]
    inner = bounds[1:]
    inner = inner[inner > 0] - 1
    last[inner] = mask[inner]
    return starts, np.flatnonzero(last) + 1


@lru_cache(maxsize=1)
def letter_table() -> np.ndarray:
    """True where a code point is a letter (category L) or a mark (category M)."""
    points = range(sys.maxunicode + 1)
    return np.fromiter((unicodedata.category(chr(c))[0] in "LM" for c in points), bool, len(points))


@lru_cache(maxsize=1)
def mark_table() -> np.ndarray:
    """True where a code point is a mark (category M), which needs a letter to make a word."""
    points = range(sys.maxunicode + 1)
    return np.fromiter((unicodedata.category(chr(c))[0] == "M" for c in points), bool, len(points))


@lru_cache(maxsize=1)
def lower_table() -> np.ndarray:
    """Lower-case code point of each code point, where that is a single one."""
    table = np.arange(sys.maxunicode + 1, dtype=np.uint32)
    for point in range(sys.maxunicode + 1):
        lowered = chr(point).lower()
        if len(lowered) == 1:
            table[point] = ord(lowered)
    return table


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices ``starts[i] .. starts[i] + lengths[i] - 1`` of every i, end to end."""
    total = int(lengths.sum())
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def text_of(bounds: np.ndarray, positions: np.ndarray) -> np.ndarray:
    """Index of the text that holds each position; empty texts hold none."""
    return np.searchsorted(bounds, positions, side="right") - 1


def record_slices(
    batch: pa.RecordBatch, column: str = "text", limit: int = BATCH_CHARS
) -> Iterator[tuple[pa.RecordBatch, int]]:
    """The batch in parts of bounded text size, each with the index of its first row."""
    for start, end in slices(byte_lengths(batch.column(column)), limit):
        yield batch.slice(start, end - start), start


def word_lists(text: bytes, limit: int = PIECE_BYTES) -> Iterator[list[bytes]]:
    """The words of a text, a list for every ``limit`` bytes or so.

    ``bytes.split`` cuts at the six ASCII blanks (space, tab to carriage return) and nowhere else.
    """
    start = 0
    while start < len(text):
        end = start + limit
        while end < len(text) and text[end] not in b"\t\n\v\f\r ":
            end += 1
        yield text[start:end].split()
        start = end
