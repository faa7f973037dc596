"""A compressed FM-index over sequences of word ids: wavelet matrix, backward search, positions.

The Burrows-Wheeler transform of all sequences is kept as a wavelet matrix: one bit plane per bit
of the alphabet, packed in 64-bit words with a running count beside each word, so that a rank is a
few array reads and many searches advance together in numpy. Sequences are separated by a symbol
that is never searched for.
"""

from __future__ import annotations

import numpy as np


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of all suffixes by prefix doubling; ``text`` ends its sequences with zeros.

    Zeros are told apart by their place, so no comparison goes on beyond a sequence, and the number
    of rounds is the logarithm of the longest one.
    """
    size = len(text)
    ends = text == 0
    rank = np.where(ends, np.cumsum(ends) - 1, text.astype(np.int64) + int(ends.sum()))
    step = 1
    while True:
        later = np.zeros(size, np.int64)
        later[:-step] = rank[step:] + 1 if step < size else 0
        pair = rank * (int(rank.max(initial=0)) + 2) + later
        order = np.argsort(pair)
        ordered = pair[order]
        fresh = np.ones(size, bool)
        fresh[1:] = ordered[1:] != ordered[:-1]
        rank = np.empty(size, np.int64)
        rank[order] = np.cumsum(fresh) - 1
        if fresh.all():
            return order
        step *= 2


class WaveletMatrix:
    """Ranks of the symbols of a sequence, one packed bit plane per bit of the largest symbol."""

    def __init__(self, symbols: np.ndarray):
        self.size = len(symbols)
        self.bits = max(1, int(symbols.max(initial=0)).bit_length())
        self.planes: list[tuple[np.ndarray, np.ndarray, int]] = []
        rest = symbols.astype(np.uint32)
        for bit in reversed(range(self.bits)):
            ones = (rest >> np.uint32(bit) & np.uint32(1)).astype(bool)
            padded = np.zeros((self.size // 64 + 1) * 64, bool)
            padded[: self.size] = ones
            words = np.packbits(padded, bitorder="little").view(np.uint64)
            before = np.zeros(len(words), np.uint32)
            np.cumsum(np.bitwise_count(words[:-1]), out=before[1:], dtype=np.uint32)
            self.planes.append((words, before, self.size - int(ones.sum())))
            rest = np.concatenate([rest[~ones], rest[ones]])

    def rank(self, symbols: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """How often ``symbols[i]`` stands before place ``ends[i]``, plus where its run starts.

        The last plane leaves equal symbols side by side, so the difference of two ranks of one
        symbol is the number between them.
        """
        place = ends.astype(np.int64)
        for (words, before, zeros), bit in zip(self.planes, reversed(range(self.bits))):
            word = place >> 6
            mask = (np.uint64(1) << (place & 63).astype(np.uint64)) - np.uint64(1)
            ones = before[word].astype(np.int64) + np.bitwise_count(words[word] & mask)
            place = np.where(symbols >> bit & 1, zeros + ones, place - ones)
        return place


class FMIndex:
    """Index over ``text``, word ids from 1 on with a zero after every sequence."""

    def __init__(self, text: np.ndarray):
        self.text = text.astype(np.uint32)
        self.positions = suffix_array(self.text).astype(np.int32)
        self.transform = WaveletMatrix(self.text[self.positions - 1])
        counts = np.bincount(self.text, minlength=2)
        self.first = np.cumsum(counts) - counts
        # Where the run of a symbol starts below the wavelet matrix.
        symbols = np.arange(len(counts))
        self.below = self.transform.rank(symbols, np.zeros(len(counts), np.int64))

    def extend(self, symbols: np.ndarray, low: np.ndarray, high: np.ndarray):
        """Intervals of suffixes with ``symbols`` put before those of ``[low, high)``."""
        shift = self.first[symbols] - self.below[symbols]
        return self.transform.rank(symbols, low) + shift, self.transform.rank(symbols, high) + shift

    def repeated(self, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which of the windows of ``length`` ids at ``starts`` occur again in the text.

        Returns the indices of those windows and their intervals. All are searched backward at once,
        from the last id on; one whose interval has shrunk to a single suffix is itself alone and is
        dropped, since its matching statistic then ends below the window.
        """
        alive = np.arange(len(starts))
        last = self.text[starts + length - 1]
        low = self.first[last]
        high = low + np.bincount(self.text, minlength=len(self.first))[last]
        for back in range(2, length + 1):
            many = high - low > 1
            alive, low, high = alive[many], low[many], high[many]
            if not len(alive):
                break
            low, high = self.extend(self.text[starts[alive] + length - back], low, high)
        many = high - low > 1
        return alive[many], low[many], high[many]

    def earliest(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Least text position of each interval; the intervals are of one length, so they are disjoint."""
        if not len(low):
            return np.zeros(0, np.int64)
        bounds, where = np.unique(low, return_inverse=True)
        ends = np.zeros(len(bounds), np.int64)
        ends[where] = high
        edges = np.stack([bounds, ends], axis=1).reshape(-1)
        padded = np.append(self.positions, np.iinfo(np.int32).max)
        return np.minimum.reduceat(padded, edges)[::2][where].astype(np.int64)
