"""A compressed index of word sequences: Burrows-Wheeler transform in a wavelet matrix.

The text is a sequence of word codes from 1, each sequence ended by code 0. The index keeps the
transform as one packed bit vector per bit of a code, with counts of ones per 64 bits, and answers
backward searches for many patterns at once. It holds about 1.5 bits per word and bit of a code.
"""

from __future__ import annotations

import numpy as np


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Where the suffixes of the text begin, in order. Ends of sequences differ by their place."""
    ends = np.flatnonzero(text == 0)
    rank = text.astype(np.int64) + len(ends)
    rank[ends] = np.arange(len(ends))
    step, n = 1, len(text)
    while True:
        follow = np.zeros(n, np.int64)
        follow[: n - step] = rank[step:] + 1
        key = rank * (max(int(rank.max()), n) + 2) + follow
        order = np.argsort(key)
        key = key[order]
        new = np.zeros(n, np.int64)
        new[1:] = key[1:] != key[:-1]
        rank[order] = np.cumsum(new)
        if rank[order[-1]] == n - 1:
            return order
        step *= 2


class Bits:
    """Packed bits with the number of ones before any place."""

    def __init__(self, bits: np.ndarray) -> None:
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.zeros(len(self.words), np.uint32)
        np.cumsum(np.bitwise_count(self.words[:-1]), out=self.before[1:])
        self.zeros = len(bits) - int(np.count_nonzero(bits))

    def ones(self, place: np.ndarray) -> np.ndarray:
        """How many ones lie before each place."""
        word = place >> 6
        below = (np.uint64(1) << (place & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & below).astype(np.int64)


class WaveletMatrix:
    """Counts of a symbol in a prefix of a sequence, one bit vector per bit of the symbols."""

    def __init__(self, symbols: np.ndarray) -> None:
        self.depth = max(1, int(symbols.max(initial=0)).bit_length())
        self.levels = []
        for shift in reversed(range(self.depth)):
            bit = (symbols >> shift) & 1
            self.levels.append(Bits(bit))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])
        # Where a symbol's own run begins below the last level.
        self.size = len(symbols)
        run = np.flatnonzero(np.diff(symbols, prepend=-1))
        self.run_of = np.zeros(1 << self.depth, np.int64)
        self.run_of[symbols[run]] = run

    def rank(self, symbols: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often each symbol, which occurs in the sequence, does so before its place."""
        place = place.copy()
        for level, shift in zip(self.levels, reversed(range(self.depth)), strict=True):
            one = ((symbols >> shift) & 1).astype(bool)
            ones = level.ones(place)
            place = np.where(one, level.zeros + ones, place - ones)
        return place - self.run_of[symbols]


class FMIndex:
    """Backward search in a text of sequences, each ended by code 0."""

    def __init__(self, text: np.ndarray) -> None:
        self.order = suffix_order(text)
        self.first = np.zeros(int(text.max(initial=0)) + 2, np.int64)
        np.cumsum(np.bincount(text), out=self.first[1 : int(text.max(initial=0)) + 2])
        self.wavelet = WaveletMatrix(text[self.order - 1])

    def matches(self, text: np.ndarray, begins: np.ndarray, length: int, least: int = 2):
        """Which of the stretches ``text[b : b + length]`` match ``least`` places or more, and
        for those the ranges of rows ``low`` to ``high`` in the order of suffixes.

        All stretches are read backward together; one leaves when fewer places are left, so what
        goes on is the part whose match statistic still may reach ``length``.
        """
        left = np.arange(len(begins))
        code = text[begins + length - 1]
        low, high = self.first[code], self.first[code + 1]
        for back in range(length - 2, -2, -1):
            keep = high - low >= least
            left, low, high = left[keep], low[keep], high[keep]
            if back < 0 or not len(left):
                return left, low, high
            code = text[begins[left] + back]
            both = self.wavelet.rank(np.tile(code, 2), np.concatenate([low, high]))
            low = self.first[code] + both[: len(left)]
            high = self.first[code] + both[len(left) :]
        return left, low, high
