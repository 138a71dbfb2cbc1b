"""Normalisation by a compiled character map, with the source place of every byte it makes.

The map of a piece model is a double array (a trie over bytes) and the replacement texts its leaves
point to. At each place the longest prefix in the trie is replaced; without one, a character stays
as it is. Each byte made remembers the source bytes that it stands for, so that anything found in
the normalised text can be pointed out in the original.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass

import numpy as np

SPACE = "▁".encode()


class CharMap:
    """Longest-prefix replacement read from a model's compiled map."""

    def __init__(self, compiled: bytes) -> None:
        (size,) = struct.unpack_from("<I", compiled)
        self.units = np.frombuffer(compiled, "<u4", size // 4, 4).tolist()
        self.texts = compiled[4 + size :]
        # The bytes with which some entry begins; others need no look into the trie.
        self.begins = bytes(b for b in range(256) if self._step(self._down(0, 0), b) is not None)

    def _down(self, place: int, unit_at: int) -> int:
        unit = self.units[unit_at]
        return place ^ (unit >> 10 << ((unit & 1 << 9) >> 6))

    def _step(self, place: int, byte: int) -> int | None:
        place ^= byte
        if place < len(self.units) and self.units[place] & (1 << 31 | 0xFF) == byte:
            return place
        return None

    def longest(self, text: bytes, at: int) -> tuple[bytes, int] | None:
        """The replacement of the longest entry that begins at ``at``, and the entry's length."""
        place = self._down(0, 0)
        found = None
        for end in range(at, len(text)):
            unit_at = self._step(place, text[end])
            if unit_at is None:
                break
            place = self._down(unit_at, unit_at)
            if self.units[unit_at] >> 8 & 1:
                found = (self.units[place] & (1 << 31) - 1, end + 1 - at)
        if found is None:
            return None
        start, length = found
        return self.texts[start : self.texts.index(b"\0", start)], length


@dataclass(frozen=True)
class Aligned:
    """Normalised bytes; byte i stands for the source bytes ``begin[i]`` to ``end[i]``."""

    text: bytes
    begin: np.ndarray
    end: np.ndarray

    def spans(self, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The source spans of the parts that end at ``cuts``, which are not empty."""
        starts = np.r_[0, cuts[:-1]] if len(cuts) else cuts
        return self.begin[starts], self.end[cuts - 1]


class Normaliser:
    """What a piece model does to a text before it is cut into pieces."""

    def __init__(
        self, compiled: bytes = b"", prefix: bool = True, squeeze: bool = False
    ) -> None:
        self.map = CharMap(compiled) if compiled else None
        self.prefix, self.squeeze = prefix, squeeze

    def __call__(self, text: bytes) -> Aligned:
        if self.map is None and not self.squeeze:
            return self._plain(text)
        return self._mapped(text)

    def _plain(self, text: bytes) -> Aligned:
        """Only spaces change: each becomes the three bytes of the space sign."""
        raw = np.frombuffer(text, np.uint8)
        own = np.repeat(np.arange(len(raw)), np.where(raw == 32, len(SPACE), 1))
        head = len(SPACE) if self.prefix and text else 0
        none = np.zeros(head, np.int64)
        return Aligned(
            SPACE[:head] + text.replace(b" ", SPACE), np.r_[none, own], np.r_[none, own + 1]
        )

    def _mapped(self, text: bytes) -> Aligned:
        out: list[tuple[bytes, int, int]] = []  # replacement, source begin and end
        at = 0
        while at < len(text):
            hit = self.map.longest(text, at) if self.map and text[at] in self.map.begins else None
            if hit is None:
                size = 1 + (text[at] >= 0xC0) + (text[at] >= 0xE0) + (text[at] >= 0xF0)
                hit = (text[at : at + size], size)
            out.append((hit[0], at, at + hit[1]))
            at += hit[1]
        flat = b"".join(part for part, _, _ in out)
        sizes = [len(part) for part, _, _ in out]
        begin = np.repeat(np.array([b for _, b, _ in out], np.int64), sizes)
        end = np.repeat(np.array([e for _, _, e in out], np.int64), sizes)
        # Bytes of a character left as it is stand for themselves.
        same = (end - begin == np.repeat(sizes, sizes)) if len(out) else np.zeros(0, bool)
        first = np.repeat(np.cumsum([0, *sizes[:-1]]), sizes) if len(out) else begin
        inside = np.arange(len(flat)) - first
        source = np.frombuffer(text, np.uint8)
        made = np.frombuffer(flat, np.uint8)
        if len(text):
            same &= source[np.minimum(begin + inside, len(text) - 1)] == made
        end = np.where(same, begin + inside + 1, end)
        begin = np.where(same, begin + inside, begin)
        if self.squeeze:
            blank = made == 32
            keep = ~blank | np.r_[False, ~blank[:-1]][: len(blank)]
            made, begin, end = made[keep], begin[keep], end[keep]
        if not len(made):
            return Aligned(b"", begin, end)
        sizes = np.where(made == 32, len(SPACE), 1)
        head = len(SPACE) if self.prefix else 0
        none = np.full(head, begin[0])
        normal = SPACE[:head] + made.tobytes().replace(b" ", SPACE)
        begin = np.r_[none, np.repeat(begin, sizes)]
        end = np.r_[none, np.repeat(end, sizes)]
        if self.squeeze:  # space signs that the text itself ends with go as well
            while normal.endswith(SPACE):
                normal = normal[: -len(SPACE)]
        return Aligned(normal, begin[: len(normal)], end[: len(normal)])
