"""Words of many texts as numpy arrays: where they begin and end, their hashes and exact codes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard

GOLDEN = np.uint64(0x9E3779B97F4A7C15)
STIR = np.uint64(0xBF58476D1CE4E5B9)

# Whether a byte parts words: the six white-space characters of ASCII.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def squeeze(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(data)


def unsqueeze(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def runs(ok: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each run of true values."""
    edges = np.flatnonzero(np.diff(ok.astype(np.int8), prepend=0, append=0))
    return edges[::2], edges[1::2]


def offsets(sizes: np.ndarray) -> np.ndarray:
    """Where items of those sizes begin when laid end to end, and where the last ends."""
    out = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=out[1:])
    return out


def slices(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indices of all items of the slices, one slice after the other."""
    at = offsets(sizes)
    return np.arange(at[-1]) + np.repeat(begins - at[:-1], sizes)


def stirred(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * STIR
    return h ^ (h >> np.uint64(29))


class Words:
    """The words of bytes: ``begins`` and ``ends`` in them, ``flat``, their bytes end to end."""

    def __init__(self, data: np.ndarray, apart: np.ndarray) -> None:
        """``apart`` tells for each byte whether it parts words."""
        self.data = data
        self.begins, self.ends = runs(~apart)
        self.sizes = self.ends - self.begins
        self.flat = data[~apart]
        self.at = offsets(self.sizes)

    def __len__(self) -> int:
        return len(self.begins)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word; equal words have equal hashes, others nearly never."""
        if not len(self):
            return np.zeros(0, np.uint64)
        powers = np.cumprod(np.full(int(self.sizes.max()), GOLDEN), dtype=np.uint64)
        terms = powers[slices(np.zeros(len(self), np.int64), self.sizes)]
        terms *= self.flat.astype(np.uint64) + np.uint64(1)
        return stirred(np.add.reduceat(terms, self.at[:-1]))

    def codes(self) -> tuple[np.ndarray, int]:
        """An exact number from 0 for each word, and how many numbers there are."""
        found = strings(self.flat, self.at).dictionary_encode()
        return found.indices.to_numpy(), len(found.dictionary)

    def spaced(self, after: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The words, each followed by one byte (a space by default), and where each begins."""
        at = self.at + np.arange(len(self) + 1)
        out = np.full(at[-1], 32, np.uint8)
        out[slices(at[:-1], self.sizes)] = self.flat
        if after is not None:
            out[at[1:] - 1] = after
        return out, at


def strings(flat: np.ndarray, at: np.ndarray, kind: pa.DataType | None = None) -> pa.Array:
    """An Arrow array of binary (or text) items from their bytes and offsets."""
    kind = kind or pa.large_binary()
    wide = kind in (pa.large_binary(), pa.large_string())
    place = np.ascontiguousarray(at, np.int64 if wide else np.int32)
    flat = np.ascontiguousarray(flat)
    parts = [None, pa.py_buffer(place), pa.py_buffer(flat)]
    return pa.Array.from_buffers(kind, len(at) - 1, parts)


def cut(flat: np.ndarray, begins: np.ndarray, sizes: np.ndarray, kind=None) -> pa.Array:
    """An Arrow array of slices of bytes, which may overlap."""
    return strings(flat[slices(begins, sizes)], offsets(sizes), kind)


def grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that sorts the keys, and where each group of equal ones begins in it."""
    order = np.argsort(keys, kind="stable")
    new = np.ones(len(keys), bool)
    new[1:] = keys[order[1:]] != keys[order[:-1]]
    return order, np.flatnonzero(new)


def by_bucket(hashes: np.ndarray, bits: int) -> Iterator[tuple[int, slice]]:
    """Buckets of sorted hashes by their leading bits, with the slice of each that has any."""
    bucket = (hashes >> np.uint64(64 - bits)).astype(np.int64)
    begins = np.flatnonzero(np.diff(bucket, prepend=-1))
    for b, e in zip(begins, [*begins[1:], len(hashes)], strict=True):
        yield int(bucket[b]), slice(int(b), int(e))


def short(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The 32 bits that follow the leading ones."""
    return ((hashes << np.uint64(bits)) >> np.uint64(32)).astype(np.uint32)


def power_bits(count: float, least: int, most: int = 20) -> int:
    """Bits that number at least ``count`` parts, within bounds."""
    return int(min(max(int(np.ceil(np.log2(max(count, 1)))), least), most))
