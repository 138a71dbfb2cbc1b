"""Numpy helpers that run inside Spark tasks: tile arrays to bytes and back."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa

# Fixed value: window bits that make zlib write and read the gzip container.
GZIP_WINDOW_BITS = 31


def wire_dtype(dtype: str) -> np.dtype:
    """Little-endian numpy type of a band's encoded pixels."""
    return np.dtype(dtype).newbyteorder("<")


def to_numpy(column: pa.Array, dtype: str) -> np.ndarray:
    """An Arrow value column as the band's exact type; nulls must be filtered out before."""
    if pa.types.is_decimal(column.type):
        return np.array(column.to_pylist(), dtype=object).astype(dtype)
    return column.to_numpy(zero_copy_only=False).astype(dtype, copy=False)


def binary_column(tiles: np.ndarray, keep: np.ndarray, level: int | None) -> pa.Array:
    """Rows of a 2-D array as bytes, gzipped at ``level`` if given; null where not kept."""
    if level is not None:
        packed = [
            zlib.compress(t.tobytes(), level=level, wbits=GZIP_WINDOW_BITS) if k else None
            for t, k in zip(tiles, keep)
        ]
        return pa.array(packed, type=pa.binary())
    data = np.ascontiguousarray(tiles[keep])
    width = data.shape[1] * data.itemsize
    ends = np.concatenate([[0], np.cumsum(keep, dtype=np.int64) * width])
    if ends[-1] >= 1 << 31:
        return pa.array([t.tobytes() if k else None for t, k in zip(tiles, keep)], pa.binary())
    nulls = None if keep.all() else pa.py_buffer(np.packbits(keep, bitorder="little").tobytes())
    return pa.Array.from_buffers(
        pa.binary(), len(keep), [nulls, pa.py_buffer(ends.astype("<i4")), pa.py_buffer(data)]
    )


def unpack(data: bytes, dtype: str, gzip: bool) -> np.ndarray:
    if gzip:
        data = zlib.decompress(data, wbits=GZIP_WINDOW_BITS)
    return np.frombuffer(data, dtype=wire_dtype(dtype))


def value_column(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Decoded pixels as the Arrow type of the band's Spark column."""
    if pa.types.is_decimal(kind):
        return pa.array(values).cast(pa.decimal128(20, 0))
    return pa.array(values).cast(kind)


def byte_offsets(column: pa.Array) -> np.ndarray:
    """Where each value of a binary column without nulls begins in its data, and the end."""
    offsets = np.frombuffer(column.buffers()[1], dtype="<i4")
    return offsets[column.offset : column.offset + len(column) + 1]


def raw_values(column: pa.Array, dtype) -> np.ndarray:
    """All bytes of a binary column without nulls, in row order, as values of a type."""
    ends = byte_offsets(column)
    return np.frombuffer(column.buffers()[2], dtype=np.uint8)[ends[0] : ends[-1]].view(dtype)


def blank_rows(tiles: np.ndarray, nodata, drop_nan: bool) -> np.ndarray:
    """Which tiles hold only nodata. NaN equals nothing, so NaN tiles count only if asked."""
    blank = (tiles == nodata).all(axis=1)
    if drop_nan and tiles.dtype.kind == "f":
        blank |= np.isnan(tiles).all(axis=1)
    return blank


def block_batch(ids, tiles: dict, keep: dict, gzip_level, parts=None) -> pa.RecordBatch:
    """Block rows of dense tiles; bands that are not kept are null, rows without bands are gone."""
    live = np.logical_or.reduce(list(keep.values()))
    columns = {"block": pa.array(ids[live])}
    if parts is not None:
        columns["part"] = parts.filter(pa.array(live))
    for b in tiles:
        columns[b] = binary_column(tiles[b][live], keep[b][live], gzip_level)
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def dense_rows(column: pa.Array, dtype: str, cells: int, nodata) -> tuple[np.ndarray, np.ndarray]:
    """A column of arrays as a 2-D array, and which rows had one."""
    given = column.is_valid().to_numpy(zero_copy_only=False)
    tiles = np.full((len(column), cells), nodata, dtype=wire_dtype(dtype))
    values = column.flatten()
    if values.null_count:
        values = values.fill_null(pa.scalar(nodata).cast(values.type))
    tiles[given] = to_numpy(values, dtype).reshape(-1, cells)
    return tiles, given
