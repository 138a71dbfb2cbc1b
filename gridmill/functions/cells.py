"""64-bit quadtree cell ids for web map tiles, as native bit expressions.

A cell id holds a fixed header, the zoom, and the interleaved bits of x and y, padded with ones.
Bits are spread and gathered four at a time through 16-entry tables. The usual shift-and-mask
steps use their input twice each, so a filter on a cell that Spark pushes below them would grow
2**5 times and leave generated code.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The cell layout.
CELL_HEADER = 0x4800000000000000
ZOOM_SHIFT = 52
LOW_BITS = (1 << 52) - 1
MAX_ZOOM = 26

# Four bits with zeros put between them, and the even bits of four taken out.
SPREAD = [sum((n >> b & 1) << 2 * b for b in range(4)) for n in range(16)]
GATHER = [n & 1 | (n >> 2 & 1) << 1 for n in range(16)]


def shift_left(value: Column, by: Column) -> Column:
    return F.call_function("shiftleft", value, by.cast("int"))


def shift_right(value: Column, by: Column) -> Column:
    return F.call_function("shiftright", value, by.cast("int"))


def power_of_two(exponent: Column) -> Column:
    return shift_left(F.lit(1).cast("long"), exponent)


def _by_fours(value: Column, table: list[int], bits: int, step: int) -> Column:
    """Map each four bits of a value through a table; results lie ``step`` bits apart."""
    entries = F.expr(f"array({', '.join(f'{n}L' for n in table)})")
    parts = [
        F.shiftleft(F.get(entries, F.shiftright(value, 4 * i).bitwiseAND(F.lit(15))), step * i)
        for i in range(-(-bits // 4))
    ]
    return reduce(Column.bitwiseOR, parts)


def spread(value: Column, bits: int = MAX_ZOOM) -> Column:
    return _by_fours(value.cast("long"), SPREAD, bits, 8)


def gather(value: Column, bits: int = 2 * MAX_ZOOM) -> Column:
    return _by_fours(value, GATHER, bits, 2)


def tile_cell(x: Column, y: Column, z: Column | int) -> Column:
    """The cell id of tile (x, y) at zoom z."""
    bits = max(z, 1) if isinstance(z, int) else MAX_ZOOM
    zoom = F.lit(z) if isinstance(z, int) else z
    digits = spread(x, bits).bitwiseOR(F.shiftleft(spread(y, bits), 1))
    return (
        F.lit(CELL_HEADER)
        .bitwiseOR(F.shiftleft(zoom.cast("long"), ZOOM_SHIFT))
        .bitwiseOR(shift_left(digits, 52 - 2 * zoom))
        .bitwiseOR(shift_right(F.lit(LOW_BITS), 2 * zoom))
    )


def with_cell(df: DataFrame, x: str, y: str, z: str | int, out: str = "block") -> DataFrame:
    """Add the cell id of tile (x, y) at zoom z."""
    return df.withColumn(out, tile_cell(F.col(x), F.col(y), z if isinstance(z, int) else F.col(z)))


def zoom_range(z: int) -> tuple[int, int]:
    """Smallest and largest cell id of a zoom; ids of a zoom lie together."""
    step = 1 << ZOOM_SHIFT
    return CELL_HEADER | z * step, CELL_HEADER | z * step + step - 1


def cell_zoom(cell: str | Column) -> Column:
    cell = F.col(cell) if isinstance(cell, str) else cell
    return F.shiftright(cell, ZOOM_SHIFT).bitwiseAND(F.lit(31)).cast("int")


def with_tile(df: DataFrame, cell: str = "block", x="tile_x", y="tile_y", z="z") -> DataFrame:
    """Add the tile (x, y, z) of a cell id."""
    zoom = cell_zoom(cell)
    digits = shift_right(F.col(cell).bitwiseAND(F.lit(LOW_BITS)), 52 - 2 * zoom)
    df = df.withColumns({z: zoom, "__d": digits})
    return df.withColumns({x: gather(F.col("__d")), y: gather(F.shiftright("__d", 1))}).drop("__d")


def with_point_tile(df: DataFrame, lon: str, lat: str, z: str | int, x="tile_x", y="tile_y"):
    """Add the web Mercator tile that holds a point; x wraps around, y stops at the poles."""
    zoom = F.lit(z) if isinstance(z, int) else F.col(z)
    n = power_of_two(zoom)
    sin = F.sin(F.radians(F.col(lat)))
    # At a pole the logarithm is unbounded; clamp the sine so that y lands on the edge tile.
    sin = F.greatest(F.least(sin, F.lit(1 - 1e-15)), F.lit(-1 + 1e-15))
    fraction = F.lit(0.5) - F.lit(0.25 / math.pi) * F.log((1 + sin) / (1 - sin))
    return df.withColumns(
        {
            x: F.pmod(F.floor(n * (F.col(lon) / 360 + 0.5)), n),
            y: F.least(F.greatest(F.floor(n * fraction), F.lit(0).cast("long")), n - 1),
        }
    )


def with_point_cell(df: DataFrame, lon: str, lat: str, z: str | int, out="block") -> DataFrame:
    df = with_point_tile(df, lon, lat, z, "__tx", "__ty")
    return with_cell(df, "__tx", "__ty", z, out).drop("__tx", "__ty")


def with_parent(df: DataFrame, cell: str, levels: int | str, out: str = "parent") -> DataFrame:
    """Add the ancestor ``levels`` up; null above the root."""
    up = F.lit(levels) if isinstance(levels, int) else F.col(levels)
    z = cell_zoom(cell) - up
    # Dropping digits is clearing them into the padding of ones and lowering the zoom.
    parent = (
        F.col(cell)
        .bitwiseAND(F.lit(~(31 << ZOOM_SHIFT)))
        .bitwiseOR(F.shiftleft(z.cast("long"), ZOOM_SHIFT))
        .bitwiseOR(shift_right(F.lit(LOW_BITS), 2 * z))
    )
    return df.withColumn(out, F.when(z >= 0, parent))


def with_children(df: DataFrame, cell: str, depth: int, out: str = "child") -> DataFrame:
    """One row per descendant ``depth`` levels down (4**depth rows per cell)."""
    z = cell_zoom(cell) + depth
    pad = 52 - 2 * z
    stem = (
        F.col(cell)
        .bitwiseAND(F.lit(~(31 << ZOOM_SHIFT)))
        .bitwiseAND(F.bitwise_not(shift_right(F.lit(LOW_BITS), 2 * (z - depth))))
        .bitwiseOR(F.shiftleft(z.cast("long"), ZOOM_SHIFT))
        .bitwiseOR(shift_right(F.lit(LOW_BITS), 2 * z))
    )
    n = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(4**depth - 1).cast("long")))
    return (
        df.withColumn("__n", n)
        .withColumn(out, stem.bitwiseOR(shift_left(F.col("__n"), pad)))
        .drop("__n")
    )
