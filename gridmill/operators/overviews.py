"""Pyramid levels: which tiles they have and what they hold."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmill.functions.cells import with_cell
from gridmill.operators.tiling import assemble, tile_pixels
from gridmill.spec import Raster


def valid_factors(factors: Column) -> Column:
    """True when the factors are 2, 4, 8 and so on."""
    expected = F.transform(factors, lambda f, i: f == F.pow(F.lit(2), i + 1))
    return F.forall(expected, lambda ok: ok)


def level_range(raster: Raster, level: int) -> tuple[int, int, int, int]:
    """First and last tile column and row of a level: the parents of the corner base tiles."""
    last_x = raster.tile_x0 + raster.tiles_wide - 1
    last_y = raster.tile_y0 + raster.tiles_high - 1
    return raster.tile_x0 >> level, last_x >> level, raster.tile_y0 >> level, last_y >> level


def overview_count(raster: Raster) -> int:
    spans = [level_range(raster, k) for k in range(1, raster.levels + 1)]
    return sum((x1 - x0 + 1) * (y1 - y0 + 1) for x0, x1, y0, y1 in spans)


def overview_tiles(spark: SparkSession, raster: Raster) -> DataFrame:
    """Every pyramid tile with the window of base pixels it covers, which may reach outside."""
    if not raster.levels:
        raise ValueError("The raster has no overviews")
    bw, bh = raster.block_width, raster.block_height
    parts = []
    for level in range(1, raster.levels + 1):
        x0, x1, y0, y1 = level_range(raster, level)
        wide, span = x1 - x0 + 1, 1 << level
        tile_x = F.col("id") % wide + x0
        tile_y = F.floor(F.col("id") / wide) + y0
        parts.append(
            spark.range(wide * (y1 - y0 + 1)).select(
                F.lit(level).alias("level"),
                tile_x.alias("tile_x"),
                tile_y.alias("tile_y"),
                F.lit(raster.zoom - level).alias("z"),
                ((tile_x * span - raster.tile_x0) * bw).alias("col_off"),
                ((tile_y * span - raster.tile_y0) * bh).alias("row_off"),
                F.lit(span * bw).alias("width"),
                F.lit(span * bh).alias("height"),
            )
        )
    return with_cell(reduce(DataFrame.unionByName, parts), "tile_x", "tile_y", "z")


def overview_blocks(pixels: DataFrame, raster: Raster, **options) -> DataFrame:
    return assemble(tile_pixels(pixels, raster, base=False), raster, **options)


def counted(profile: DataFrame, raster: Raster) -> DataFrame:
    """One row ``tiles, base_tiles``: the pyramid tiles of a profile, by arithmetic."""
    wide = F.ceil(F.col("width") / raster.block_width)
    high = F.ceil(F.col("height") / raster.block_height)
    sizes = []
    for k in range(1, raster.levels + 1):
        across = F.shiftright(raster.tile_x0 + wide - 1, k) - (raster.tile_x0 >> k) + 1
        down = F.shiftright(raster.tile_y0 + high - 1, k) - (raster.tile_y0 >> k) + 1
        sizes.append(across * down)
    total = reduce(lambda a, b: a + b, sizes, F.lit(0).cast("long"))
    return profile.select(total.alias("tiles"), (wide * high).alias("base_tiles"))
