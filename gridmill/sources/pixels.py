"""Pixel tables: one row per pixel, ``px, py`` from the top left and one column per band."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmill.spec import Raster, check_names


def band_columns(pixels: DataFrame, bands: list[tuple[str, str]]) -> DataFrame:
    """Keep the given bands under their table names; other columns are never read."""
    check_names([name for _, name in bands])
    return pixels.select("px", "py", *[F.col(source).alias(name) for source, name in bands])


def unique_pixels(pixels: DataFrame, bands: list[str]) -> DataFrame:
    """One row per pixel, keeping the largest value of each band.

    Copies are combined before the shuffle, so a pixel with very many copies is no burden.
    """
    return pixels.groupBy("px", "py").agg(*[F.max(b).alias(b) for b in bands])


def profile(pixels: DataFrame, raster: Raster) -> DataFrame:
    """One row of facts about a raster: extent in pixels, blocks and pixels."""
    bw, bh = raster.block_width, raster.block_height
    size = pixels.agg(
        (F.max("px") + 1).cast("long").alias("width"),
        (F.max("py") + 1).cast("long").alias("height"),
        F.count("*").alias("present"),
    )
    pixels_in_grid = F.col("width") * F.col("height")
    return size.select(
        "width",
        "height",
        F.lit(bw).alias("block_width"),
        F.lit(bh).alias("block_height"),
        F.floor(pixels_in_grid / bw / bh).alias("num_blocks"),
        pixels_in_grid.alias("num_pixels"),
        (F.ceil(F.col("width") / bw) * F.ceil(F.col("height") / bh)).alias("num_windows"),
        "present",
    )


def measured(pixels: DataFrame, raster: Raster) -> Raster:
    """The raster with its width and height taken from the pixels, unless they are known."""
    if raster.width is not None and raster.height is not None:
        return raster
    row = pixels.agg(F.max("px").alias("x"), F.max("py").alias("y")).first()
    if row.x is None:
        raise ValueError("The pixel table is empty")
    return raster.sized(row.x + 1, row.y + 1)


def pixels_of_tiles(tiles: DataFrame, raster: Raster) -> DataFrame:
    """Pixel rows of tiles ``tile_x, tile_y, <bands ARRAY>``, without the padding of edge tiles."""
    bw, bh = raster.block_width, raster.block_height
    cells = F.posexplode(F.arrays_zip(*raster.names)).alias("pos", "cell")
    out = tiles.select("tile_x", "tile_y", cells).select(
        ((F.col("tile_x") - raster.tile_x0) * bw + F.col("pos") % bw).cast("long").alias("px"),
        ((F.col("tile_y") - raster.tile_y0) * bh + F.floor(F.col("pos") / bw))
        .cast("long")
        .alias("py"),
        *[F.col("cell")[n].alias(n) for n in raster.names],
    )
    if raster.width is not None and raster.height is not None:
        out = out.where((F.col("px") < raster.width) & (F.col("py") < raster.height))
    return out
