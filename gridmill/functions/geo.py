"""Web Mercator geometry: pixels to coordinates, outlines and resolutions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridmill.functions.cells import power_of_two
from gridmill.spec import MAX_PIXEL_RESOLUTION, ZOOM_BLOCK_EDGE, Raster

# Sphere radius of web Mercator; edge sampling step; nearest distinct points.
EARTH_RADIUS = 6378137.0
EDGE_STEP_PIXELS = 64.0
NEAR_POINT = 1e-13


# -- coordinates -----------------------------------------------------------


def affine(col: Column, row: Column, transform: tuple) -> tuple[Column, Column]:
    """Pixel to CRS with the coefficients (a, b, c, d, e, f) of x=a*col+b*row+c, y=d*col+e*row+f."""
    a, b, c, d, e, f = (F.lit(float(v)) for v in transform)
    return a * col + b * row + c, d * col + e * row + f


def raster_transform(raster: Raster) -> tuple:
    """The affine coefficients, in web Mercator metres, of a tile-aligned raster."""
    world = 2 * math.pi * EARTH_RADIUS
    tile = world / 2**raster.zoom
    return (
        tile / raster.block_width,
        0.0,
        raster.tile_x0 * tile - world / 2,
        0.0,
        -tile / raster.block_height,
        world / 2 - raster.tile_y0 * tile,
    )


def metres_to_lonlat(x: Column, y: Column) -> tuple[Column, Column]:
    lon = F.degrees(x / EARTH_RADIUS)
    lat = F.degrees(F.atan(F.sinh(y / EARTH_RADIUS)))
    return lon, lat


def tile_lon(x: Column, z: Column) -> Column:
    """Longitude of a (fractional) tile coordinate."""
    return x / power_of_two(z) * 360 - 180


def tile_lat(y: Column, z: Column) -> Column:
    """Latitude of a (fractional) tile coordinate."""
    return F.degrees(F.atan(F.sinh(math.pi * (1 - 2 * y / power_of_two(z)))))


def pixel_lonlat(raster: Raster, px: Column, py: Column) -> tuple[Column, Column]:
    z = F.lit(raster.zoom)
    return (
        tile_lon(raster.tile_x0 + px / raster.block_width, z),
        tile_lat(raster.tile_y0 + py / raster.block_height, z),
    )


def norm_lon(lon: Column) -> Column:
    return F.when(lon > 180, lon - 360).when(lon <= -180, lon + 360).otherwise(lon)


# -- outlines --------------------------------------------------------------


def edge(x0: Column, y0: Column, x1: Column, y1: Column, parts: Column) -> Column:
    """Evenly spaced points along an edge, both ends included."""
    n = F.greatest(parts.cast("int"), F.lit(1))

    def point(i):
        return F.struct(
            (x0 + (x1 - x0) * i / n).cast("double").alias("x"),
            (y0 + (y1 - y0) * i / n).cast("double").alias("y"),
        )

    return F.transform(F.sequence(F.lit(0), n), point)


def pixel_ring(width: Column, height: Column) -> Column:
    """The outline in pixels, counter-clockwise from the bottom left, one point per 64 pixels."""
    zero = F.lit(0)
    nx = F.ceil(width / EDGE_STEP_PIXELS)
    ny = F.ceil(height / EDGE_STEP_PIXELS)
    return F.concat(
        edge(zero, height, width, height, nx),
        edge(width, height, width, zero, ny),
        edge(width, zero, zero, zero, nx),
        edge(zero, zero, zero, height, ny),
    )


def clean_ring(ring: Column) -> Column:
    """Drop each point too near the last kept one, then close the ring exactly."""

    def near(a, b):
        return (F.abs(a.x - b.x) <= NEAR_POINT) & (F.abs(a.y - b.y) <= NEAR_POINT)

    kept = F.aggregate(
        ring,
        F.slice(ring, 1, 1),
        lambda acc, p: F.when(near(F.element_at(acc, -1), p), acc).otherwise(
            F.concat(acc, F.array(p))
        ),
    )
    first = F.slice(kept, 1, 1)
    body = F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(0)))
    cleaned = F.when(F.size(kept) > 1, F.concat(body, first)).otherwise(kept)
    # The fold copies its list point by point; it runs only if two neighbours are near at all.
    crowded = F.exists(
        F.sequence(F.lit(2), F.size(ring)),
        lambda i: near(F.element_at(ring, i - 1), F.element_at(ring, i)),
    )
    closed = F.concat(F.slice(ring, F.lit(1), F.size(ring) - 1), F.slice(ring, 1, 1))
    return F.when((F.size(ring) > 1) & ~crowded, closed).otherwise(cleaned)


def whole_earth(nw: Column, ne: Column, sw: Column, se: Column) -> Column:
    """Both the top and the bottom edge span the globe."""
    return (F.abs(nw - ne) >= 360) & (F.abs(sw - se) >= 360)


def normalize_ring(ring: Column, skip: Column) -> Column:
    moved = F.transform(ring, lambda p: F.struct(norm_lon(p.x).alias("x"), p.y.alias("y")))
    return F.when(skip, ring).otherwise(moved)


def polygon_wkt(ring: Column) -> Column:
    points = F.transform(ring, lambda p: F.concat_ws(" ", p.x.cast("string"), p.y.cast("string")))
    return F.concat(F.lit("POLYGON(("), F.array_join(points, ","), F.lit("))"))


def polygon_geojson(ring: Column) -> Column:
    points = F.transform(ring, lambda p: F.array(p.x, p.y))
    return F.to_json(
        F.struct(F.lit("Polygon").alias("type"), F.array(points).alias("coordinates"))
    )


def polygon_text(ring: Column, format: str) -> Column:
    if format == "wkt":
        return polygon_wkt(ring)
    if format == "geojson":
        return polygon_geojson(ring)
    raise ValueError(f"No such text form of a polygon: {format}")


# -- resolutions -----------------------------------------------------------


def log4(value: Column) -> Column:
    # Exact powers of four must give whole numbers.
    return F.round(F.log2(value) / 2, 9)


def block_resolution(max_zoom: Column, block_width: Column, block_height: Column) -> Column:
    scale = block_width / ZOOM_BLOCK_EDGE * (block_height / ZOOM_BLOCK_EDGE)
    return (max_zoom - log4(scale)).cast("int")


def pixel_resolution(resolution: Column, block_width: Column, block_height: Column) -> Column:
    return (resolution + log4(block_width * block_height)).cast("int")


def checked_pixel_resolution(resolution: Column, block_width: Column, block_height: Column):
    value = pixel_resolution(resolution, block_width, block_height)
    message = F.lit(f"Pixel resolution exceeds the largest supported one, {MAX_PIXEL_RESOLUTION}")
    return F.when(value > MAX_PIXEL_RESOLUTION, F.raise_error(message)).otherwise(value)
