"""Queries over sources, bands and names."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from gridmill.functions import geo
from gridmill.functions.nodata import valid
from gridmill.operators import metadata, tiling
from gridmill.plans import fixtures as fx
from gridmill.plans.registry import query
from gridmill.sources import pixels as px
from gridmill.sources import tiff
from gridmill.sources import tiff_source as tiff_source_
from gridmill.sources.tiff_file import encode_tiff, write_file
from gridmill.spec import pair_bands


@query(
    "tile_summary",
    sql=f"""
    SELECT {fx.cell(f"{fx.TILE_X0} + px // 64", f"{fx.TILE_Y0} + py // 64", str(fx.ZOOM))} AS block,
        count(*) FILTER (b2 <> 0) AS valid_pixels,
        min(b2) FILTER (b2 <> 0) AS min, max(b2) FILTER (b2 <> 0) AS max,
        CAST(sum(b2) FILTER (b2 <> 0) AS BIGINT) AS sum
    FROM v_grid GROUP BY px // 64, py // 64""",
)
def tile_summary(spark, sf):
    """Valid pixels and a few sums per tile of a masked band."""
    raster = fx.plane(fx.B2, nodata=0)
    placed = tiling.with_position(tiling.on_levels(fx.grid(spark, sf), raster), raster)
    value = F.when(valid(raster, "b2"), F.col("b2"))
    tiles = placed.groupBy("tile_x", "tile_y").agg(
        F.count(value).alias("valid_pixels"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        F.sum(value).alias("sum"),
    )
    tiles = tiling.with_cell(tiles, "tile_x", "tile_y", raster.zoom)
    return tiles.select("block", "valid_pixels", "min", "max", "sum")


@query(
    "block_grid",
    sql=f"""
    SELECT tile_x, tile_y, {fx.ZOOM} AS z, tx * 64 AS col_off, ty * 64 AS row_off, 64 AS width,
        64 AS height, {fx.cell("tile_x", "tile_y", str(fx.ZOOM))} AS block
    FROM v_tiles""",
)
def block_grid(spark, sf):
    raster = px.measured(fx.grid(spark, sf), fx.plane(fx.B1))
    return tiling.block_grid(spark, raster)


@query(
    "raster_profile",
    sql="""
    SELECT width, height, 64 AS block_width, 64 AS block_height,
        CAST(floor(width * height / 4096) AS BIGINT) AS num_blocks, width * height AS num_pixels,
        CAST(ceil(width / 64) * ceil(height / 64) AS BIGINT) AS num_windows,
        (SELECT count(*) FROM v_grid) AS present
    FROM v_size""",
)
def raster_profile(spark, sf):
    return px.profile(fx.grid(spark, sf), fx.plane(fx.B1))


@query(
    "band_sizes",
    sql="""
    SELECT raster, band, dtype,
        round(width * height * CAST(regexp_extract(dtype, '[0-9]+') AS INT) / 8 / 1024 / 1024, 9)
            AS size_mb
    FROM v_catalog""",
)
def band_sizes(spark, sf):
    bits = F.regexp_extract("dtype", "([0-9]+)", 1).cast("int")
    size = F.col("width") * F.col("height") * bits / 8 / 1024 / 1024
    shown = F.round(size, 9).alias("size_mb")
    return fx.catalog(spark, sf).select("raster", "band", "dtype", shown)


@query("band_select", sql='SELECT px, py, b2 AS "BAND_2", b1 AS "QUANTITY" FROM v_grid')
def band_select(spark, sf):
    """Chosen bands under their table names, here in upper case."""
    named = pair_bands([2, 1], [None, "quantity"], style=str.upper)
    return px.band_columns(fx.grid(spark, sf), [(f"b{n}", name) for n, name in named])


@query(
    "default_table_name",
    sql="""
    SELECT page_id, regexp_replace(
        concat_ws('_', split_part(split_part(url, '/', -1), '.', 1), 'band',
            CAST(page_id % 4 + 1 AS VARCHAR), md5(url)),
        '[^a-zA-Z0-9_-]', '_', 'g') AS table_name
    FROM pages""",
)
def default_table_name(spark, sf):
    name = metadata.default_table_name(F.col("url"), F.col("page_id") % 4 + 1, F.md5("url"))
    return fx.table(spark, sf, "pages").select("page_id", name.alias("table_name"))


@query(
    "table_label",
    sql="""
    SELECT p_partkey,
        regexp_replace(lower(p_brand || '+' || p_type || '.' || p_name), '[^a-z0-9_-]', '_', 'g')
            AS label
    FROM part""",
)
def table_label(spark, sf):
    version = F.concat("p_brand", F.lit("+"), "p_type", F.lit("."), "p_name")
    return fx.table(spark, sf, "part").select(
        "p_partkey", metadata.label_text(version).alias("label")
    )


@query(
    "resolutions",
    sql="""
    SELECT raster, band, r AS block_resolution, r - levels AS minresolution, r AS maxresolution,
        CAST(floor(r + round(log2(edge * edge) / 2, 9)) AS INT) AS pixel_resolution
    FROM (SELECT *,
        CAST(floor(max_zoom - round(log2(edge / 256 * (edge / 256)) / 2, 9)) AS INT) AS r
        FROM v_catalog)""",
)
def resolutions(spark, sf):
    edge = F.col("edge")
    return (
        fx.catalog(spark, sf)
        .withColumn("r", geo.block_resolution(F.col("max_zoom"), edge, edge))
        .select(
            "raster",
            "band",
            F.col("r").alias("block_resolution"),
            (F.col("r") - F.col("levels")).alias("minresolution"),
            F.col("r").alias("maxresolution"),
            geo.checked_pixel_resolution(F.col("r"), edge, edge).alias("pixel_resolution"),
        )
    )


def _strip_files(spark, sf, overviews=()) -> str:
    """Every row of tiles written by a task as a file of three bands, in a new folder."""
    folder = fx.scratch(spark)
    raster = fx.plane(fx.B1)
    pixels = fx.grid(spark, sf).select("px", "py", "b1", "b2", "b3")
    strips = pixels.withColumn("strip", F.shiftright("py", 6))
    edges = strips.groupBy("strip").agg((F.max("py") % fx.EDGE + 1).alias("rows"))
    last = edges.agg(F.max_by("rows", "strip"), F.max("strip")).first()

    def write(key, rows):
        strip = int(key[0])
        height = last[0] if strip == last[1] else fx.EDGE
        bands = [np.zeros((height, fx.GRID_WIDTH), np.uint8) for _ in range(3)]
        for band, name in zip(bands, ("b1", "b2", "b3"), strict=True):
            band[rows["py"] % fx.EDGE, rows["px"]] = rows[name]
        data = encode_tiff(
            bands, raster.zoom, raster.tile_x0, raster.tile_y0 + strip, fx.EDGE, nodata=0, planar=2,
            overviews=overviews, predictor=2 if overviews else 1,
        )
        write_file(f"{folder}/{strip}.tif", data)
        return pd.DataFrame({"size": [len(data)]})

    # A strip has at most 512 x 64 pixels.
    strips.groupBy("strip").applyInPandas(write, "size long").agg(F.sum("size")).collect()
    return folder


@query(
    "tiff_scan",
    sql=f"""
    SELECT px, py, coalesce(b3, 0) AS third, coalesce(b1, 0) AS band_1
    FROM (SELECT unnest(range({fx.GRID_WIDTH})) AS px) CROSS JOIN
        (SELECT unnest(range(height)) AS py FROM v_size) LEFT JOIN v_grid USING (px, py)""",
)
def tiff_scan(spark, sf):
    """Every row of tiles as a file of three bands; two bands read back."""
    folder = _strip_files(spark, sf)
    found = tiff.raster_of(tiff.common_profile(spark, folder), ["third", None], [3, 1])
    return px.pixels_of_tiles(tiff.tiles(spark, folder, found, [3, 1]), found)


# Pixels of the base and of the reduced images, which keep each second and fourth pixel of a file.
_REDUCED = " UNION ALL ".join(
    f"""SELECT {fx.ZOOM} - {k} AS z, ({fx.TILE_X0} * 64 >> {k}) + (px >> {k}) AS gx,
        ({fx.TILE_Y0} * 64 >> {k}) + (py >> {k}) AS gy, b3, b1
    FROM filled WHERE px % {2**k} = 0 AND py % {2**k} = 0"""
    for k in range(3)
)


@query(
    "tiff_source",
    sql=f"""
    WITH filled AS (
        SELECT px, py, coalesce(b3, 0) AS b3, coalesce(b1, 0) AS b1
        FROM (SELECT unnest(range({fx.GRID_WIDTH})) AS px) CROSS JOIN
            (SELECT unnest(range(height)) AS py FROM v_size) LEFT JOIN v_grid USING (px, py))
    SELECT z, gx, gy, b3 AS third, b1 AS first FROM ({_REDUCED})
    WHERE z >= {fx.ZOOM - 1} AND gx // 64 BETWEEN {fx.TILE_X0 // 2 + 1} AND {fx.TILE_X0 + 5}
        AND gy // 64 >= {fx.TILE_Y0 // 2} AND (b3 <> 0 OR b1 <> 0)""",
)
def tiff_source(spark, sf):
    """The files and their reduced images as a data source; filters reach the byte ranges."""
    folder = _strip_files(spark, sf, overviews=(2, 4))
    tiff_source_.register(spark)
    options = {"bands": "3,1", "names": "third,first", "overviews": "true"}
    rows = spark.read.format("webmap_tiff").options(**options).load(folder)
    chosen = rows.where(
        (F.col("z") >= fx.ZOOM - 1)
        & F.col("tile_x").between(fx.TILE_X0 // 2 + 1, fx.TILE_X0 + 5)
        & (F.col("tile_y") >= fx.TILE_Y0 // 2)
    )
    cell = F.posexplode(F.arrays_zip("third", "first")).alias("at", "c")
    pixels = chosen.select("z", "tile_x", "tile_y", cell).where("c.third <> 0 OR c.first <> 0")
    return pixels.select(
        "z",
        (F.col("tile_x") * 64 + F.col("at") % 64).alias("gx"),
        (F.col("tile_y") * 64 + F.floor(F.col("at") / 64)).alias("gy"),
        "c.third",
        "c.first",
    )
