"""Queries over tiles and pyramids."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridmill.functions.cells import with_cell
from gridmill.operators import arrays, overviews, tiling
from gridmill.plans import fixtures as fx
from gridmill.plans.registry import query
from gridmill.sources import pixels as px
from gridmill.spec import Band

Z = str(fx.ZOOM)


def dense_sql(value: str, edge: int = 64, levels: bool = False) -> str:
    """Every cell of every tile that has a pixel: ``tx, ty, z, pos, v`` (nodata 0)."""
    source = "v_levels" if levels else (
        f"(SELECT *, {fx.ZOOM} AS z, px + {fx.TILE_X0 * 64} AS gx, py + {fx.TILE_Y0 * 64} AS gy"
        " FROM v_grid)"
    )
    return f"""
        SELECT t.tx, t.ty, t.z, t.pos, coalesce(p.v, 0) AS v
        FROM (SELECT tx, ty, z, unnest(range({edge * edge})) AS pos FROM (
            SELECT DISTINCT gx // {edge} AS tx, gy // {edge} AS ty, z FROM {source})) t
        LEFT JOIN (SELECT gx // {edge} AS tx, gy // {edge} AS ty, z,
            gy % {edge} * {edge} + gx % {edge} AS pos, {value} AS v FROM {source}) p
        ON t.tx = p.tx AND t.ty = p.ty AND t.z = p.z AND t.pos = p.pos"""


def hex_sql(column: str = "v", size: int = 1) -> str:
    """Little-endian hex of a whole number of ``size`` bytes, all cells in order."""
    parts = " || ".join(
        f"printf('%02X', (CAST({column} AS BIGINT) >> {8 * i}) & 255)" for i in range(size)
    )
    return f"string_agg({parts}, '' ORDER BY pos)"


CELL = fx.cell("tx", "ty", "z")


@query(
    "tile_dense",
    sql=f"""
    SELECT {CELL} AS block, string_agg(v::INT::VARCHAR, ',' ORDER BY pos) AS values
    FROM ({dense_sql("b1")}) GROUP BY tx, ty, z""",
)
def tile_dense(spark, sf):
    """Dense row-major arrays; cells with no pixel hold the nodata value."""
    raster = fx.plane(fx.B1)
    stored = tiling.base_blocks(fx.grid(spark, sf), raster, keep_empty=True)
    values = F.array_join(F.transform("b1", lambda v: v.cast("string")), ",")
    return tiling.to_arrays(stored, raster).select("block", values.alias("values"))


@query(
    "tile_encode",
    sql=f"""
    SELECT a.block, a.b1, b.i1, c.w1, d.u1 FROM
        (SELECT {CELL} AS block, {hex_sql()} AS b1 FROM ({dense_sql("b1")}) GROUP BY tx, ty, z) a,
        (SELECT {CELL} AS block, {hex_sql("v", 2)} AS i1
            FROM ({dense_sql("b2 - b1 * 7")}) GROUP BY tx, ty, z) b,
        (SELECT {CELL} AS block, {hex_sql("v", 4)} AS w1
            FROM ({dense_sql("CAST(round(f1 * 100) AS BIGINT)")}) GROUP BY tx, ty, z) c,
        (SELECT {CELL} AS block, {hex_sql("v", 8)} AS u1
            FROM ({dense_sql("CAST(round(f1 * 100) AS BIGINT) * -977")}) GROUP BY tx, ty, z) d
    WHERE a.block = b.block AND a.block = c.block AND a.block = d.block""",
)
def tile_encode(spark, sf):
    """Little-endian bytes of whole-number bands of 8, 16, 32 and 64 bits."""
    raster = fx.plane(
        Band("b1"), Band("i1", "int16"), Band("w1", "uint32"), Band("u1", "int64"), nodata=0
    )
    cents = F.round(F.col("f1") * 100).cast("long")
    pixels = fx.grid(spark, sf).withColumns(
        {"i1": F.col("b2") - F.col("b1") * 7, "w1": cents, "u1": cents * -977}
    )
    stored = tiling.base_blocks(pixels, raster, keep_empty=True)
    return stored.select("block", *[F.hex(n).alias(n) for n in raster.names])


@query(
    "tile_roundtrip",
    sql=f"""
    SELECT z, tx * 64 + pos % 64 AS gx, ty * 64 + pos // 64 AS gy, CAST(v AS INT) AS b1
    FROM ({dense_sql("b1", levels=True)})""",
)
def tile_roundtrip(spark, sf):
    """Base and pyramid tiles to gzipped bytes and back to pixels."""
    raster = fx.plane(fx.B1, levels=3)
    stored = tiling.blocks(fx.grid(spark, sf), raster, compress=True)
    out = tiling.decode(stored, raster, compressed=True)
    return out.select("z", "gx", "gy", F.col("b1").cast("int").alias("b1"))


@query(
    "array_tiles",
    sql=f"""
    SELECT {fx.ZOOM} - k AS z, gx // (1 << k) AS gx, gy // (1 << k) AS gy, round(v, 6) AS band_1
    FROM (SELECT tile_x * 8 + (i - 1) % 8 AS gx, tile_y * 8 + (i - 1) // 8 AS gy,
            CAST(band_1[i] AS DOUBLE) AS v
        FROM (SELECT *, unnest(range(1, 65)) AS i FROM v_array_tiles)),
        (SELECT unnest(range(4))::INT AS k)
    WHERE k = 0 OR (gx % (1 << k) = (1 << (k - 1)) AND gy % (1 << k) = (1 << (k - 1)))""",
)
def array_tiles(spark, sf):
    """Float tiles given as arrays: base encoded in place, pyramid from the kept pixels."""
    raster = fx.ARRAY_TILES
    stored = arrays.blocks_of_tiles(fx.array_tiles(spark, sf), raster, compress=True)
    out = tiling.decode(stored, raster, compressed=True).where(~F.isnan("band_1"))
    return out.select("z", "gx", "gy", F.round(F.col("band_1").cast("double"), 6).alias("band_1"))


def _small(*bands):
    return fx.plane(*bands, edge=2, nodata=0)


_SMALL_CELL = fx.cell("tx", "ty", str(fx.ZOOM + 5))


@query(
    "drop_empty_tiles",
    sql=f"""
    SELECT {_SMALL_CELL} AS block, b2 AS has_b2, b3 AS has_b3
    FROM (SELECT (px + {fx.TILE_X0 * 64}) // 2 AS tx, (py + {fx.TILE_Y0 * 64}) // 2 AS ty,
            max(b2) > 0 AS b2, max(b3) > 0 AS b3
        FROM v_grid GROUP BY ALL)
    WHERE b2 OR b3""",
)
def drop_empty_tiles(spark, sf):
    """Band tiles that hold only nodata are null; blocks with no band left are gone."""
    stored = tiling.base_blocks(fx.grid(spark, sf), _small(fx.B2, fx.B3))
    return stored.select(
        "block", F.col("b2").isNotNull().alias("has_b2"), F.col("b3").isNotNull().alias("has_b3")
    )


@query(
    "empty_blocks",
    sql="""
    SELECT expected, written, expected - written AS empty FROM
        (SELECT ((width + 1) // 2) * ((height + 1) // 2) AS expected FROM v_size),
        (SELECT count(*) AS written FROM
            (SELECT 1 FROM v_grid GROUP BY px // 2, py // 2 HAVING max(b2) > 0))""",
)
def empty_blocks(spark, sf):
    pixels = fx.grid(spark, sf)
    raster = px.measured(pixels, _small(fx.B2))
    stored = tiling.base_blocks(pixels, raster)
    return tiling.missing_blocks(stored, raster.tiles_wide * raster.tiles_high)


@query(
    "band_merge",
    sql=f"""
    SELECT {_SMALL_CELL} AS block, CASE WHEN m2 > 0 THEN b2 END AS b2,
        CASE WHEN m3 > 0 THEN b3 END AS b3
    FROM (SELECT tx, ty, max(v2) AS m2, max(v3) AS m3,
            string_agg(printf('%02X', v2), '' ORDER BY pos) AS b2,
            string_agg(printf('%02X', v3), '' ORDER BY pos) AS b3
        FROM (SELECT t.tx, t.ty, t.pos, coalesce(b2, 0) AS v2, coalesce(b3, 0) AS v3
            FROM (SELECT *, unnest(range(4)) AS pos FROM (SELECT DISTINCT
                (px + {fx.TILE_X0 * 64}) // 2 AS tx, (py + {fx.TILE_Y0 * 64}) // 2 AS ty
                FROM v_grid)) t
            LEFT JOIN v_grid g ON g.px = t.tx * 2 + t.pos % 2 - {fx.TILE_X0 * 64}
                AND g.py = t.ty * 2 + t.pos // 2 - {fx.TILE_Y0 * 64})
        GROUP BY tx, ty)
    WHERE m2 > 0 OR m3 > 0""",
)
def band_merge(spark, sf):
    """Bands tiled apart and joined on their block."""
    pixels = fx.grid(spark, sf)
    parts = [tiling.base_blocks(pixels, _small(b)) for b in (fx.B2, fx.B3)]
    merged = tiling.merge_bands(parts)
    return merged.select("block", F.hex("b2").alias("b2"), F.hex("b3").alias("b3"))


@query(
    "batch_assign",
    sql=f"""
    SELECT block, (row_number() OVER (ORDER BY block) - 1) // 1000 AS batch
    FROM (SELECT DISTINCT {fx.cell(f"(px + {fx.TILE_X0 * 64}) // 2",
                                   f"(py + {fx.TILE_Y0 * 64}) // 2", str(fx.ZOOM + 5))} AS block
        FROM v_grid)""",
)
def batch_assign(spark, sf):
    """Blocks numbered into batches of a thousand."""
    raster = fx.plane(fx.B1, edge=2)
    placed = tiling.with_position(tiling.on_levels(fx.places(spark, sf), raster), raster)
    placed = placed.select("tile_x", "tile_y").distinct()
    blocks = with_cell(placed, "tile_x", "tile_y", raster.zoom)
    return tiling.with_batch(blocks.select("block"), 1000).select("block", "batch")


# -- pyramids ------------------------------------------------------------------


@query(
    "overview_valid",
    sql="""
    SELECT raster, NOT (broken AND levels > 0) AS factors_ok, shapes = 1 AS shapes_ok
    FROM (SELECT raster, bool_or(broken) AS broken, max(levels) AS levels,
            count(DISTINCT CASE WHEN band = 2 AND max_zoom = 9 THEN edge + 1 ELSE edge END)
                AS shapes
        FROM v_catalog GROUP BY raster)""",
)
def overview_valid(spark, sf):
    """Per raster, whether its overview factors and its block shapes are as they must be."""
    factors = F.transform(
        F.slice(F.array(*[F.lit(2**k) for k in range(1, 5)]), 1, F.col("levels")),
        lambda f: F.when(F.col("broken"), f + 1).otherwise(f),
    )
    shape = F.when((F.col("band") == 2) & (F.col("max_zoom") == 9), F.col("edge") + 1).otherwise(
        F.col("edge")
    )
    return (
        fx.catalog(spark, sf)
        .withColumns({"ok": overviews.valid_factors(factors), "shape": shape})
        .groupBy("raster")
        .agg(
            F.bool_and("ok").alias("factors_ok"),
            (F.count_distinct("shape") == 1).alias("shapes_ok"),
        )
    )


_LEVELS_SQL = f"""
    SELECT level, {fx.TILE_X0} // (1 << level) AS x0, {fx.TILE_Y0} // (1 << level) AS y0,
        ({fx.TILE_X0} + (width + 63) // 64 - 1) // (1 << level) AS x1,
        ({fx.TILE_Y0} + (height + 63) // 64 - 1) // (1 << level) AS y1
    FROM v_size, (SELECT unnest(range(1, 7))::INT AS level)"""


@query(
    "overview_tiles",
    sql=f"""
    SELECT level, tile_x, tile_y, {fx.ZOOM} - level AS z,
        (tile_x * (1 << level) - {fx.TILE_X0}) * 64 AS col_off,
        (tile_y * (1 << level) - {fx.TILE_Y0}) * 64 AS row_off,
        (1 << level) * 64 AS width, (1 << level) * 64 AS height,
        {fx.cell("tile_x", "tile_y", f"{fx.ZOOM} - level")} AS block
    FROM (SELECT *, unnest(range(y0, y1 + 1)) AS tile_y
        FROM (SELECT *, unnest(range(x0, x1 + 1)) AS tile_x FROM ({_LEVELS_SQL})))""",
)
def overview_tiles(spark, sf):
    raster = px.measured(fx.grid(spark, sf), fx.plane(fx.B1, levels=6))
    return overviews.overview_tiles(spark, raster)


@query(
    "overview_count",
    sql=f"""
    SELECT CAST(sum((x1 - x0 + 1) * (y1 - y0 + 1)) AS BIGINT) AS tiles,
        (SELECT ((width + 63) // 64) * ((height + 63) // 64) FROM v_size) AS base_tiles
    FROM ({_LEVELS_SQL})""",
)
def overview_count(spark, sf):
    """Pyramid tiles by arithmetic, next to the base tiles; dims come from the pixels."""
    profile = px.profile(fx.grid(spark, sf), fx.plane(fx.B1))
    return overviews.counted(profile, fx.plane(fx.B1, levels=6))


@query(
    "overview_pixels",
    sql="SELECT level, z, gx, gy, b1, b2 FROM v_levels WHERE level > 0",
)
def overview_pixels(spark, sf):
    """Which pixel each pyramid level keeps."""
    raster = fx.plane(fx.B1, fx.B2, levels=3)
    kept = tiling.on_levels(fx.grid(spark, sf), raster, base=False)
    kept = tiling.with_position(kept, raster)
    return kept.select("level", "z", "gx", "gy", "b1", "b2")


@query(
    "block_table",
    sql=f"""
    SELECT {CELL} AS block, {hex_sql()} AS b1 FROM ({dense_sql("b1", levels=True)})
    GROUP BY tx, ty, z""",
)
def block_table(spark, sf):
    """Pyramid and base blocks of a raster, from one pass and one shuffle."""
    raster = fx.plane(fx.B1, levels=3)
    stored = tiling.blocks(fx.grid(spark, sf), raster, in_order=True)
    return stored.select("block", F.hex("b1").alias("b1"))
