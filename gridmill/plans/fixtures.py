"""Rasters derived from the given tables, as DataFrames and as the same views in plain SQL."""

from __future__ import annotations

import re
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmill.scratch import scratch
from gridmill.spec import Band, Raster

DTYPES = (
    "int8", "int16", "int32", "int64", "uint8", "uint16", "uint32", "uint64", "float16",
    "float32", "float64",
)

# The pixel plane of the line items: 512 pixels wide, as high as the table is long.
GRID_BITS = 9
GRID_WIDTH = 1 << GRID_BITS
ZOOM, TILE_X0, TILE_Y0, EDGE = 18, 133120, 97280, 64
SEED = 42


def plane(*bands: Band, edge: int = EDGE, nodata=None, levels: int = 0) -> Raster:
    """A raster of those bands on the plane; smaller blocks lie at a deeper zoom."""
    deeper = (EDGE // edge).bit_length() - 1
    return Raster(
        bands=bands,
        zoom=ZOOM + deeper,
        tile_x0=TILE_X0 << deeper,
        tile_y0=TILE_Y0 << deeper,
        block_width=edge,
        block_height=edge,
        nodata=nodata,
        overviews=tuple(2**k for k in range(1, levels + 1)),
    )


B1, B2, B3 = Band("b1"), Band("b2"), Band("b3")
COLOURS = plane(
    Band("c1", colorinterp="red"),
    Band("b2", colorinterp="green"),
    Band("b3", colorinterp="blue"),
    nodata=0,
)
WITH_ALPHA = plane(B1, B2, Band("f1", "float64"), Band("a1", colorinterp="alpha"), nodata=0)
FLOATS = plane(Band("g1", "float64"))


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def grid(spark: SparkSession, sf: str) -> DataFrame:
    """Pixels ``px, py, b1, b2, b3, f1, a1`` of the line items, one row per pixel."""
    k = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    return (
        table(spark, sf, "lineitem")
        .groupBy((k % GRID_WIDTH).alias("px"), F.shiftright(k, GRID_BITS).alias("py"))
        .agg(
            F.max(F.col("l_quantity").cast("int")).alias("b1"),
            F.max(F.round(F.col("l_discount") * 100).cast("int")).alias("b2"),
            F.max(F.round(F.col("l_tax") * 100).cast("int")).alias("b3"),
            F.max("l_extendedprice").alias("f1"),
            F.max(F.when(F.col("l_returnflag") == "N", 255).otherwise(0)).alias("a1"),
        )
    )


def places(spark: SparkSession, sf: str) -> DataFrame:
    """The places ``px, py`` of the pixels, once per line item that lies there."""
    k = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    return table(spark, sf, "lineitem").select(
        (k % GRID_WIDTH).alias("px"), F.shiftright(k, GRID_BITS).alias("py")
    )


def staged(pixels: DataFrame) -> DataFrame:
    """The pixels as a stored table, so that the passes of a load scan files, not their origin."""
    folder = scratch(pixels.sparkSession)
    pixels.write.parquet(folder)
    return pixels.sparkSession.read.schema(pixels.schema).parquet(folder)


def coloured(spark: SparkSession, sf: str) -> DataFrame:
    return grid(spark, sf).withColumn("c1", F.col("b1") % 5)


def gappy(spark: SparkSession, sf: str) -> DataFrame:
    """Pixels with a float band that has no number where b2 is 0."""
    gap = F.when(F.col("b2") == 0, F.lit(float("nan"))).otherwise(F.col("f1"))
    return grid(spark, sf).withColumn("g1", gap)


def strips(spark: SparkSession, sf: str) -> DataFrame:
    """One raster per row of tiles: ``strip, width, height``; the last may be lower."""
    return (
        grid(spark, sf)
        .groupBy(F.shiftright("py", 6).alias("strip"))
        .agg((F.max("px") + 1).alias("width"), (F.max("py") % EDGE + 1).alias("height"))
    )


def points(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as points, with a zoom each."""
    key = F.col("c_custkey")
    return table(spark, sf, "customer").select(
        key.alias("id"),
        (key * 137.50776405 % 360 - 180).alias("lon"),
        (key * 61.8033989 % 170 - 85).alias("lat"),
        (key % 23 + 1).cast("int").alias("zoom"),
    )


def catalog(spark: SparkSession, sf: str) -> DataFrame:
    """Parts as a catalogue of rasters: one row per raster band."""
    key, size = F.col("p_partkey"), F.col("p_size")
    n = (key % 4 + 1).cast("int")
    kinds = F.array(*[F.lit(d) for d in DTYPES])
    shift = F.when(size % 3 == 0, F.col("band")).otherwise(0)
    colours = F.array(*[F.lit(c) for c in ("red", "green", "blue", "alpha")])
    out = table(spark, sf, "part").select(
        "p_partkey", "p_size", n.alias("n"), F.explode(F.sequence(F.lit(1), n)).alias("band")
    )
    return out.select(
        key.alias("raster"),
        "band",
        F.element_at(kinds, ((key + shift) % 11 + 1).cast("int")).alias("dtype"),
        F.when(size % 4 == 0, -9999.0).when(size % 4 == 1, float("nan")).alias("ds_nodata"),
        F.when((key + F.col("band")) % 3 == 0, size.cast("double")).alias("band_nodata"),
        F.when(F.col("n") >= 3, F.element_at(colours, F.col("band")))
        .when((F.col("n") == 1) & (size % 2 == 0), "palette")
        .otherwise("gray")
        .alias("colorinterp"),
        F.when(size % 3 == 0, 512).when(size % 3 == 1, 256).otherwise(64).alias("edge"),
        (size % 13 + 5).alias("max_zoom"),
        (size % 5).alias("levels"),
        (size % 7 == 0).alias("broken"),
        (size * 100 + F.col("band") % 2).alias("width"),
        (size * 50).alias("height"),
    )


def array_tiles(spark: SparkSession, sf: str) -> DataFrame:
    """Embeddings as 8 x 8 tiles of a float32 band, 32 tiles in a row."""
    return table(spark, sf, "embeddings").select(
        (TILE_X0 + F.col("vec_id") % 32).alias("tile_x"),
        (TILE_Y0 + F.shiftright("vec_id", 5)).alias("tile_y"),
        F.col("embedding").alias("band_1"),
    )


ARRAY_TILES = Raster(
    (Band("band_1", "float32"),), ZOOM, TILE_X0, TILE_Y0, 8, 8, overviews=(2, 4, 8)
)


def renamed(raster: Raster, **names: str) -> Raster:
    return replace(
        raster, bands=tuple(replace(b, name=names.get(b.name, b.name)) for b in raster.bands)
    )


# -- the same views in SQL ---------------------------------------------------------


def cell(x: str, y: str, z: str) -> str:
    """SQL for the cell id of a tile: the bits of x and y, summed one by one."""
    bits = (
        f"coalesce(list_sum([((CAST({x} AS BIGINT) >> i) & 1) * (1::BIGINT << (2*i))"
        f" + ((CAST({y} AS BIGINT) >> i) & 1) * (1::BIGINT << (2*i + 1))"
        f" FOR i IN range(CAST({z} AS BIGINT))]), 0)"
    )
    pad = f"(1::BIGINT << CAST(52 - 2 * ({z}) AS INT))"
    return (
        f"CAST(5188146770730811392 + CAST({z} AS BIGINT) * 4503599627370496"
        f" + {bits}::BIGINT * {pad} + {pad} - 1 AS BIGINT)"
    )


def tile_of(lon: str, lat: str, z: str) -> tuple[str, str]:
    """SQL for the web Mercator tile of a point away from the poles."""
    n = f"pow(2, {z})"
    x = f"CAST(floor({n} * (({lon}) / 360 + 0.5)) AS BIGINT) % CAST({n} AS BIGINT)"
    s = f"sin(radians({lat}))"
    y = f"CAST(floor({n} * (0.5 - 0.25 * ln((1 + {s}) / (1 - {s})) / pi())) AS BIGINT)"
    return x, y


def lon_of(x: str, z: str = str(ZOOM)) -> str:
    return f"(({x}) / pow(2, {z}) * 360 - 180)"


def lat_of(y: str, z: str = str(ZOOM)) -> str:
    return f"degrees(atan(sinh(pi() * (1 - 2 * ({y}) / pow(2, {z})))))"


_KINDS = ", ".join(f"'{d}'" for d in DTYPES)

VIEWS = {
    "v_grid": f"""
        SELECT k % {GRID_WIDTH} AS px, k // {GRID_WIDTH} AS py,
            max(CAST(l_quantity AS INT)) AS b1, max(CAST(round(l_discount * 100) AS INT)) AS b2,
            max(CAST(round(l_tax * 100) AS INT)) AS b3, max(l_extendedprice) AS f1,
            max(CASE WHEN l_returnflag = 'N' THEN 255 ELSE 0 END) AS a1
        FROM (SELECT *, l_orderkey * 8 + l_linenumber AS k FROM lineitem) GROUP BY k""",
    "v_size": """SELECT max(px) + 1 AS width, max(py) + 1 AS height FROM v_grid""",
    "v_tiles": f"""
        SELECT {TILE_X0} + i % nx AS tile_x, {TILE_Y0} + i // nx AS tile_y,
            i % nx AS tx, i // nx AS ty
        FROM (SELECT nx, unnest(range(nx * ny)) AS i FROM (
            SELECT (width + {EDGE - 1}) // {EDGE} AS nx, (height + {EDGE - 1}) // {EDGE} AS ny
            FROM v_size))""",
    "v_gappy": """
        SELECT *, CASE WHEN b2 = 0 THEN 'nan'::DOUBLE ELSE f1 END AS g1 FROM v_grid""",
    "v_strips": f"""
        SELECT py // {EDGE} AS strip, max(px) + 1 AS width, max(py) % {EDGE} + 1 AS height
        FROM v_grid GROUP BY py // {EDGE}""",
    "v_points": """
        SELECT c_custkey AS id, c_custkey * 137.50776405::DOUBLE % 360 - 180 AS lon,
            c_custkey * 61.8033989::DOUBLE % 170 - 85 AS lat,
            CAST(c_custkey % 23 + 1 AS INT) AS zoom
        FROM customer""",
    "v_catalog": f"""
        SELECT p_partkey AS raster, CAST(band AS INT) AS band,
            ([{_KINDS}])[CAST((p_partkey + CASE WHEN p_size % 3 = 0 THEN band ELSE 0 END) % 11 + 1
                AS INT)] AS dtype,
            CASE p_size % 4 WHEN 0 THEN -9999.0::DOUBLE WHEN 1 THEN 'nan'::DOUBLE END AS ds_nodata,
            CASE WHEN (p_partkey + band) % 3 = 0 THEN CAST(p_size AS DOUBLE) END AS band_nodata,
            CASE WHEN n >= 3 THEN (['red', 'green', 'blue', 'alpha'])[band]
                WHEN n = 1 AND p_size % 2 = 0 THEN 'palette' ELSE 'gray' END AS colorinterp,
            CASE p_size % 3 WHEN 0 THEN 512 WHEN 1 THEN 256 ELSE 64 END AS edge,
            p_size % 13 + 5 AS max_zoom, p_size % 5 AS levels, p_size % 7 = 0 AS broken,
            CAST(p_size * 100 + band % 2 AS INT) AS width, p_size * 50 AS height
        FROM (SELECT *, unnest(range(1, n + 1)) AS band
            FROM (SELECT *, p_partkey % 4 + 1 AS n FROM part))""",
    "v_array_tiles": f"""
        SELECT {TILE_X0} + vec_id % 32 AS tile_x, {TILE_Y0} + vec_id // 32 AS tile_y,
            embedding AS band_1 FROM embeddings""",
    # Pixels of the base and of three pyramid levels, in global coordinates of their level.
    "v_levels": f"""
        SELECT g.*, k AS level, {ZOOM} - k AS z, gx0 // (1 << k) AS gx, gy0 // (1 << k) AS gy
        FROM (SELECT *, px + {TILE_X0 * EDGE} AS gx0, py + {TILE_Y0 * EDGE} AS gy0 FROM v_grid) g,
            (SELECT unnest(range(4))::INT AS k)
        WHERE k = 0 OR (gx0 % (1 << k) = (1 << (k - 1)) AND gy0 % (1 << k) = (1 << (k - 1)))""",
}


def with_views(sql: str) -> str:
    """Put the views that a statement uses in front of it."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in VIEWS:
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(VIEWS[name])
                needed.append(name)

    visit(sql)
    parts = [f"{name} AS ({VIEWS[name].strip()})" for name in needed]
    sql = sql.strip()
    if sql.upper().startswith("WITH "):
        parts.append(sql[5:].lstrip())
        return "WITH " + ",\n".join(parts)
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + sql
