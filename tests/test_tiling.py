import gzip
import math
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridmill import Band, Raster
from gridmill.functions import nodata
from gridmill.operators import arrays, overviews, tiling
from gridmill.sources.pixels import measured, pixels_of_tiles, profile, unique_pixels
from gridmill.spec import DEFAULT_NODATA


def frame(spark, values, raster):
    """A pixel table of a 2-D array (one band)."""
    name, kind = raster.bands[0].name, raster.bands[0].spark_type.simpleString()
    rows = [
        (x, y, values[y][x]) for y in range(len(values)) for x in range(len(values[0]))
    ]
    return spark.createDataFrame(
        [(x, y, str(v)) for x, y, v in rows], "px long, py long, v string"
    ).select("px", "py", F.col("v").cast(kind).alias(name))


SAMPLES = {
    "int8": [-128, -1, 0, 127], "int16": [-32768, 5, -7, 32767],
    "int32": [-(2**31), 9, 2**31 - 1, -3], "int64": [-(2**63), 2**63 - 1, 2**53 + 1, -1],
    "uint8": [0, 1, 200, 255], "uint16": [0, 65535, 300, 7], "uint32": [0, 2**32 - 1, 70000, 1],
    "uint64": [0, 2**64 - 1, 2**63, 2**63 - 1], "float16": [0.5, -2.0, 65504.0, 1.5],
    "float32": [0.1, -1e30, 3.5, 7.25], "float64": [0.1, -1e300, math.pi, 2.0],
}


@pytest.mark.parametrize("dtype", list(DEFAULT_NODATA))
@pytest.mark.parametrize("compress", [False, True])
def test_bytes_are_little_endian_rows_and_decode_back(spark, dtype, compress):
    raster = Raster((Band("v", dtype),), 6, 5, 3, 4, 4)
    a, b, c, d = SAMPLES[dtype]
    grid = [[a, b, c, d, a], [b, c, d, a, b], [d, d, a, a, c]]
    stored = tiling.base_blocks(
        frame(spark, grid, raster), raster, compress=compress, keep_empty=True
    )
    expected = np.full((4, 8), DEFAULT_NODATA[dtype], dtype=np.dtype(dtype).newbyteorder("<"))
    expected[:3, :5] = np.array(grid, dtype=dtype)
    found = {r.tile_x: bytes(r.v) for r in tiling.with_tile(stored, "block").collect()}
    assert sorted(found) == [5, 6]
    for tx, data in found.items():
        data = gzip.decompress(data) if compress else data
        assert data == expected[:, (tx - 5) * 4 : (tx - 4) * 4].tobytes()
    pixels = tiling.decode(stored, raster, compress).collect()
    for r in pixels:
        want = expected[r.gy - 12, r.gx - 20]
        assert np.dtype(dtype).type(r.v) == want or (math.isnan(r.v) and math.isnan(want))


def test_compression_levels(spark):
    raster = Raster((Band("v"),), 6, 0, 0, 64, 64)
    pixels = spark.range(64 * 64).selectExpr("id % 64 AS px", "id div 64 AS py", "CAST(id % 7 + 1 AS short) AS v")
    plain = bytes(tiling.base_blocks(pixels, raster).first().v)
    for level in (1, 6, 9):
        packed = bytes(
            tiling.base_blocks(pixels, raster, compress=True, compression_level=level).first().v
        )
        assert packed[:2] == b"\x1f\x8b" and gzip.decompress(packed) == plain
        assert len(packed) < len(plain)


def test_a_tile_that_spans_many_batches_is_one_block(spark):
    """More rows per tile than an Arrow batch holds, and many small tiles per batch."""
    raster = Raster((Band("v", "int32"),), 8, 0, 0, 64, 64)
    pixels = spark.range(128 * 128).selectExpr("id % 128 AS px", "id div 128 AS py", "CAST(id AS int) AS v")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 1000)
    try:
        for r in (raster, replace(raster, block_width=2, block_height=2, zoom=13)):
            stored = tiling.base_blocks(pixels, r)
            assert stored.count() == 128 * 128 // r.cells
            back = tiling.decode(stored, r)
            assert back.where("v = gy * 128 + gx").count() == 128 * 128
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_memory_bound_splits_a_batch(spark, monkeypatch):
    monkeypatch.setattr(tiling, "DENSE_CELLS", 32)
    raster = Raster((Band("v", "int32"),), 8, 0, 0, 4, 4)
    pixels = spark.range(64 * 64).selectExpr("id % 64 AS px", "id div 64 AS py", "CAST(id AS int) AS v")
    back = tiling.decode(tiling.base_blocks(pixels, raster), raster)
    assert back.where("v = gy * 64 + gx").count() == 64 * 64


def test_empty_bands_and_blocks(spark):
    raster = Raster((Band("a", nodata=0), Band("b", nodata=0)), 6, 0, 0, 2, 2)
    rows = [(0, 0, 1, 0), (2, 0, 0, 0), (4, 0, 0, 3), (6, 1, 5, 5)]
    pixels = spark.createDataFrame(rows, "px long, py long, a short, b short")
    found = {
        r.tile_x: (r.a is not None, r.b is not None)
        for r in tiling.with_tile(tiling.base_blocks(pixels, raster), "block").collect()
    }
    assert found == {0: (True, False), 2: (False, True), 3: (True, True)}
    counts = tiling.missing_blocks(tiling.base_blocks(pixels, raster), 4).first()
    assert (counts.expected, counts.written, counts.empty) == (4, 3, 1)


def test_nan_tiles_stay_unless_asked(spark):
    raster = Raster((Band("f", "float32"),), 6, 0, 0, 2, 2)
    pixels = spark.createDataFrame([(0, 0, math.nan), (2, 0, 1.0)], "px long, py long, f float")
    assert tiling.base_blocks(pixels, raster).count() == 2
    assert tiling.base_blocks(pixels, raster, drop_nan=True).count() == 1


def test_masked_pixels_are_filled(spark):
    alpha = Band("x", "uint16", colorinterp="alpha")
    raster = Raster((Band("v", "uint16"), alpha), 6, 0, 0, 2, 2, nodata=9)
    rows = [(0, 0, 5, 1), (1, 0, 6, 0), (0, 1, None, 1), (1, 1, 7, None)]
    pixels = spark.createDataFrame(rows, "px long, py long, v int, x int")
    row = tiling.base_blocks(pixels, raster).first()
    assert np.frombuffer(row.v, "<u2").tolist() == [5, 9, 9, 9]
    assert np.frombuffer(row.x, "<u2").tolist() == [1, 0, 1, 0]


def test_masks_of_odd_nodata(spark):
    pixels = spark.createDataFrame([(0, 0, 5, 0.5)], "px long, py long, a short, f float")
    r = Raster((Band("a"), Band("f", "float32")), 6, 0, 0, nodata=-3.4028234663852886e38)
    row = pixels.select(nodata.masked(r, "a").alias("a"), nodata.masked(r, "f").alias("f")).first()
    assert (row.a, row.f) == (False, False)
    r = Raster((Band("f", "float32"),), 6, 0, 0, nodata=0.5)
    assert pixels.select(nodata.masked(r, "f").alias("f")).first().f is True


def brute_pyramid(values, raster, fill):
    """All blocks of a small raster, straight from the rule."""
    out = {}
    bw, bh = raster.block_width, raster.block_height
    for k in range(raster.levels + 1):
        f = 1 << k
        for y in range(len(values)):
            for x in range(len(values[0])):
                gx, gy = raster.tile_x0 * bw + x, raster.tile_y0 * bh + y
                if k and (gx % f != f // 2 or gy % f != f // 2):
                    continue
                gx, gy = gx // f, gy // f
                tile = out.setdefault(
                    (raster.zoom - k, gx // bw, gy // bh), np.full((bh, bw), fill)
                )
                tile[gy % bh, gx % bw] = values[y][x]
    return out


@pytest.mark.parametrize("x0, y0", [(0, 0), (5, 3), (6, 7)])
def test_pyramid_matches_its_rule(spark, x0, y0):
    raster = Raster((Band("v", "int16"),), 6, x0, y0, 4, 4, overviews=(2, 4, 8))
    values = [[y * 100 + x for x in range(22)] for y in range(19)]
    expected = brute_pyramid(values, raster, -32768)
    pixels = frame(spark, values, raster)
    for stored in (tiling.blocks(pixels, raster), tiling.blocks(pixels, raster, in_order=True)):
        rows = tiling.with_tile(stored, "block").collect()
        found = {(r.z, r.tile_x, r.tile_y): np.frombuffer(r.v, "<i2").reshape(4, 4) for r in rows}
        assert sorted(found) == sorted(expected)
        assert all((found[key] == expected[key]).all() for key in expected)


def test_pyramid_tiles_cover_the_base(spark):
    raster = Raster((Band("v"),), 6, 5, 3, 4, 4, overviews=(2, 4)).sized(22, 19)
    tiles = overviews.overview_tiles(spark, raster)
    assert tiles.count() == overviews.overview_count(raster)
    base = tiling.block_grid(spark, raster)
    for level in (1, 2):
        parents = tiling.with_parent(base, "block", level).select("parent").distinct()
        of_level = tiles.where(F.col("level") == level).select(F.col("block").alias("parent"))
        assert parents.exceptAll(of_level).isEmpty() and of_level.count() >= parents.count()


def test_tiles_given_as_arrays(spark):
    raster = Raster((Band("v", "int16"),), 6, 5, 3, 4, 4, overviews=(2, 4))
    values = [[y * 100 + x for x in range(20)] for y in range(16)]
    pixels = frame(spark, values, raster)
    tiles = tiling.with_tile(tiling.to_arrays(tiling.base_blocks(pixels, raster), raster), "block")
    again = pixels_of_tiles(tiles, raster)
    assert again.exceptAll(pixels).isEmpty() and again.count() == pixels.count()
    ours = arrays.blocks_of_tiles(tiles.select("tile_x", "tile_y", "v"), raster)
    theirs = tiling.blocks(pixels, raster)
    assert ours.exceptAll(theirs).isEmpty() and ours.count() == theirs.count()


def test_copies_of_a_pixel(spark):
    """A third of all rows are copies of one pixel."""
    rows = spark.range(9000).selectExpr(
        "IF(id % 3 = 0, 7, id % 90) AS px", "IF(id % 3 = 0, 7, id div 90) AS py", "CAST(id % 251 AS short) AS v"
    )
    single = unique_pixels(rows, ["v"])
    assert single.count() == rows.select("px", "py").distinct().count()
    raster = measured(single, Raster((Band("v"),), 8, 0, 0, 16, 16))
    facts = profile(single, raster).first()
    assert (facts.width, facts.height) == (raster.width, raster.height) == (90, 100)
    assert facts.num_windows == raster.tiles_wide * raster.tiles_high == 6 * 7
    back = tiling.decode(tiling.base_blocks(single, raster, keep_empty=True), raster)
    written = single.select(F.col("px").alias("gx"), F.col("py").alias("gy"), F.col("v").alias("w"))
    joined = back.join(written, ["gx", "gy"])
    assert joined.count() == single.count() and joined.where("v <> w").isEmpty()


def test_batches(spark):
    raster = Raster((Band("v"),), 10, 0, 0, 2, 2).sized(80, 60)
    blocks = tiling.block_grid(spark, raster).select("block")
    rows = tiling.with_batch(blocks, 500).orderBy("block").collect()
    assert [r["rank"] for r in rows] == list(range(1200))
    assert [r.batch for r in rows] == [i // 500 for i in range(1200)]
    with pytest.raises(ValueError):
        tiling.with_batch(blocks, 0)


def test_batches_take_the_blocks_once(spark):
    """Where the blocks come from is read once, whatever ranks need to know beforehand."""
    taken = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            taken.add(batch.num_rows)
            yield batch

    cells = spark.range(5000).repartition(7).selectExpr("5188146770730811392 + id * 7 AS block")
    rows = tiling.with_batch(cells.mapInArrow(counted, "block long"), 300).collect()
    assert taken.value == 5000
    assert sorted((r.block, r["rank"], r.batch) for r in rows) == [
        (5188146770730811392 + i * 7, i, i // 300) for i in range(5000)
    ]
    assert tiling.with_batch(cells.limit(0), 300).count() == 0


def test_one_shuffle_for_the_whole_pyramid(spark):
    raster = Raster((Band("v"),), 10, 0, 0, 2, 2, overviews=(2, 4))
    pixels = spark.range(100).selectExpr("id AS px", "id AS py", "CAST(1 AS short) AS v")
    for in_order in (False, True):
        plan = tiling.blocks(pixels, raster, in_order=in_order)
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert text.count("Exchange") == 1, text
