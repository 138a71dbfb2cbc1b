import random

import pytest
from pyspark.sql import functions as F

from gridmill.functions import cells, geo


def one(frame, column):
    return frame.first()[column]


def test_known_cells(spark):
    points = spark.createDataFrame([(10.0, -10.0)], "lon double, lat double")
    assert one(cells.with_point_cell(points, "lon", "lat", 4), "block") == 5209556461146865663
    points = spark.createDataFrame(
        [(16.874999999997062, 44.951198666691475)], "lon double, lat double"
    )
    found = cells.with_tile(cells.with_point_cell(points, "lon", "lat", 5)).first()
    assert (found.block, found.tile_x, found.tile_y, found.z) == (5212406395286061055, 17, 11, 5)


def test_round_trip_and_family(spark):
    rng = random.Random(3)
    rows = []
    for z in range(27):
        for _ in range(8):
            rows.append((rng.randrange(2**z), rng.randrange(2**z), z))
        rows += [(0, 0, z), (2**z - 1, 2**z - 1, z)]
    tiles = spark.createDataFrame(rows, "x long, y long, zoom int")
    coded = cells.with_cell(tiles, "x", "y", "zoom")
    back = cells.with_tile(coded)
    assert back.where("x <> tile_x OR y <> tile_y OR zoom <> z").count() == 0
    assert coded.select("block").distinct().count() == tiles.distinct().count()

    up = cells.with_parent(coded.where("zoom >= 2"), "block", 2)
    up = cells.with_tile(up, "parent")
    assert up.where("tile_x <> x div 4 OR tile_y <> y div 4 OR z <> zoom - 2").count() == 0
    assert one(cells.with_parent(coded.where("zoom = 0"), "block", 1), "parent") is None

    down = cells.with_children(coded.where("zoom <= 24"), "block", 2)
    assert down.count() == 16 * coded.where("zoom <= 24").count()
    down = cells.with_tile(down, "child")
    assert down.where("tile_x div 4 <> x OR tile_y div 4 <> y OR z <> zoom + 2").count() == 0
    assert down.select("child").distinct().count() == 16 * coded.where("zoom <= 24").select(
        "block"
    ).distinct().count()


def test_literal_zoom_agrees(spark):
    tiles = spark.createDataFrame([(x, y) for x in range(16) for y in range(16)], "x long, y long")
    both = cells.with_cell(cells.with_cell(tiles, "x", "y", 4, "a").withColumn("z", F.lit(4)), "x", "y", "z", "b")
    assert both.where("a <> b").count() == 0


def test_edges_of_the_world(spark):
    points = spark.createDataFrame(
        [(180.0, 0.0), (-180.0, 0.0), (540.0, 0.0), (0.0, 90.0), (0.0, -90.0)],
        "lon double, lat double",
    )
    found = cells.with_point_tile(points, "lon", "lat", 3).collect()
    assert [r.tile_x for r in found] == [0, 0, 0, 4, 4]
    assert [r.tile_y for r in found] == [4, 4, 4, 0, 7]


def test_zoom_range(spark):
    tiles = spark.createDataFrame([(0, 0, 3), (7, 7, 3), (0, 0, 4), (3, 3, 2)], "x long, y long, z int")
    low, high = cells.zoom_range(3)
    kept = cells.with_cell(tiles, "x", "y", "z").where(F.col("block").between(low, high))
    assert [r.z for r in kept.collect()] == [3, 3]


def test_filter_on_cell_stays_small(spark):
    """A filter pushed below the encoding must not make the plan explode."""
    tiles = spark.range(10).select(F.col("id").alias("x"), F.col("id").alias("y"))
    plan = cells.with_cell(tiles, "x", "y", 18).where("block > 5")
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("shiftright") < 50


@pytest.mark.parametrize(
    "lon, normal", [(190.0, -170.0), (-180.0, 180.0), (180.0, 180.0), (-190.0, 170.0), (5.0, 5.0)]
)
def test_norm_lon(spark, lon, normal):
    assert spark.range(1).select(geo.norm_lon(F.lit(lon)).alias("x")).first().x == normal


def test_known_corners(spark):
    """Corners of tile (17, 11) at zoom 5."""
    z = F.lit(5)
    row = spark.range(1).select(
        geo.tile_lon(F.lit(17), z), geo.tile_lat(F.lit(12), z), geo.tile_lon(F.lit(18), z),
        geo.tile_lat(F.lit(11), z),
    ).first()
    assert row[0] == 11.25 and row[2] == 22.5
    assert abs(row[1] - 40.97989806962013) < 1e-11 and abs(row[3] - 48.92249926375824) < 1e-11


def test_ring_is_cleaned_against_the_last_kept_point(spark):
    points = [(0.0, 0.0), (6e-14, 0.0), (1.2e-13, 0.0), (5.0, 5.0), (1e-14, 0.0)]
    frame = spark.createDataFrame([([{"x": x, "y": y} for x, y in points],)], "r array<struct<x double, y double>>")
    ring = frame.select(geo.clean_ring(F.col("r")).alias("r")).first().r
    assert [(p.x, p.y) for p in ring] == [(0.0, 0.0), (1.2e-13, 0.0), (5.0, 5.0), (0.0, 0.0)]


def test_edge_has_at_least_two_points(spark):
    row = spark.range(1).select(
        geo.edge(F.lit(0), F.lit(4), F.lit(8), F.lit(4), F.lit(0)).alias("e")
    ).first()
    assert [(p.x, p.y) for p in row.e] == [(0.0, 4.0), (8.0, 4.0)]


def test_resolutions(spark):
    row = spark.range(1).select(
        geo.block_resolution(F.lit(9), F.lit(512), F.lit(512)).alias("r"),
        geo.pixel_resolution(F.lit(8), F.lit(512), F.lit(512)).alias("p"),
    ).first()
    assert (row.r, row.p) == (8, 17)
    with pytest.raises(Exception, match="26"):
        spark.range(1).select(
            geo.checked_pixel_resolution(F.lit(20), F.lit(256), F.lit(256))
        ).collect()
