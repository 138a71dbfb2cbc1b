import json

import numpy as np
from pyspark.sql import functions as F

from gridmill import Band, Raster
from gridmill.operators import tiling
from gridmill.plans.load import load_raster
from gridmill.sources.tables import BlockTable
from gridmill.streaming.append import append_stream

RASTER = Raster((Band("v", "int16"),), 10, 4, 4, 16, 16)


def pixels(spark, first, last):
    return spark.range(first * 16 * 64, last * 16 * 64).selectExpr(
        "id % 64 AS px", "id div 64 AS py", "CAST(id % 500 AS short) AS v"
    )


def test_micro_batches_equal_one_load(spark, tmp_path):
    arriving = str(tmp_path / "arriving")
    table = BlockTable(spark, str(tmp_path / "stream"))

    def drain():
        source = spark.readStream.schema(pixels(spark, 0, 1).schema)
        source = source.option("maxFilesPerTrigger", 1).parquet(arriving)
        stream = append_stream(
            source, RASTER, table, str(tmp_path / "progress"), exact_stats=True, basic_stats=True
        )
        stream.awaitTermination()

    for strip in range(3):
        pixels(spark, strip, strip + 1).coalesce(1).write.mode("append").parquet(arriving)
        drain()
    drain()  # nothing new

    whole = BlockTable(spark, str(tmp_path / "whole"))
    load_raster(pixels(spark, 0, 3), RASTER, whole, exact_stats=True, basic_stats=True)
    ours, theirs = table.data(), whole.data()
    assert ours.exceptAll(theirs).isEmpty() and ours.count() == theirs.count() == 12
    a, b = table.metadata(), whole.metadata()
    assert (a["num_blocks"], a["num_pixels"], a["width"], a["height"]) == (12, 3072, 64, 48)
    assert a["bounds"] == b["bounds"]
    mine, other = a["bands"][0]["stats"], b["bands"][0]["stats"]
    for field in ("min", "max", "sum", "sum_squares", "count", "mean"):
        assert mine[field] == other[field]
    assert abs(mine["stddev"] - other["stddev"]) < 1e-9


def start(spark, arriving, table, progress, **options):
    source = spark.readStream.schema(pixels(spark, 0, 1).schema).parquet(arriving)
    append_stream(
        source, RASTER, table, progress, exact_stats=True, basic_stats=True, **options
    ).awaitTermination()


def test_a_batch_run_again_replaces_itself(spark, tmp_path):
    """A named stream that lost its progress starts over: same loads, same rows."""
    arriving = str(tmp_path / "arriving")
    pixels(spark, 0, 1).coalesce(1).write.parquet(arriving)
    table = BlockTable(spark, str(tmp_path / "stream"))
    for attempt in ("one", "two"):
        start(spark, arriving, table, str(tmp_path / attempt), name="mine")
    assert table.data().count() == 4
    assert json.loads(table.read().where("block = 0").first().metadata)["num_blocks"] == 4


def test_streams_do_not_replace_each_other(spark, tmp_path):
    table = BlockTable(spark, str(tmp_path / "stream"))
    for part in range(2):
        arriving = str(tmp_path / f"arriving{part}")
        pixels(spark, part, part + 1).coalesce(1).write.parquet(arriving)
        start(spark, arriving, table, str(tmp_path / f"progress{part}"))
    assert table.data().count() == 8 and table.metadata()["num_blocks"] == 8


def test_tiles_split_over_batches_are_merged(spark, tmp_path):
    """Pixels dealt at random over files, with pyramid levels: the same tiles as in one load."""
    raster = Raster((Band("v", "int16", nodata=-1),), 10, 4, 4, 16, 16, overviews=(2, 4))
    arriving = str(tmp_path / "arriving")
    rows = pixels(spark, 0, 3)
    rows.repartition(3, F.xxhash64("px", "py")).write.parquet(arriving)
    source = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(arriving)
    table = BlockTable(spark, str(tmp_path / "stream"))
    append_stream(
        source, raster, table, str(tmp_path / "progress"), basic_stats=True, compress=True
    ).awaitTermination()
    whole = BlockTable(spark, str(tmp_path / "whole"))
    load_raster(rows, raster, whole, basic_stats=True, compress=True)
    assert table.duplicates().isEmpty()
    ours, theirs = (tiling.decode(t.data(), raster, True) for t in (table, whole))
    assert ours.exceptAll(theirs).isEmpty() and theirs.exceptAll(ours).isEmpty()
    mine, other = (t.metadata()["bands"][0]["stats"] for t in (table, whole))
    for field in ("min", "max", "sum", "count"):
        assert mine[field] == other[field]


def test_later_cells_win(spark):
    raster = Raster((Band("f", "float32"), Band("a", "uint8", "alpha")), 10, 0, 0, 2, 1)
    pack = lambda kind, *v: np.array(v, kind).tobytes()
    rows = [
        (7, 1, pack("<f4", 1, np.nan), pack("u1", 255, 0)),
        (7, 2, pack("<f4", np.nan, 5), pack("u1", 0, 255)),
        (7, 3, pack("<f4", np.nan, 6), None),
        (9, 1, None, pack("u1", 1, 2)),
    ]
    frame = spark.createDataFrame(rows, "block long, at int, f binary, a binary")
    found = {r.block: r for r in tiling.merge_copies(frame, raster, "at").collect()}
    assert np.frombuffer(found[7].f, "<f4").tolist() == [1, 6]
    assert list(found[7].a) == [255, 255]
    assert found[9].f is None and list(found[9].a) == [1, 2]
