import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThanOrEqual, In, LessThan
from tiff_writer import write_tiff

from gridmill import IncompatibleRaster
from gridmill.operators import tiling
from gridmill.plans.load import load_tiff
from gridmill.sources import tiff, tiff_source
from gridmill.sources.tables import BlockTable

RNG = np.random.default_rng(3)


def image(dtype="uint8", height=100, width=150):
    if dtype.startswith("float"):
        return RNG.normal(0, 100, (height, width)).astype(dtype)
    return RNG.integers(1, np.iinfo(dtype).max, (height, width), dtype=dtype)


def planned(path, filters=(), **options):
    source = tiff_source.TiffSource({"path": path, **options})
    reader = source.reader(source.schema())
    left = list(reader.pushFilters(list(filters)))
    return reader, reader.partitions(), left


def pasted(batches, z, left, top, height, width, name="band_1", edge=16):
    out = np.zeros((height + 2 * edge, width + 2 * edge), float)
    seen = set()
    for b in batches:
        for r in b.to_pylist():
            if r["z"] == z:
                seen.add((r["tile_x"], r["tile_y"]))
                y, x = r["tile_y"] * edge - top + edge, r["tile_x"] * edge - left + edge
                out[y : y + edge, x : x + edge] = np.reshape(r[name], (edge, edge))
    return out[edge : edge + height, edge : edge + width], seen


@pytest.mark.parametrize("planar", [1, 2])
@pytest.mark.parametrize(
    "dtype, predictor", [("uint8", 2), ("int16", 2), ("float32", 3), ("float64", 3), ("uint8", 1)]
)
def test_all_images(tmp_path, dtype, predictor, planar):
    """The base and reduced images that differ from it, at an origin that is odd at coarser levels."""
    path = str(tmp_path / "a.tif")
    bands = [image(dtype), image(dtype)]
    half = [image(dtype, 50, 75), image(dtype, 50, 75)]
    write_tiff(
        path, bands, 8, 133, 91, 16, planar=planar, overviews=[(2, half), 4], nodata=0,
        predictor=predictor,
    )
    reader, parts, _ = planned(path, overviews="true", task_bytes="4000")
    assert len(parts) > 3
    batches = [b for p in parts for b in reader.read(p)]
    x, y = 133 * 16, 91 * 16
    for name, base, reduced in zip(("band_1", "band_2"), bands, half, strict=True):
        assert (pasted(batches, 8, x, y, 100, 150, name)[0] == base).all()
        assert (pasted(batches, 7, x // 2, y // 2, 50, 75, name)[0] == reduced).all()
        assert (pasted(batches, 6, x // 4, y // 4, 25, 38, name)[0] == base[::4, ::4]).all()


def test_filters_choose_the_byte_ranges(tmp_path, monkeypatch):
    path = str(tmp_path / "a.tif")
    write_tiff(path, [image(), image(), image()], 8, 133, 90, 16, planar=2, overviews=[2])
    filters = [
        EqualTo(("z",), 8), GreaterThanOrEqual(("tile_x",), 135), LessThan(("tile_x",), 138),
        In(("tile_y",), (91, 92, 400)), EqualTo(("band_1",), 5),
    ]
    reader, parts, left = planned(path, filters, overviews="true", bands="2,3")
    assert left == filters[-1:]
    levels = tiff_source.images(path, 0, True)[1]
    tiles = {int(s) for image_ in levels for s in image_.starts.ravel()}
    read = []
    plain = tiff.RangeReader.__call__
    monkeypatch.setattr(
        tiff.RangeReader, "__call__", lambda self, at, n: read.append(at) or plain(self, at, n)
    )
    batches = [b for p in parts for b in reader.read(p)]
    rows = [r for b in batches for r in b.to_pylist()]
    assert {(r["tile_x"], r["tile_y"]) for r in rows} == {
        (x, y) for x in (135, 136, 137) for y in (91, 92)
    }
    # Six tiles of two bands, and nothing else of the pixels.
    assert len([at for at in read if at in tiles]) == 12


def test_through_spark(spark, tmp_path):
    for i in range(3):
        write_tiff(str(tmp_path / f"{i}.tif"), [image()], 8, 130, 90 + 7 * i, 16, nodata=0)
    tiff_source.register(spark)
    rows = spark.read.format("webmap_tiff").load(str(tmp_path / "*.tif"))
    assert rows.columns == ["z", "tile_x", "tile_y", "band_1"]
    assert rows.count() == 3 * 70
    some = rows.where("tile_y >= 98 AND tile_x = 131 AND size(band_1) = 256")
    assert some.select(F.min("tile_y"), F.max("tile_y"), F.count("*")).first()[:] == (98, 110, 13)
    with pytest.raises(Exception, match="no file"):
        spark.read.format("webmap_tiff").load(str(tmp_path / "none*.tif")).count()


def test_refusals(tmp_path):
    path = str(tmp_path / "a.tif")
    write_tiff(path, [image()], 8, 133, 90, 16, overviews=[(2, [image("uint8", 50, 74)])])
    with pytest.raises(IncompatibleRaster, match="level"):
        planned(path, overviews="true")
    assert planned(path)[1]


def test_predictors_of_whole_loads(spark, tmp_path):
    path, band = str(tmp_path / "a.tif"), image("int16")
    write_tiff(path, [band], 8, 133, 90, 16, nodata=0, predictor=2)
    raster = tiff.raster_of(tiff.common_profile(spark, path))
    rows = tiff.tiles(spark, path, raster).collect()
    found = np.zeros((7 * 16, 10 * 16), np.int16)
    for r in rows:
        x, y = (r["tile_x"] - 133) * 16, (r["tile_y"] - 90) * 16
        found[y : y + 16, x : x + 16] = np.reshape(r["band_1"], (16, 16))
    assert (found[:100, :150] == band).all()


def test_own_overviews_are_loaded(spark, tmp_path):
    """Two files side by side share tiles of the coarser levels; their images are not thinned."""
    (tmp_path / "in").mkdir()
    whole = image("uint8", 96, 160)
    half, quarter = image("uint8", 48, 80), image("uint8", 24, 40)
    for i, (a, b) in enumerate([(0, 80), (80, 160)]):
        write_tiff(
            str(tmp_path / "in" / f"{i}.tif"), [whole[:, a:b]], 8, 133 + a // 16, 91, 16, nodata=0,
            overviews=[(2, [half[:, a // 2 : b // 2]]), (4, [quarter[:, a // 4 : b // 4]])],
        )
    table = BlockTable(spark, str(tmp_path / "blocks"))
    load_tiff(str(tmp_path / "in" / "*.tif"), table, basic_stats=True, own_overviews=True)
    raster = tiff.raster_of(tiff.common_profile(spark, str(tmp_path / "in" / "*.tif")))
    rows = tiling.decode(table.data(), raster).where("band_1 <> 0").collect()
    for z, cells in ((8, whole), (7, half), (6, quarter)):
        found = np.zeros_like(cells)
        left, top = (133 * 16) >> (8 - z), (91 * 16) >> (8 - z)
        for r in rows:
            if r["z"] == z:
                found[r["gy"] - top, r["gx"] - left] = r["band_1"]
        assert (found == cells).all()
    assert table.duplicates().isEmpty()
