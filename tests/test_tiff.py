import math

import numpy as np
import pytest
from tiff_writer import write_tiff

from gridmill import IncompatibleRaster
from gridmill.operators import tiling
from gridmill.plans.load import load_raster, load_tiff
from gridmill.sources import tiff
from gridmill.sources.pixels import pixels_of_tiles
from gridmill.sources.tables import BlockTable

RNG = np.random.default_rng(11)


def image(dtype, height=40, width=56):
    if dtype.startswith("float"):
        return RNG.normal(0, 100, (height, width)).astype(dtype)
    edge = np.iinfo(dtype)
    return RNG.integers(edge.min, edge.max, (height, width), dtype=dtype, endpoint=True)


def read_pixels(spark, path, **facts):
    profile = tiff.profiles(spark, path).first()
    raster = tiff.raster_of(profile)
    rows = pixels_of_tiles(tiff.tiles(spark, path, raster), raster).toPandas()
    found = {}
    for name in raster.names:
        cells = np.zeros((raster.height, raster.width), np.dtype(profile.dtype))
        cells[rows.py, rows.px] = rows[name].to_numpy().astype(profile.dtype)
        found[name] = cells
    return raster, found, len(rows)


@pytest.mark.parametrize("dtype", ["uint8", "int16", "uint32", "uint64", "float32", "float64"])
@pytest.mark.parametrize("deflate", [True, False])
def test_pixels_are_read(spark, tmp_path, dtype, deflate):
    path, band = str(tmp_path / "a.tif"), image(dtype)
    write_tiff(path, [band], 8, 133, 90, 16, deflate=deflate, nodata=5)
    raster, found, rows = read_pixels(spark, path)
    assert (raster.width, raster.height, raster.zoom) == (56, 40, 8)
    assert (raster.tile_x0, raster.tile_y0, raster.block_width) == (133, 90, 16)
    assert rows == 40 * 56 and raster.nodata == 5
    assert (found["band_1"] == band).all()


@pytest.mark.parametrize("planar", [1, 2])
@pytest.mark.parametrize("big", [False, True])
def test_many_bands(spark, tmp_path, planar, big):
    path = str(tmp_path / "a.tif")
    bands = [image("uint8") for _ in range(4)]
    write_tiff(path, bands, 8, 3, 5, 16, photometric=2, extra=(2,), planar=planar, big=big)
    raster, found, _ = read_pixels(spark, path)
    assert [b.colorinterp for b in raster.bands] == ["red", "green", "blue", "alpha"]
    assert all((found[f"band_{i + 1}"] == b).all() for i, b in enumerate(bands))


def test_palette_and_overviews(spark, tmp_path):
    path = str(tmp_path / "a.tif")
    colours = [i * 257 for i in range(256)] + [0] * 256 + [65535] * 256
    write_tiff(path, [image("uint8")], 8, 3, 5, 16, photometric=3, colormap=colours, overviews=(2, 4))
    raster = tiff.raster_of(tiff.profiles(spark, path).first())
    assert raster.overviews == (2, 4) and raster.bands[0].colorinterp == "palette"
    assert list(raster.bands[0].colortable[7]) == [7, 0, 255, 255]


@pytest.mark.parametrize("facts", [{"scheme": ""}, {"scheme": "Other"}, {"shift": 0.3}])
def test_unaligned_files_are_refused(spark, tmp_path, facts):
    path = str(tmp_path / "a.tif")
    write_tiff(path, [image("uint8")], 8, 3, 5, 16, **facts)
    with pytest.raises(IncompatibleRaster):
        tiff.describe_file(path, 0)
    with pytest.raises(Exception, match="IncompatibleRaster"):
        tiff.profiles(spark, path).collect()


def test_other_files_are_refused(tmp_path):
    path = tmp_path / "a.tif"
    path.write_bytes(b"MM\0*" + b"\0" * 60)
    with pytest.raises(ValueError, match="little-endian"):
        tiff.describe_file(str(path), 0)


@pytest.mark.parametrize("facts", [{"nodata": 7}, {"photometric": 2, "extra": (2,), "nodata": 0}])
def test_loading_a_file_equals_loading_its_pixels(spark, tmp_path, facts):
    path = str(tmp_path / "a.tif")
    n = 4 if "extra" in facts else 1
    bands = [image("uint8") // 32 for _ in range(n)]
    write_tiff(path, bands, 8, 133, 91, 16, overviews=(2, 4), **facts)
    a, b = (BlockTable(spark, str(tmp_path / name)) for name in "ab")
    report = load_tiff(path, a, exact_stats=True, compress=True)
    raster = tiff.raster_of(tiff.profiles(spark, path).first())
    pixels = pixels_of_tiles(tiff.tiles(spark, path, raster), raster)
    assert report == load_raster(pixels, raster, b, exact_stats=True, compress=True)
    ours, theirs = (tiling.decode(t.data(), raster, True) for t in (a, b))
    assert ours.exceptAll(theirs).isEmpty() and theirs.exceptAll(ours).isEmpty()
    assert a.metadata() == b.metadata()
    assert math.isclose(a.metadata()["bands"][0]["stats"]["sum"], b.metadata()["bands"][0]["stats"]["sum"])


def test_files_of_a_folder_and_missing_tiles(spark, tmp_path):
    """Two files side by side, read as one table of tiles."""
    left, right = image("uint8", 32, 32), image("uint8", 32, 16)
    write_tiff(str(tmp_path / "l.tif"), [left], 8, 3, 5, 16)
    write_tiff(str(tmp_path / "r.tif"), [right], 8, 5, 5, 16)
    tiles = tiff.tiles(spark, str(tmp_path))
    assert {(r.tile_x, r.tile_y) for r in tiles.collect()} == {
        (x, y) for x in (3, 4, 5) for y in (5, 6)
    }


def test_a_folder_is_one_raster(spark, tmp_path):
    """Extent, counts and statistics span the files, whichever is read first."""
    for name, value, x in (("a", 1, 3), ("b", 9, 5)):
        write_tiff(str(tmp_path / f"{name}.tif"), [np.full((32, 32), value, "uint8")], 8, x, 5, 16)
    table = BlockTable(spark, str(tmp_path / "table"))
    report = load_tiff(str(tmp_path / "*.tif"), table)
    assert report == {"expected": 8, "written": 8, "empty": 0}
    doc = table.metadata()
    record = doc["bands"][0]["stats"]
    assert (doc["width"], doc["height"]) == (64, 32)
    assert (record["min"], record["max"], record["count"]) == (1, 9, 2048)


def test_files_that_differ_are_refused(spark, tmp_path):
    write_tiff(str(tmp_path / "a.tif"), [image("uint8", 32, 32)], 8, 3, 5, 16)
    write_tiff(str(tmp_path / "b.tif"), [image("int16", 32, 32)], 8, 5, 5, 16)
    with pytest.raises(IncompatibleRaster, match="differ"):
        tiff.common_profile(spark, str(tmp_path))
    with pytest.raises(Exception, match="does not exist"):
        tiff.common_profile(spark, str(tmp_path / "*.none.tif*"))


def test_a_file_that_ends_inside_the_raster_is_refused(spark, tmp_path):
    write_tiff(str(tmp_path / "a.tif"), [image("uint8", 32, 24)], 8, 3, 5, 16)
    write_tiff(str(tmp_path / "b.tif"), [image("uint8", 32, 32)], 8, 5, 5, 16)
    with pytest.raises(IncompatibleRaster, match="inside a tile"):
        tiff.common_profile(spark, str(tmp_path))


@pytest.mark.parametrize("planar", [1, 2])
def test_some_bands(spark, tmp_path, planar):
    path = str(tmp_path / "a.tif")
    bands = [image("uint8") for _ in range(3)]
    write_tiff(path, bands, 8, 3, 5, 16, photometric=2, planar=planar)
    profile = tiff.common_profile(spark, path)
    raster = tiff.raster_of(profile, ["blue", None], [3, 1], str.upper, {3: {7: "x"}})
    assert raster.names == ["BLUE", "BAND_1"]
    assert raster.bands[0].valuelabels == {"7": "x"} and raster.bands[1].colorinterp == "red"
    rows = pixels_of_tiles(tiff.tiles(spark, path, raster, [3, 1]), raster).toPandas()
    for name, band in zip(raster.names, (bands[2], bands[0])):
        assert (band[rows.py, rows.px] == rows[name]).all()
    table = BlockTable(spark, str(tmp_path / "table"))
    load_tiff(path, table, ["one", "two"], band_numbers=[1, 2], basic_stats=True)
    assert [b["name"] for b in table.metadata()["bands"]] == ["one", "two"]
    for names, numbers in ((["one"], None), (["one"], [1, 2]), (None, [4])):
        with pytest.raises(ValueError):
            tiff.raster_of(profile, names, numbers)


def test_padding_is_transparent(spark, tmp_path):
    path = str(tmp_path / "a.tif")
    bands = [np.full((40, 56), 100 + i, "uint16") for i in range(2)]
    write_tiff(path, bands, 8, 3, 5, 16, extra=(2,))
    raster = tiff.raster_of(tiff.common_profile(spark, path))
    corner = tiff.tiles(spark, path, raster).orderBy("tile_y", "tile_x").collect()[-1]
    assert set(corner["band_1"]) == {100, 65535} and set(corner["band_2"]) == {101, 0}


def test_names_of_file_systems(tmp_path):
    assert tiff.SCHEMES["s3a"] == "s3"
    with pytest.raises(FileNotFoundError):
        tiff.RangeReader(f"file://{tmp_path}/none.tif")
