import math

import pytest

from gridmill import Band, Raster
from gridmill.functions.geo import polygon_text
from gridmill.operators.metadata import nodata_label
from gridmill.operators.overviews import level_range, overview_count
from gridmill.operators.stats import band_sizes, quantile_pairs, quantile_ranks
from gridmill.spec import (
    DEFAULT_NODATA,
    check_block_shapes,
    check_names,
    check_overviews,
    item_size,
    pair_bands,
    pick_source,
)


def raster(*bands, **facts):
    return Raster(bands, 5, 17, 11, 256, 256, **facts)


def test_item_sizes():
    sizes = [item_size(d) for d in DEFAULT_NODATA]
    assert sizes == [1, 2, 4, 8, 1, 2, 4, 8, 2, 4, 8]
    with pytest.raises(ValueError, match="No raster type"):
        Band("b", "complex64")


def test_band_names():
    assert pair_bands([1, 3]) == [(1, "band_1"), (3, "band_3")]
    assert pair_bands([1, 2], ["a", None], str.upper) == [(1, "A"), (2, "BAND_2")]
    with pytest.raises(ValueError, match="cannot carry"):
        pair_bands([1, 2], ["a"])
    for name in ("block", "Metadata", "BLOCK"):
        with pytest.raises(ValueError, match="column names itself"):
            check_names(["ok", name])


def test_source():
    assert pick_source("a.tif") == "a.tif" and pick_source(file_url="u") == "u"
    for args in ((None, None), ("a", "b")):
        with pytest.raises(ValueError):
            pick_source(*args)


def test_nodata_rules():
    assert raster(Band("a"), Band("b")).table_nodata == 0
    assert raster(Band("a", "int16"), Band("b"), nodata=7).table_nodata == 7
    assert math.isnan(raster(Band("a", "float32"), Band("b", "float64")).table_nodata)
    with pytest.raises(ValueError, match="no nodata value in common"):
        raster(Band("a"), Band("b", "int16")).table_nodata  # noqa: B018
    with pytest.raises(ValueError, match="no nodata value in common"):
        raster(Band("a", "float32"), Band("b", nodata=3)).table_nodata  # noqa: B018


def test_nodata_labels():
    r = raster(Band("a", "uint64"), Band("f", "float32"), Band("x", colorinterp="alpha"))
    assert [nodata_label(r, b) for b in r.bands] == ["18446744073709551615", "nan", "0"]
    stated = raster(Band("a", "int16", nodata=-9999), Band("n", nodata=math.nan))
    assert [nodata_label(stated, b) for b in stated.bands] == ["-9999.0", "nan"]


def test_which_rule_masks():
    a, alpha = Band("a"), Band("x", colorinterp="alpha")
    assert raster(a).always_valid(a)
    assert not raster(a, nodata=0).always_valid(a)
    assert not raster(Band("f", "float32")).always_valid(Band("f", "float32"))
    assert raster(a, alpha, nodata=0).always_valid(alpha)
    assert not raster(a, alpha).always_valid(a)
    red, green, blue = (Band(c, colorinterp=c) for c in ("red", "green", "blue"))
    assert raster(red, green, blue).compound(red) == [red, green, blue]
    assert raster(red, green).compound(red) == [red]
    assert raster(a, red, green, blue).compound(a) == [a]


def test_grid_checks():
    check_overviews((2, 4, 8))
    for factors in ((2, 4, 16), (4,), (2, 3)):
        with pytest.raises(ValueError, match="step by step"):
            check_overviews(factors)
    check_block_shapes([(256, 256), (256, 256)])
    with pytest.raises(ValueError, match="one shape"):
        check_block_shapes([(256, 256), (512, 256)])
    assert raster(Band("a")).pixel_resolution == 13
    with pytest.raises(ValueError, match="26"):
        Raster((Band("a"),), 20, 0, 0, 256, 256)


def test_overview_count():
    r = raster(Band("a"), overviews=(2, 4)).sized(512, 300)
    # Tiles 17..18 by 11..12: parents 8..9 by 5..6, grandparents 4..4 by 2..3.
    assert level_range(r, 1) == (8, 9, 5, 6)
    assert overview_count(r) == 4 + 2


def test_quantile_ranks():
    assert len(quantile_pairs()) == 170
    assert quantile_ranks(1000)[:2] == [(3, 1, 333), (3, 2, 666)]


def test_band_sizes():
    r = raster(Band("a"), Band("f", "float64", nodata=0)).sized(1024, 1024)
    assert band_sizes(r) == [("a", "uint8", 1.0), ("f", "float64", 8.0)]


def test_unknown_text_format():
    with pytest.raises(ValueError, match="No such text form"):
        polygon_text(None, "kml")
