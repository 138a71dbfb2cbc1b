import json
import math

import duckdb
import pytest
from pyspark.sql import functions as F

from gridmill import Band, Raster
from gridmill.operators import arcs, metadata, stats
from gridmill.plans import places, registry

DOCUMENT = {
    "compression": None, "block_resolution": 5, "minresolution": 5, "maxresolution": 5,
    "nodata": 0.0,
    "bands": [
        {
            "type": "uint8", "name": "band_1",
            "stats": {
                "min": 1.0, "max": 9.0, "mean": 4.0, "stddev": 2.0, "sum": 40.0,
                "sum_squares": 200.0, "count": 10, "quantiles": None, "top_values": None,
                "version": "0.9.0", "approximated_stats": False,
            },
            "colorinterp": "gray", "nodata": "0", "colortable": None, "valuelabels": None,
        }
    ],
    "bounds": [11.249999999997055, 40.979898069622585, 22.49999999999707, 48.92249926376037],
    "center": [16.874999999997062, 44.951198666691475, 5], "width": 256, "height": 256,
    "block_width": 256, "block_height": 256, "num_blocks": 1, "num_pixels": 65536,
    "pixel_resolution": 13,
}


def changed(**facts):
    doc = json.loads(json.dumps(DOCUMENT))
    stats_facts = facts.pop("stats", {})
    doc["bands"][0]["stats"] |= stats_facts
    band_facts = facts.pop("band", {})
    doc["bands"][0] |= band_facts
    return doc | facts


EAST = changed(
    bounds=[22.49999999999707, 40.979898069622585, 33.74999999999708, 48.92249926376037],
    stats={"min": 0.0, "max": 7.0, "mean": 3.0, "stddev": 1.0, "sum": 15.0, "sum_squares": 50.0,
           "count": 5, "version": "0.10.0", "approximated_stats": True},
)


def merged(spark, *docs):
    rows = [(i, json.dumps(d)) for i, d in enumerate(docs)]
    frame = spark.createDataFrame(rows, "at int, metadata string")
    return json.loads(metadata.merge(frame, "at").first().metadata)


def test_merge_of_two_neighbours(spark):
    """The extent rules on the known pair of neighbouring tiles at zoom 5."""
    doc = merged(spark, DOCUMENT, EAST)
    assert doc["bounds"] == [11.249999999997055, 40.979898069622585, 33.74999999999708, 48.92249926376037]
    assert doc["center"] == pytest.approx([22.499999999997065, 44.95119866669148, 5], abs=1e-12)
    assert (doc["width"], doc["height"]) == (512, 256)
    assert (doc["num_blocks"], doc["num_pixels"]) == (2, 131072)
    s = doc["bands"][0]["stats"]
    assert (s["min"], s["max"], s["sum"], s["sum_squares"], s["count"]) == (0, 9, 55, 250, 15)
    assert s["mean"] == 55 / 15
    assert s["stddev"] == pytest.approx(math.sqrt(250 / 15 - (55 / 15) ** 2))
    assert s["quantiles"] is None and s["top_values"] is None
    assert s["version"] == "0.9.0" and s["approximated_stats"] is True


def test_merge_without_sums(spark):
    empty = changed(stats={"mean": 8.0, "stddev": 1.5, "sum": 0.0, "sum_squares": 0.0, "count": 0})
    s = merged(spark, DOCUMENT, empty)["bands"][0]["stats"]
    assert s["mean"] == 4.0 and s["stddev"] == 2.0  # the one that counted pixels
    s = merged(spark, empty, empty)["bands"][0]["stats"]
    assert s["mean"] == 8.0 and s["stddev"] == pytest.approx(1.5 * math.sqrt(2))
    # The squares of a sampled band may be too small for its sum.
    odd = changed(stats={"sum_squares": 0.0})
    s = merged(spark, odd, odd)["bands"][0]["stats"]
    assert s["mean"] == 4.0 and s["stddev"] == pytest.approx(math.sqrt(8))
    s = merged(spark, DOCUMENT, empty, DOCUMENT)["bands"][0]["stats"]
    assert s["mean"] == 4.0


def test_merge_in_any_grouping(spark):
    empty = changed(stats={"mean": 8.0, "stddev": 1.5, "sum": 0.0, "sum_squares": 0.0, "count": 0})
    joint = merged(spark, DOCUMENT, empty, EAST)
    assert joint == merged(spark, merged(spark, DOCUMENT, empty), EAST)
    assert joint == merged(spark, DOCUMENT, merged(spark, empty, EAST))


def test_merged_extent_keeps_partial_tiles(spark):
    bounds = DOCUMENT["bounds"]
    south = bounds[3] - (bounds[3] - bounds[1]) * 0.4
    doc = merged(spark, changed(bounds=[bounds[0], south, bounds[2] - 3, bounds[3]], height=100))
    assert (doc["width"], doc["height"]) == (256, 256)


def test_merge_refuses_missing_bands(spark):
    other = changed(band={"name": "other"})
    with pytest.raises(Exception, match="band is missing"):
        merged(spark, DOCUMENT, other)


@pytest.mark.parametrize(
    "other, problem",
    [
        (changed(), None),
        (changed(stats={"min": 5.0}, band={"colorinterp": "red", "valuelabels": {"1": "x"}}), None),
        (changed(block_resolution=6), "block resolution"),
        (changed(nodata=None), "nodata"),
        (changed(block_height=512), "block width or height"),
        (changed(band={"type": "int8"}), "other bands"),
        (changed(band={"nodata": "1"}), "other bands"),
        (changed(bands=DOCUMENT["bands"] * 2), "other bands"),
        (changed(compression="gzip"), "compression"),
    ],
)
def test_compatibility(spark, other, problem):
    pair = spark.createDataFrame([(json.dumps(other), json.dumps(DOCUMENT))], "new string, old string")
    found = metadata.check(pair).first().problem
    assert found is None if problem is None else problem in found


def test_both_nodata_null_agree(spark):
    text = json.dumps(changed(nodata=None))
    pair = spark.createDataFrame([(text, text)], "new string, old string")
    assert metadata.check(pair).first().same_nodata


def test_document_fields(spark):
    pixels = spark.createDataFrame(
        [(x, y, float(x), x + 1) for x in range(40) for y in range(20)],
        "px long, py long, f float, p short",
    )
    r = Raster(
        (Band("f", "float32"), Band("p", "int8", "palette", math.nan, {3: (1, 2, 3, 255)}, {"3": "x"})),
        8, 10, 20, 16, 16, overviews=(2, 4),
    )
    text = metadata.document(pixels, r, exact=True, compress=True, version="9.9").first().metadata
    doc = json.loads(text)
    assert list(doc) == [
        "compression", "block_resolution", "minresolution", "maxresolution", "nodata", "bands",
        "bounds", "center", "width", "height", "block_width", "block_height", "num_blocks",
        "num_pixels", "pixel_resolution",
    ]
    assert doc["nodata"] is None and doc["compression"] == "gzip"
    assert (doc["block_resolution"], doc["minresolution"], doc["maxresolution"]) == (8, 6, 8)
    assert (doc["num_blocks"], doc["num_pixels"], doc["pixel_resolution"]) == (3, 800, 12)
    f, p = doc["bands"]
    assert (f["nodata"], f["colortable"], f["valuelabels"]) == ("nan", None, None)
    assert p["colortable"] == {"3": [1, 2, 3, 255]} and p["valuelabels"] == {"3": "x"}
    assert f["stats"]["top_values"] is None and len(f["stats"]["quantiles"]["19"]) == 18
    assert p["stats"]["top_values"]["1"] == 20 and p["stats"]["count"] == 800
    assert doc["bounds"][0] == -180 + 360 * 10 / 256


def test_merge_equals_the_whole(spark):
    """Statistics merged from parts are those of all pixels."""
    r = Raster((Band("v", "int16"),), 10, 0, 0, 16, 16)
    pixels = spark.range(6400).selectExpr(
        "id % 160 AS px", "id div 160 AS py", "CAST(pmod(id * 7919, 1000) - 300 AS short) AS v"
    )
    keyed = pixels.withColumn("part", F.floor(F.col("px") / 48))
    record = stats.moments(keyed, r, ["part"]).withColumns(
        {
            "quantiles": F.lit(None).cast("map<int, array<double>>"),
            "top_values": F.lit(None).cast("map<bigint, bigint>"),
            "version": F.lit("1"),
            "approximated_stats": F.lit(False),
        }
    )
    places = record.select(
        "part", (F.col("part") * 3).alias("tile_x0"), F.lit(0).alias("tile_y0"),
        F.least(F.lit(48), 160 - F.col("part") * 48).alias("width"), F.lit(40).alias("height"),
    )
    docs = metadata.documents(record, places, r, ["part"])
    doc = json.loads(metadata.merge(docs, "part").first().metadata)
    whole = stats.moments(pixels, r).first()
    s = doc["bands"][0]["stats"]
    for field in ("min", "max", "sum", "sum_squares", "count"):
        assert s[field] == whole[field]
    assert s["mean"] == pytest.approx(whole["mean"]) and s["stddev"] == pytest.approx(whole["stddev"])
    assert doc["num_pixels"] == 6400 and doc["width"] == 160


@pytest.mark.parametrize(
    "version, label", [("0.1.0+17$g1d1f3a3H", "0_1_0_17_g1d1f3a3h"), ("1.0.0", "1_0_0")]
)
def test_label(spark, version, label):
    assert spark.range(1).select(metadata.label_text(F.lit(version))).first()[0] == label


def test_value_labels(spark):
    texts = [('{"90": "Woody Wetlands", "52": "Shrub/Scrub"}',), ("None",)]
    frame = spark.createDataFrame(texts, "t string").select(metadata.value_labels(F.col("t")).alias("m"))
    assert [r.m for r in frame.collect()] == [{"90": "Woody Wetlands", "52": "Shrub/Scrub"}, None]
    bad = spark.createDataFrame([("{oops",)], "t string")
    with pytest.raises(Exception, match="(?i)malformed"):
        bad.select(metadata.value_labels(F.col("t"))).collect()


def test_arcs(spark):
    cases = {
        "plain": ([(10, 20), (15, 40)], (10, 40)),
        "across": ([(170, 180), (-180, -175)], (170, -175)),
        "one that wraps": ([(175, 185), (-170, -160)], (175, -160)),
        "east before west": ([(175, -178), (100, 110)], (100, -178)),
        "all": ([(-180, 180), (3, 4)], (-180, 180)),
        "inside one another": ([(-170, 100), (0, 1), (-20, 90)], (-170, 100)),
        "closed ring": ([(-180, -50), (-60, 70), (60, 180)], (-180, 180)),
        "equal gaps": ([(0, 10), (180, 190)], (-180, 10)),
        "repeated": ([(5, 6)] * 3, (5, 6)),
    }
    rows = [(k, float(w), float(e)) for k, (spans, _) in cases.items() for w, e in spans]
    frame = spark.createDataFrame([*rows, ("none", None, None)], "k string, west double, east double")
    found = {r["k"]: (r["west"], r["east"]) for r in arcs.enclosing_arc(frame, ["k"]).collect()}
    assert found == {k: tuple(map(float, arc)) for k, (_, arc) in cases.items()}


def test_arcs_around_the_earth(spark):
    """Many rasters leave no gap: the arc that goes round begins where it overlaps itself least."""
    cases = {
        "round": ([(-100, 0), (-10, 100), (85, 265)], (-100, -95)),
        "short": ([(170, 180), (-180, -175)], (170, -175)),
    }
    rows = [(k, float(w), float(e)) for k, (spans, _) in cases.items() for w, e in spans]
    frame = spark.createDataFrame(rows, "k string, west double, east double")
    arc = lambda **how: {
        r["k"]: (r["west"], r["east"]) for r in arcs.enclosing_arc(frame, ["k"], **how).collect()
    }
    assert arc(full_circle=False) == {k: tuple(map(float, a)) for k, (_, a) in cases.items()}
    assert arc()["round"] == (-180.0, 180.0)


def test_enclosing_arc_of_many_customers(spark, tmp_path):
    """So many that every group goes round the earth; the small tables leave gaps everywhere."""
    spark.range(40_000).withColumnRenamed("id", "c_custkey").write.parquet(f"{tmp_path}/customer.parquet")
    con = duckdb.connect()
    con.execute("CREATE TABLE customer AS SELECT range AS c_custkey FROM range(40000)")
    theirs = con.execute(registry.CHECKS["enclosing_arc"]).fetchall()
    found = places.enclosing_arc(spark, str(tmp_path)).collect()
    assert sorted((r["grp"], r["west"], r["east"]) for r in found) == sorted(theirs)


def test_merge_around_the_antimeridian(spark):
    left, right = [-180.0, 0.0, -168.75, 11.178401873711785], [168.75, 0.0, 180.0, 11.178401873711785]
    docs = [(i, json.dumps(changed(bounds=b))) for i, b in enumerate((left, right))]
    frame = spark.createDataFrame(docs, "at int, metadata string")
    doc = json.loads(metadata.merge(frame, "at", around=True).first().metadata)
    assert doc["bounds"][0] == 168.75 and doc["bounds"][2] == -168.75
    assert doc["center"][0] == 180 and doc["width"] == 512
    plain_ = json.loads(metadata.merge(frame, "at").first().metadata)
    assert plain_["bounds"][0] == -180 and plain_["width"] == 32 * 256
