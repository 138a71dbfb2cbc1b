import math
import tracemalloc
import warnings
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gridmill import Band, Raster
from gridmill.operators import radix, stats


def table(spark, **bands):
    """A pixel table of equally long lists, 100 pixels wide."""
    n = len(next(iter(bands.values()))[1])
    schema = "px long, py long, " + ", ".join(f"{k} {kind}" for k, (kind, _) in bands.items())
    rows = zip(range(n), *[v for _, v in bands.values()])
    return spark.createDataFrame([(i % 100, i // 100, *vs) for i, *vs in rows], schema)


def raster(*bands, **facts):
    return Raster(bands, 10, 0, 0, 16, 16, **facts)


def numpy_quantiles(values):
    return {
        (i, j): float(np.quantile(values, j / i, method="lower"))
        for i in range(3, 20)
        for j in range(1, i)
    }


def found(frame, name):
    return {(r.parts, r.part): r.value for r in frame.where(F.col("name") == name).collect()}


RNG = np.random.default_rng(5)
SHAPES = {
    "uniform": RNG.uniform(-1e6, 1e6, 6000),
    "heavy": np.where(RNG.random(6000) < 0.4, 3.25, RNG.lognormal(0, 6, 6000)),
    "extreme": RNG.choice([-1.7e308, 1.7e308, 5e-324, -5e-324, 0.0, 1.0], 6000),
    "constant": np.full(6000, 2.5),
    "infinite": np.where(RNG.random(6000) < 0.1, np.inf, RNG.normal(size=6000)),
}


@pytest.mark.parametrize("shape", list(SHAPES))
def test_float_quantiles_match_numpy(spark, shape):
    values = SHAPES[shape]
    pixels = table(spark, f=("double", values.tolist()))
    rows = stats.quantiles(pixels, raster(Band("f", "float64")))
    assert found(rows, "f") == numpy_quantiles(values)


@pytest.mark.parametrize("dtype, kind", [("int32", "int"), ("int64", "long")])
def test_whole_quantiles_match_numpy(spark, dtype, kind):
    edge = np.iinfo(dtype)
    values = RNG.integers(edge.min + 1, edge.max, 3000).astype(dtype)
    values[:1000] = edge.max
    pixels = table(spark, v=(kind, values.tolist()))
    r = raster(Band("v", dtype))
    rows = stats.quantiles(pixels, r)
    ordered = np.sort(values)
    expected = {
        (i, j): float(ordered[rank]) for i, j, rank in stats.quantile_ranks(len(values))
    }
    assert found(rows, "v") == expected


def test_narrowing_leaves_masked_pixels_out(spark):
    values = [math.nan if i % 3 == 0 else float(i) for i in range(5000)]
    pixels = table(spark, f=("double", values), b=("short", [i % 256 for i in range(5000)]))
    r = raster(Band("f", "float64"), Band("b", nodata=0))
    rows = stats.quantiles(pixels, r)
    assert found(rows, "f") == numpy_quantiles([v for v in values if not math.isnan(v)])
    assert found(rows, "b") == numpy_quantiles([i % 256 for i in range(5000) if i % 256])


def test_quantile_lists(spark):
    pixels = table(spark, b=("short", list(range(200)) * 2))
    row = stats.quantile_lists(stats.quantiles(pixels, raster(Band("b")))).first()
    assert sorted(row.quantiles) == list(range(3, 20))
    expected = numpy_quantiles(list(range(200)) * 2)
    assert all(
        row.quantiles[i] == [expected[i, j] for j in range(1, i)] for i in range(3, 20)
    )


def test_moments_of_wide_types(spark):
    """Sums that no double or 64-bit whole number would hold exactly at scale."""
    big = [2**32 - 1] * 3000 + [0] * 10
    signed = [-(2**31)] * 3000 + [1] * 10
    pixels = table(spark, u=("long", big), s=("int", signed), h=("int", [65535] * 3010))
    r = raster(Band("u", "uint32"), Band("s", "int32"), Band("h", "uint16"))
    rows = {row.name: row for row in stats.moments(pixels, r).collect()}
    assert rows["u"].sum == float(3000 * (2**32 - 1))
    assert rows["s"].sum == float(-3000 * 2**31 + 10)
    assert rows["h"].sum_squares == float(3010 * 65535**2)
    assert rows["h"].stddev == 0 and rows["h"]["count"] == 3010
    assert rows["s"].min == -(2**31) and rows["u"].max == 2**32 - 1


def test_nothing_valid(spark):
    pixels = table(spark, b=("short", [0] * 10))
    r = raster(Band("b"), nodata=0)
    row = stats.band_stats(pixels, r, exact=True).first()
    assert (row["count"], row.sum, row.min, row.quantiles) == (0, 0.0, None, None)
    with pytest.raises(ValueError, match="too sparse"):
        stats.band_stats(pixels, r)


def test_switches(spark):
    pixels = table(spark, b=("short", [i % 50 + 1 for i in range(3000)]), f=("double", [1.5] * 3000))
    r = raster(Band("b"), Band("f", "float64"))
    exact = {x.name: x for x in stats.band_stats(pixels, r, exact=True, version="1.2.3").collect()}
    assert exact["b"].approximated_stats is False and exact["b"].version == "1.2.3"
    assert exact["f"].top_values is None and len(exact["b"].top_values) == 50
    assert exact["b"].top_values[1] == 60
    near = {x.name: x for x in stats.band_stats(pixels, r, seed=1).collect()}
    assert near["b"].approximated_stats is True and near["b"]["count"] == 1000
    assert near["f"].top_values == {} and len(near["b"].top_values) == 10
    assert near["f"].sum == 1500.0 and near["f"].sum_squares == 2250.0
    again = {x.name: x for x in stats.band_stats(pixels, r, seed=1).collect()}
    assert again == near
    basic = stats.band_stats(pixels, r, basic=True).collect()
    assert all(x.quantiles is None and x.top_values is None for x in basic)


def test_top_values_keep_a_hundred(spark):
    pixels = table(spark, v=("int", [i % 300 for i in range(3000)] + [7] * 50))
    rows = stats.top_values(pixels, raster(Band("v", "int32"))).orderBy("rank").collect()
    assert len(rows) == 100
    assert (rows[0].value, rows[0]["count"]) == (7, 60)
    assert [r.value for r in rows[1:]] == [v for v in range(100) if v != 7]


def test_few_samples_warn(spark):
    pixels = table(spark, b=("short", [1] * 20))
    with warnings.catch_warnings(record=True) as caught:
        warnings.simplefilter("always")
        row = stats.band_stats(pixels, raster(Band("b"))).first()
    assert row["count"] == 20 and any("20 valid pixels" in str(w.message) for w in caught)


def test_sample_rules(spark):
    values = [math.inf if i % 5 == 0 else math.nan if i % 5 == 1 else i + 0.5 for i in range(2000)]
    pixels = table(spark, a=("short", [i % 4 for i in range(2000)]), f=("float", values))
    r = raster(Band("a", nodata=0), Band("f", "float32"))
    sample = stats.sample_pixels(pixels, r, n=100, seed=2)
    assert sample.count() == 100
    assert sample.where("a = 0 OR isnan(f)").isEmpty()
    sums = {x.name: x for x in stats.sample_sums(sample, r).collect()}
    assert sums["a"]["count"] == 100 and sums["f"]["count"] < 100


def test_first_look_gives_the_same_sample(spark):
    """A sparse raster, where the first look finds too few pixels, and a full one."""
    for every in (1, 50):
        pixels = spark.range(200 * 500).selectExpr(
            "id % 200 AS px", "id div 200 AS py",
            f"CAST(IF(id % {every} = 0, id % 99 + 1, 0) AS short) AS b",
        )
        r = raster(Band("b", nodata=0))
        direct = stats.sample_pixels(pixels, r, seed=9).collect()
        drawn = stats.drawn_sample(pixels, r.sized(200, 500), seed=9).collect()
        assert drawn == direct and len(drawn) == 1000
        small = stats.drawn_sample(pixels.where("py < 20"), r.sized(200, 20), seed=9, n=50)
        assert small.count() == 50
        if every == 1:  # the places are spread evenly
            across, _ = np.histogram([x.px for x in drawn], 4, (0, 200))
            down, _ = np.histogram([x.py for x in drawn], 5, (0, 500))
            assert all(200 < n < 300 for n in across) and all(150 < n < 250 for n in down)


def test_sums_cut_toward_zero(spark):
    pixels = table(spark, f=("double", [-0.75] * 5))
    r = raster(Band("f", "float64"))
    row = stats.sample_sums(stats.sample_pixels(pixels, r), r).first()
    assert (row.sum, row.sum_squares) == (-3.0, 2.0)


def test_group_limit_before_the_shuffle(spark):
    pixels = table(spark, v=("int", list(range(100))))
    plan = stats.top_values(pixels, raster(Band("v", "int32")))
    assert "WindowGroupLimit" in plan._jdf.queryExecution().executedPlan().toString()


def test_sparse_moments_are_those_of_all_pixels(spark):
    """Pixels that no pyramid level keeps are counted all the same."""
    rows = [(16 * x, 16 * y, x + y + 1) for x in range(32) for y in range(32)]
    pixels = spark.createDataFrame(rows, "px long, py long, v int")
    r = Raster((Band("v", "int32"),), 10, 0, 0, 16, 16, overviews=(2, 4, 8)).sized(512, 512)
    record = stats.band_stats(pixels, r, basic=True).first()
    assert (record["min"], record["max"]) == (1, 63)
    assert record["mean"] == pytest.approx(32)
    assert record["count"] == stats.SAMPLE_SIZE
    assert stats.band_stats(pixels, r, basic=True, sample_size=40).first()["count"] == 40


def test_passes_are_bounded(spark):
    """Values over all magnitudes take as many scans as any other doubles: four at most."""
    values = np.concatenate(
        [10.0 ** RNG.uniform(-300, 300, 3000), -(10.0 ** RNG.uniform(-300, 300, 3000)), [0.0, -0.0]]
    )
    small = np.clip(values, -3e38, 3e38).astype(np.float32)
    pixels = table(
        spark,
        f=("double", values.tolist()),
        s=("float", small.tolist()),
        b=("short", [i % 256 for i in range(len(values))]),
    )
    r = raster(Band("f", "float64"), Band("s", "float32"), Band("b"))
    records, scans = radix.band_records(pixels, r, stats.quantile_ranks)
    assert scans <= 4
    assert records[0].quantiles == numpy_quantiles(values)
    assert records[1].quantiles == numpy_quantiles(small)
    assert radix.band_records(pixels, r.select("s"), stats.quantile_ranks)[1] <= 2
    assert radix.band_records(pixels, r.select("b"), stats.quantile_ranks)[1] == 1


def test_keys_sort_as_values():
    for dtype, name in (("float32", "float32"), ("float64", "float64")):
        edge = np.finfo(dtype)
        odd = [-np.inf, edge.min, -1.5, -edge.tiny, 0.0, edge.tiny, 1.5, edge.max, np.inf]
        values = np.array(odd, dtype)
        keys = radix.keys_of(values)
        assert (np.diff(keys) > 0).all()
        assert (radix.values_of(keys, Band("x", name)) == values).all()


def test_one_scan_for_narrow_bands(spark, tmp_path):
    """Everything about bands of up to 16 bits comes from one scan of the pixels."""
    path = str(tmp_path / "pixels")
    table(
        spark,
        b=("short", [i % 256 for i in range(4000)]),
        w=("short", [i % 3000 - 1500 for i in range(4000)]),
    ).write.parquet(path)
    pixels = spark.read.parquet(path)
    r = raster(Band("b"), Band("w", "int16", nodata=0))
    plan = radix.first_pass(pixels, r, stats.quantile_ranks, 100)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1
    records, scans = radix.band_records(pixels, r, stats.quantile_ranks, 100)
    assert scans == 1
    w = np.array([v for v in (i % 3000 - 1500 for i in range(4000)) if v])
    assert records[1].quantiles == numpy_quantiles(w)
    m = records[1].moments
    assert (m["count"], m["sum"], m["sum_squares"]) == (len(w), w.sum(), (w * w).sum())
    assert m["stddev"] == pytest.approx(w.std()) and m["mean"] == pytest.approx(w.mean())
    values, counts = np.unique(w, return_counts=True)
    order = np.lexsort((values, -counts))[:100]
    assert records[1].tops == [(int(values[i]), int(counts[i])) for i in order]


@pytest.mark.parametrize("dtype, kind", [("int32", "int"), ("uint64", "decimal(20,0)")])
def test_exact_records_of_wide_bands(spark, dtype, kind):
    edge = np.iinfo(dtype)
    top = edge.max - 1  # the largest may be the nodata value
    values = [top - i % 7 for i in range(2000)] + [edge.min + 1 + i for i in range(50)]
    given = [Decimal(v) for v in values] if "decimal" in kind else values
    r = raster(Band("v", dtype), width=100, height=30)
    record = stats.band_stats(table(spark, v=(kind, given)), r, exact=True)
    row = record.withColumn("first", F.map_keys("top_values")[0]).first()
    assert row["sum"] == float(sum(values)) and row["count"] == 2050
    assert row["sum_squares"] == pytest.approx(float(sum(v * v for v in values)))
    assert row["stddev"] == pytest.approx(float(np.std(np.array(values, float))))
    assert row["first"] == top - 4 and row["top_values"][row["first"]] == 286
    assert row["quantiles"][3] == [float(sorted(values)[k]) for k in (683, 1366)]


def test_deviation_of_a_tight_cluster(spark):
    values = 1e6 + RNG.normal(size=5000) / 1000
    pixels = table(spark, f=("double", values.tolist())).repartition(5)
    records, _ = radix.band_records(pixels, raster(Band("f", "float64")), stats.quantile_ranks)
    assert records[0].moments["stddev"] == pytest.approx(values.std(), rel=1e-4)


def test_a_task_holds_few_prefixes():
    """What a task holds does not grow with the values it counts, however many prefixes these have."""
    band = Band("f", "float64")
    below = {0: np.unique(radix.keys_of(np.arange(1.0, 2.0, 1 / 64)) >> 48).tolist()}
    rng = np.random.default_rng(3)
    counted = 0

    def batches(n):
        for _ in range(n):
            yield pa.RecordBatch.from_arrays([pa.array(1 + rng.random(10_000))], ["b0"])

    peaks = []
    for n in (20, 80):
        tracemalloc.start()
        for out in radix._counting([(0, band)], 1, below)(batches(n)):
            counted += sum(out.column("n").to_pylist())
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert counted == 100 * 10_000
    assert max(peaks) < 20e6 and peaks[1] < 1.2 * peaks[0]
