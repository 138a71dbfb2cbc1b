import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridmill import Band, Raster
from gridmill.operators import stats, summaries
from gridmill.plans.load import load_raster, merged_statistics, recompute_statistics
from gridmill.sources.tables import BlockTable

RNG = np.random.default_rng(11)
RASTER = Raster((Band("b"), Band("f", "float64")), 10, 4, 4, 16, 16, nodata=0)


@pytest.fixture(scope="module")
def pixels(spark):
    n = 64 * 48
    rows = [
        (i % 64, i // 64, int(b), float(f))
        for i, b, f in zip(range(n), RNG.integers(0, 200, n), RNG.lognormal(0, 9, n))
    ]
    return spark.createDataFrame(rows, "px long, py long, b short, f double").cache()


def test_merged_in_any_grouping(spark, pixels):
    by = pixels.withColumn("k", (F.col("px") + F.col("py")) % 13)
    single = summaries.summarise(pixels, RASTER)
    parts = summaries.summarise(by, RASTER, ["k"])
    twice = summaries.merge(parts.withColumn("k", F.col("k") % 3), ["k"]).drop("k")
    exact = lambda s: sorted(
        tuple(r) for r in s.where("sketch IS NULL").select("name", "value", "n").collect()
    )
    assert exact(summaries.merge(twice)) == exact(summaries.merge(single)) == exact(single)
    counts = summaries.merge(twice).where("sketch IS NOT NULL").select("name", "n").collect()
    assert [tuple(r) for r in counts] == [("f", pixels.where("f <> 0").count())]


def test_error_of_sketches(spark):
    """Ranks of quantiles from many merged sketches stay within the stated bound."""
    values = np.concatenate([RNG.normal(size=100_000), RNG.lognormal(0, 20, 100_000)])
    frame = spark.createDataFrame(
        [(int(i % 40), float(v)) for i, v in enumerate(values)], "k int, f double"
    )
    raster = Raster((Band("f", "float64"),), 10, 0, 0, 16, 16)
    merged = summaries.merge(summaries.summarise(frame, raster, ["k"]).drop("k"))
    found = summaries.quantiles(merged).collect()
    assert len(found) == 170
    ordered = np.sort(values)
    for r in found:
        low = np.searchsorted(ordered, r["value"], "left") / len(values)
        high = np.searchsorted(ordered, r["value"], "right") / len(values)
        wanted = r["part"] / r["parts"]
        assert low - summaries.RANK_ERROR <= wanted <= high + summaries.RANK_ERROR
    sketch = merged.select(F.length("sketch").alias("n")).first()["n"]
    assert sketch < 200_000


def test_statistics_of_a_table_of_two_loads(spark, pixels, tmp_path):
    table = BlockTable(spark, str(tmp_path / "blocks"))
    top, low = pixels.where("py < 32"), pixels.where("py >= 32").withColumn("py", F.col("py") - 32)
    load_raster(top, RASTER, table, summary=True)
    below = Raster(RASTER.bands, 10, 4, 6, 16, 16, nodata=0)
    load_raster(low, below, table, mode="append", load="low", summary=True)
    assert table.metadata()["bands"][0]["stats"]["quantiles"] is None
    whole = stats.band_stats(pixels, RASTER.sized(64, 48), exact=True).collect()
    merged_statistics(table)
    b, f = (band["stats"] for band in table.metadata()["bands"])
    assert b["quantiles"] == {str(k): v for k, v in whole[0]["quantiles"].items()}
    assert {int(k): v for k, v in b["top_values"].items()} == whole[0]["top_values"]
    assert set(f["quantiles"]) == set(map(str, stats.QUANTILE_GROUPS)) and f["top_values"] is None
    recompute_statistics(table, RASTER)
    b, f = (band["stats"] for band in table.metadata()["bands"])
    assert f["quantiles"] == {str(k): v for k, v in whole[1]["quantiles"].items()}
    for field in ("min", "max", "mean", "stddev", "sum", "sum_squares", "count"):
        assert math.isclose(f[field], whole[1][field], rel_tol=1e-12)
        assert math.isclose(b[field], whole[0][field], rel_tol=1e-12)
    # A load that replaces itself replaces its summary, and one without a summary ends it.
    load_raster(low, below, table, mode="append", load="low", summary=True)
    total = table.summary().where("name = 'b'").agg(F.sum("n")).first()[0]
    assert total == pixels.where("b <> 0").count()
    load_raster(low, below, table, mode="append", load="low", basic_stats=True)
    with pytest.raises(ValueError, match="without a summary"):
        merged_statistics(table)
    table.vacuum()
    assert len(list((tmp_path / "blocks" / "summaries").iterdir())) == 1


def test_shared_blocks_are_refused(spark, pixels, tmp_path):
    table = BlockTable(spark, str(tmp_path / "blocks"))
    load_raster(pixels, RASTER, table, basic_stats=True, summary=True)
    load_raster(pixels, RASTER, table, mode="append", basic_stats=True, summary=True)
    with pytest.raises(ValueError, match="share blocks"):
        recompute_statistics(table, RASTER)
    table.compact(RASTER)
    recompute_statistics(table, RASTER)
    stats_ = json.loads(json.dumps(table.metadata()))["bands"][0]["stats"]
    assert stats_["count"] == pixels.where("b <> 0").count()
    # The summary stays that of what was loaded.
    assert table.summary().where("name = 'b'").agg(F.sum("n")).first()[0] == 2 * stats_["count"]
