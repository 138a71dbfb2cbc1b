"""Summaries of band values that loads keep, so that quantiles and common values can be merged.

Bands of 8 and 16 bits keep their exact histogram, at most 65,536 rows; wider ones a KLL sketch, some
tens of kB whatever the number of pixels. Both merge in any grouping and order: counts add up, and
sketches are compacted again. A quantile of merged histograms is exact. One of a sketch has a rank
within ``RANK_ERROR`` of the wanted one, as a share of all values, with 99 % confidence.

A summary is a frame ``name, value, n, sketch``: rows with a value are entries of a histogram, rows
with a sketch stand for a whole band.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridmill.functions.nodata import counted
from gridmill.operators.radix import DIGIT, key_bits
from gridmill.operators.stats import (
    TOP_VALUES_EXACT,
    histogram,
    quantile_pairs,
)
from gridmill.spec import Raster

SKETCH_SIZE = 2048
RANK_ERROR = 0.0025  # of a sketch of that size

SUMMARY = "name string, value long, n long, sketch binary"


def summarise(pixels: DataFrame, raster: Raster, keys: list[str] | None = None) -> DataFrame:
    """The summary of a raster's counted pixels, per key where keys are given."""
    keys = keys or []
    narrow = [b for b in raster.bands if key_bits(b) == DIGIT]
    wide = [b for b in raster.bands if key_bits(b) > DIGIT]
    parts = []
    if narrow:
        hist = histogram(pixels, raster, narrow, "long", keys)
        parts.append(
            hist.select(*keys, "name", F.col("v").alias("value"), "n",
                        F.lit(None).cast("binary").alias("sketch"))
        )
    if wide:
        size = F.lit(SKETCH_SIZE)
        cells = []
        for b in wide:
            value = F.when(counted(raster, b.name), F.col(b.name)).cast("double")
            cells.append(
                F.struct(
                    F.lit(b.name).alias("name"),
                    F.count(value).alias("n"),
                    F.kll_sketch_agg_double(value, size).alias("sketch"),
                )
            )
        grouped = pixels.groupBy(*keys).agg(F.array(*cells).alias("bands"))
        rows = grouped.select(*keys, F.explode("bands").alias("b")).where("b.n > 0")
        parts.append(
            rows.select(*keys, "b.name", F.lit(None).cast("long").alias("value"), "b.n", "b.sketch")
        )
    return reduce(DataFrame.unionByName, parts)


def merge(summaries: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """One summary from many, per key where keys are given."""
    keys = keys or []
    entries = summaries.where("sketch IS NULL").groupBy(*keys, "name", "value").agg(
        F.sum("n").alias("n"), F.lit(None).cast("binary").alias("sketch")
    )
    sketches = summaries.where("sketch IS NOT NULL").groupBy(*keys, "name").agg(
        F.lit(None).cast("long").alias("value"),
        F.sum("n").alias("n"),
        F.kll_merge_agg_double("sketch", F.lit(SKETCH_SIZE)).alias("sketch"),
    )
    columns = [*keys, "name", "value", "n", "sketch"]
    return entries.select(columns).unionByName(sketches.select(columns))


def quantiles(summary: DataFrame) -> DataFrame:
    """Rows ``name, parts, part, value``: at rank floor((n-1)*part/parts), of sketches about there.

    A histogram row takes the targets whose rank it covers; the targets are a fixed list of 170.
    """
    pairs = F.array(
        *[F.struct(F.lit(i).alias("parts"), F.lit(j).alias("part")) for i, j in quantile_pairs()]
    )
    band = Window.partitionBy("name")
    upto = F.sum("n").over(band.orderBy("value"))
    entries = summary.where("sketch IS NULL").withColumns(
        {"after": upto, "total": F.sum("n").over(band)}
    )
    rank = lambda p: F.floor((F.col("total") - 1) * (p["part"] / p["parts"]))
    covered = F.filter(
        pairs, lambda p: (rank(p) < F.col("after")) & (rank(p) >= F.col("after") - F.col("n"))
    )
    exact = entries.select("name", F.col("value").cast("double"), F.explode(covered).alias("p"))
    ranks = F.array(*[F.lit(j / i) for i, j in quantile_pairs()])
    spots = F.arrays_zip(
        pairs.alias("p"), F.kll_sketch_get_quantile_double("sketch", ranks).alias("value")
    )
    about = summary.where("sketch IS NOT NULL").select("name", F.explode(spots).alias("s"))
    about = about.select("name", F.col("s.p").alias("p"), F.col("s.value").alias("value"))
    return exact.select("name", "p.parts", "p.part", "value").unionByName(
        about.select("name", "p.parts", "p.part", "value")
    )


def top_values(summary: DataFrame, n: int = TOP_VALUES_EXACT) -> DataFrame:
    """The n most common values of the bands with a histogram: ``name, rank, value, count``."""
    order = Window.partitionBy("name").orderBy(F.desc("n"), "value")
    entries = summary.where("sketch IS NULL").withColumn("rank", F.row_number().over(order))
    return entries.where(F.col("rank") <= n).select(
        "name", "rank", "value", F.col("n").alias("count")
    )
