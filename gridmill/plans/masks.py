"""Queries over nodata values and masks."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridmill.functions import nodata
from gridmill.plans import fixtures as fx
from gridmill.plans.registry import query
from gridmill.spec import DEFAULT_NODATA, Band

_DEFAULTS = "CASE dtype " + " ".join(
    f"WHEN '{k}' THEN '{float(v)!r}'::DOUBLE" for k, v in DEFAULT_NODATA.items()
) + " END"
_DEFAULT_TEXTS = "CASE dtype " + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in DEFAULT_NODATA.items()
) + " END"


@query(
    "band_nodata",
    sql=f"""
    SELECT raster, band, dtype, coalesce(ds_nodata, band_nodata, {_DEFAULTS}) AS nodata,
        CASE WHEN colorinterp = 'alpha' THEN '0'
            WHEN isnan(coalesce(ds_nodata, band_nodata)) THEN 'nan'
            ELSE coalesce(CAST(coalesce(ds_nodata, band_nodata) AS VARCHAR), {_DEFAULT_TEXTS})
        END AS nodata_text
    FROM v_catalog""",
)
def band_nodata(spark, sf):
    """Effective nodata of each band of a catalogue and its text in the metadata."""
    args = F.col("ds_nodata"), F.col("band_nodata"), F.col("dtype")
    return fx.catalog(spark, sf).select(
        "raster",
        "band",
        "dtype",
        nodata.effective_nodata(*args).alias("nodata"),
        nodata.nodata_text(*args, F.col("colorinterp")).alias("nodata_text"),
    )


@query(
    "nodata_consensus",
    sql=f"""
    SELECT raster, max(nodata) FILTER (band = 1) AS nodata,
        bool_or(ds_nodata IS NOT NULL) OR count(DISTINCT nodata) = 1 AS agrees
    FROM (SELECT *, coalesce(ds_nodata, band_nodata, {_DEFAULTS}) AS nodata FROM v_catalog)
    GROUP BY raster""",
)
def nodata_consensus(spark, sf):
    """Per raster, the table's nodata and whether its bands agree on it (NaN agrees with NaN)."""
    value = nodata.effective_nodata(F.col("ds_nodata"), F.col("band_nodata"), F.col("dtype"))
    stated = F.bool_or(F.col("ds_nodata").isNotNull())
    return (
        fx.catalog(spark, sf)
        .withColumn("nodata", value)
        .groupBy("raster")
        .agg(
            F.max(F.when(F.col("band") == 1, F.col("nodata"))).alias("nodata"),
            (stated | (F.count_distinct("nodata") == 1)).alias("agrees"),
        )
    )


@query(
    "mask_single",
    sql="SELECT px, py, b2 = 0 AS b2_masked, isnan(g1) AS g1_masked FROM v_gappy",
)
def mask_single(spark, sf):
    """One band against its own nodata, a number or NaN."""
    whole, real = fx.plane(fx.B2, nodata=0), fx.FLOATS
    return fx.gappy(spark, sf).select(
        "px",
        "py",
        nodata.masked(whole, "b2").alias("b2_masked"),
        nodata.masked(real, "g1").alias("g1_masked"),
    )


@query(
    "mask_rgb",
    sql="""
    SELECT px, py, b1 % 5 = 0 AND b2 = 0 AND b3 = 0 AS c1_masked,
        b1 % 5 = 0 AND b2 = 0 AND b3 = 0 AS b3_masked
    FROM v_grid""",
)
def mask_rgb(spark, sf):
    """A colour pixel is masked only if all three colours are nodata."""
    return fx.coloured(spark, sf).select(
        "px",
        "py",
        nodata.masked(fx.COLOURS, "c1").alias("c1_masked"),
        nodata.masked(fx.COLOURS, "b3").alias("b3_masked"),
    )


@query("mask_alpha", sql="SELECT px, py, a1 = 0 AS b1_masked, a1 = 0 AS f1_masked FROM v_grid")
def mask_alpha(spark, sf):
    return fx.grid(spark, sf).select(
        "px",
        "py",
        nodata.masked(fx.WITH_ALPHA, "b1").alias("b1_masked"),
        nodata.masked(fx.WITH_ALPHA, "f1").alias("f1_masked"),
    )


@query(
    "mask_dispatch",
    sql="""
    SELECT px, py, true AS alpha_itself, a1 <> 0 AS under_alpha, true AS unstated,
        b2 <> 0 AS single,
        NOT isnan(g1) AS real, NOT (b1 % 5 = 0 AND b2 = 0 AND b3 = 0) AS colour
    FROM v_gappy""",
)
def mask_dispatch(spark, sf):
    """Which rule masks a band: none, alpha, the colour triplet or its own nodata."""
    pixels = fx.gappy(spark, sf).withColumn("c1", F.col("b1") % 5)
    rules = {
        "alpha_itself": (fx.WITH_ALPHA, "a1"),
        "under_alpha": (fx.WITH_ALPHA, "b1"),
        "unstated": (fx.plane(fx.B2), "b2"),
        "single": (fx.plane(fx.B2, nodata=0), "b2"),
        "real": (fx.FLOATS, "g1"),
        "colour": (fx.COLOURS, "c1"),
    }
    flags = [nodata.valid(raster, band).alias(n) for n, (raster, band) in rules.items()]
    return pixels.select("px", "py", *flags)


@query(
    "fill_nodata",
    sql="""
    SELECT px, py, CAST(CASE WHEN a1 = 0 THEN 9 ELSE b1 END AS SMALLINT) AS b1,
        CAST(CASE WHEN a1 = 0 THEN 9 ELSE b2 END AS SMALLINT) AS b2, CAST(a1 AS SMALLINT) AS a1
    FROM v_grid""",
)
def fill_nodata(spark, sf):
    """Masked pixels take the table's nodata; the alpha band keeps its values."""
    raster = fx.plane(fx.B1, fx.B2, Band("a1", colorinterp="alpha"), nodata=9)
    return fx.grid(spark, sf).select(
        "px", "py", *[nodata.filled(raster, n).alias(n) for n in raster.names]
    )
