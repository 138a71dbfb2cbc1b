"""Queries over band statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridmill.operators import stats, summaries
from gridmill.plans import fixtures as fx
from gridmill.plans.registry import query
from gridmill.sources import pixels as px
from gridmill.spec import Band

# A whole-number band, a masked one, a float band with gaps, all judged on their own.
BANDS = fx.plane(fx.B1, Band("b2", nodata=0), Band("g1", "float64"), Band("a1"))
MASKS = {"b1": "true", "b2": "b2 <> 0", "g1": "NOT isnan(g1)", "a1": "true"}


def _values(*names: str) -> str:
    parts = [
        f"SELECT '{n}' AS name, CAST({n} AS DOUBLE) AS v, * FROM v_gappy WHERE {MASKS[n]}"
        for n in names
    ]
    return " UNION ALL ".join(parts)


# Sums of a float band differ in their last digits with the order of adding; show fewer. Prices
# end in whole cents, so divide by something that keeps sums off the rounding edges.
_SHOWN = """name, round(min, 6) AS min, round(max, 6) AS max, round(mean, 6) AS mean,
    round(stddev, 6) AS stddev, round(sum / 997, 3) AS scaled_sum,
    round(sum_squares / 9.97e8, 3) AS scaled_squares, count"""
_MOMENTS = """min(v) AS min, max(v) AS max, avg(v) AS mean, stddev_pop(v) AS stddev, sum(v) AS sum,
    sum(v * v) AS sum_squares, count(*) AS count"""


def _shown(record):
    return record.selectExpr(*[c.strip() for c in _split(_SHOWN)])


def _split(columns: str) -> list[str]:
    out, depth, last = [], 0, 0
    for i, ch in enumerate(columns):
        depth += (ch == "(") - (ch == ")")
        if ch == "," and not depth:
            out.append(columns[last:i])
            last = i + 1
    return [*out, columns[last:]]


@query(
    "band_stats_exact",
    sql=f"""
    SELECT {_SHOWN}, quantile_groups, quantile_sum, top_count
    FROM (SELECT name, {_MOMENTS} FROM ({_values(*MASKS)}) GROUP BY name)
    JOIN (SELECT name, 17 AS quantile_groups, round(sum(q), 2) AS quantile_sum FROM (
        SELECT name,
            list_sort(list(v))[1 + CAST(floor((count(*) - 1) * (j::DOUBLE / i)) AS BIGINT)] AS q
        FROM ({_values(*MASKS)}),
            (SELECT i, unnest(range(1, i)) AS j FROM (SELECT unnest(range(3, 20)) AS i))
        GROUP BY name, i, j) GROUP BY name) USING (name)
    LEFT JOIN (SELECT name, CAST(sum(n) AS BIGINT) AS top_count FROM (
        SELECT name, count(*) AS n FROM ({_values("b1", "b2", "a1")}) GROUP BY name, v)
        GROUP BY name) USING (name)""",
)
def band_stats_exact(spark, sf):
    """The whole exact record of each band."""
    record = stats.band_stats(fx.gappy(spark, sf), BANDS, exact=True)
    lists = F.map_values("quantiles")
    total = F.aggregate(
        F.flatten(lists), F.lit(0.0), lambda a, v: a + v, lambda a: F.round(a, 2)
    )
    counts = F.aggregate(
        F.map_values("top_values"), F.lit(0).cast("long"), lambda a, v: a + v
    )
    shown = record.withColumns(
        {
            "quantile_groups": F.size("quantiles"),
            "quantile_sum": total,
            "top_count": counts,
        }
    )
    extra = ["quantile_groups", "quantile_sum", "top_count"]
    return shown.selectExpr(*[c.strip() for c in _split(_SHOWN)], *extra)


@query(
    "band_stats_basic",
    sql=f"""
    SELECT {_SHOWN}, true AS no_quantiles, true AS no_top_values
    FROM (SELECT name, {_MOMENTS} FROM ({_values(*MASKS)}) GROUP BY name)""",
)
def band_stats_basic(spark, sf):
    """The exact record without quantiles and most common values."""
    record = stats.band_stats(fx.gappy(spark, sf), BANDS, exact=True, basic=True)
    return record.selectExpr(
        *[c.strip() for c in _split(_SHOWN)],
        "quantiles IS NULL AS no_quantiles",
        "top_values IS NULL AS no_top_values",
    )


@query(
    "band_stats_by_tile",
    sql=f"""
    SELECT tx, ty, {_SHOWN}
    FROM (SELECT px // 64 AS tx, py // 64 AS ty, name, {_MOMENTS} FROM ({_values(*MASKS)})
        GROUP BY ALL)""",
)
def band_stats_by_tile(spark, sf):
    """Moments of every band in every tile."""
    pixels = fx.gappy(spark, sf).withColumns(
        {"tx": F.shiftright("px", 6), "ty": F.shiftright("py", 6)}
    )
    record = stats.moments(pixels, BANDS, ["tx", "ty"]).where("count > 0")
    return record.selectExpr("tx", "ty", *[c.strip() for c in _split(_SHOWN)])


_QUANTILES_SQL = """
    SELECT name, CAST(i AS INT) AS parts, CAST(j AS INT) AS part,
        list_sort(list(v))[1 + CAST(floor((count(*) - 1) * (j::DOUBLE / i)) AS BIGINT)] AS value
    FROM ({values}), (SELECT i, unnest(range(1, i)) AS j FROM (SELECT unnest(range(3, 20)) AS i))
    GROUP BY name, i, j"""


@query("band_quantiles", sql=_QUANTILES_SQL.format(values=_values(*MASKS)))
def band_quantiles(spark, sf):
    """All "lower" quantiles of each band."""
    return stats.quantiles(fx.gappy(spark, sf), BANDS)


@query("band_quantiles_narrowing", sql=_QUANTILES_SQL.format(values=_values("g1")))
def band_quantiles_narrowing(spark, sf):
    """Quantiles of the float band alone, by narrowing ranges."""
    return stats.quantiles(fx.gappy(spark, sf), BANDS.select("g1"))


@query(
    "sparse_stats",
    sql=f"""
    SELECT name, min(v) AS min, max(v) AS max, round(avg(v), 6) AS mean,
        round(stddev_pop(v), 6) AS stddev
    FROM ({_values("b1", "b2")}) WHERE px % 2 = 1 AND py % 2 = 0 GROUP BY name""",
)
def sparse_stats(spark, sf):
    """The approximate record of pixels that lie on no level of the pyramid."""
    pixels = fx.grid(spark, sf).where("px % 2 = 1 AND py % 2 = 0")
    raster = px.measured(pixels, fx.plane(fx.B1, Band("b2", nodata=0), levels=3))
    record = stats.band_stats(pixels, raster, basic=True, seed=fx.SEED)
    return record.select(
        "name", "min", "max", *[F.round(c, 6).alias(c) for c in ("mean", "stddev")]
    )


@query(
    "band_top_values",
    sql=f"""
    SELECT name, CAST(rank AS INT) AS rank, CAST(v AS BIGINT) AS value, n AS count FROM (
        SELECT *, row_number() OVER (PARTITION BY name ORDER BY n DESC, v) AS rank
        FROM (SELECT name, v, count(*) AS n FROM ({_values("b1", "b2", "a1")}) GROUP BY name, v))
    WHERE rank <= 100""",
)
def band_top_values(spark, sf):
    return stats.top_values(fx.gappy(spark, sf), BANDS)


# -- summaries -------------------------------------------------------------------

WHOLE = BANDS.select("b1", "b2", "a1")


def _merged_summary(spark, sf):
    """The summaries of all tiles, merged by row of tiles and then into one."""
    pixels = fx.gappy(spark, sf).withColumns(
        {"tx": F.shiftright("px", 6), "ty": F.shiftright("py", 6)}
    )
    tiles = summaries.summarise(pixels, WHOLE, ["tx", "ty"])
    return summaries.merge(summaries.merge(tiles, ["ty"]).drop("ty"))


@query(
    "summary_merge",
    sql=f"""
    SELECT name, CAST(v AS BIGINT) AS value, count(*) AS n
    FROM ({_values("b1", "b2", "a1")}) GROUP BY ALL""",
)
def summary_merge(spark, sf):
    """Merged summaries of tiles: the histogram of the whole."""
    return _merged_summary(spark, sf).select("name", "value", "n")


@query("summary_quantiles", sql=_QUANTILES_SQL.format(values=_values("b1", "b2", "a1")))
def summary_quantiles(spark, sf):
    """Exact quantiles of the whole from merged summaries."""
    return summaries.quantiles(_merged_summary(spark, sf))


@query(
    "summary_sketch",
    sql=f"""
    SELECT 'g1' AS name, count(*) AS n, 170::BIGINT AS quantiles, 0::BIGINT AS out_of_bound
    FROM ({_values("g1")})""",
)
def summary_sketch(spark, sf):
    """Sketches of all rows of tiles merged: how many quantiles have a rank further off than stated."""
    raster = BANDS.select("g1")
    pixels = fx.gappy(spark, sf).withColumn("ty", F.shiftright("py", 6))
    merged = summaries.merge(summaries.summarise(pixels, raster, ["ty"]))
    found = summaries.quantiles(merged)
    spot = F.struct((F.col("part") / F.col("parts")).alias("wanted"), "value")
    spots = found.groupBy("name").agg(F.array_sort(F.collect_list(spot)).alias("spots"))
    # The rank of each found value: how many of the pixels' different values lie below it.
    hist = stats.histogram(pixels, raster, list(raster.bands), "double")
    ranked = (
        hist.join(F.broadcast(spots), "name")
        .select("name", "v", "n", F.posexplode("spots").alias("i", "spot"))
        .groupBy("name", "i", "spot")
        .agg(
            F.sum(F.when(F.col("v") < F.col("spot.value"), F.col("n")).otherwise(0)).alias("below"),
            F.sum(F.when(F.col("v") <= F.col("spot.value"), F.col("n")).otherwise(0)).alias("upto"),
            F.sum("n").alias("n"),
        )
    )
    slack = summaries.RANK_ERROR * F.col("n") + 1
    wanted = F.col("spot.wanted") * F.col("n")
    off = (F.col("below") > wanted + slack) | (F.col("upto") < wanted - slack)
    return ranked.groupBy("name").agg(
        F.max("n").alias("n"),
        F.count("*").alias("quantiles"),
        F.count_if(off).alias("out_of_bound"),
    )


# -- samples ---------------------------------------------------------------------


def _mixed(x_factor: int, y_factor: int, seed: int) -> str:
    p = 2147483647
    h = f"((px % {p} * {x_factor} + py % {p} * {y_factor} + {seed}) % {p})"
    h = f"(({h} * ({h} + 39373) + 1) % {p})"
    return f"(({h} * ({h} + 52774) + 3) % {p})"


_HASH = f"{_mixed(48271, 69621, fx.SEED)} * 2147483647 + {_mixed(40014, 16807, fx.SEED + 1)}"
_SAMPLE = f"""
    SELECT * FROM v_gappy WHERE b2 <> 0 AND NOT isnan(g1)
    ORDER BY {_HASH}, px, py LIMIT 1000"""


def _sample(spark, sf):
    return stats.sample_pixels(fx.gappy(spark, sf), BANDS, seed=fx.SEED)


@query("sample_pixels", sql=f"SELECT px, py, b1, b2, g1, a1 FROM ({_SAMPLE})")
def sample_pixels(spark, sf):
    """The repeatable sample of a thousand pixels that are valid in every band."""
    return _sample(spark, sf).select("px", "py", "b1", "b2", "g1", "a1")


_SAMPLED = " UNION ALL ".join(
    f"SELECT '{n}' AS name, CAST({n} AS DOUBLE) AS v FROM s" for n in MASKS
)


@query(
    "sample_stats",
    sql=f"""
    WITH s AS ({_SAMPLE})
    SELECT name, round(min, 6) AS min, round(max, 6) AS max, round(mean, 6) AS mean,
        round(stddev, 6) AS stddev, sum, sum_squares, count
    FROM (SELECT name, min(v) AS min, max(v) AS max, avg(v) AS mean, stddev_pop(v) AS stddev FROM
            ({" UNION ALL ".join(
                f"SELECT '{n}' AS name, CAST({n} AS DOUBLE) AS v FROM v_gappy WHERE {m}"
                for n, m in MASKS.items())})
        GROUP BY name)
    JOIN (SELECT name, floor(round(sum(v), 4)) AS sum, floor(round(sum(v * v), 4)) AS sum_squares,
            count(*) AS count
        FROM ({_SAMPLED}) GROUP BY name) USING (name)""",
)
def sample_stats(spark, sf):
    """The approximate record: moments of all pixels, sums from the sample."""
    pixels = fx.gappy(spark, sf)
    raster = px.measured(pixels, fx.plane(*BANDS.bands, levels=3))
    record = stats.band_stats(pixels, raster, basic=True, seed=fx.SEED)
    return record.select(
        "name", *[F.round(c, 6).alias(c) for c in ("min", "max", "mean", "stddev")],
        "sum", "sum_squares", "count",
    )


@query(
    "sample_quantiles",
    sql=f"""
    WITH s AS ({_SAMPLE})
    SELECT name, CAST(i AS INT) AS parts, CAST(j AS INT) AS part, floor(
        list_sort(list(v))[1 + CAST(floor((count(*) - 1) * (j::DOUBLE / i)) AS BIGINT)]) AS value
    FROM ({_SAMPLED}),
        (SELECT i, unnest(range(1, i)) AS j FROM (SELECT unnest(range(3, 20)) AS i))
    GROUP BY name, i, j""",
)
def sample_quantiles(spark, sf):
    """Quantiles of the sample, cut to whole numbers."""
    return stats.sample_quantiles(_sample(spark, sf), BANDS)


@query(
    "sample_top_values",
    sql=f"""
    WITH s AS ({_SAMPLE})
    SELECT name, CAST(rank AS INT) AS rank, CAST(v AS BIGINT) AS value, n AS count FROM (
        SELECT *, row_number() OVER (PARTITION BY name ORDER BY n DESC, v) AS rank
        FROM (SELECT name, v, count(*) AS n FROM ({_SAMPLED}) WHERE name <> 'g1' GROUP BY name, v))
    WHERE rank <= 10""",
)
def sample_top_values(spark, sf):
    return stats.sample_top_values(_sample(spark, sf), BANDS)
