"""Band statistics: moments, "lower" quantiles, most common values, and samples.

Moments are one aggregation with partial sums on the map side. Exact records come from counts by
the leading bits of the values (see ``radix``), so no task ever holds or orders a whole band.
"""

from __future__ import annotations

import math
import warnings
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridmill.functions.nodata import counted, finite, valid_in_all
from gridmill.operators import radix
from gridmill.spec import Band, Raster, item_size

# Quantile groups, list lengths and sample size.
QUANTILE_GROUPS = range(3, 20)
TOP_VALUES_EXACT = 100
TOP_VALUES_SAMPLED = 10
SAMPLE_SIZE = 1000

# A sampled pixel's hash is two numbers below a prime; how many times n to look for at first.
HASH_PRIME = 2147483647
HASH_RANGE = HASH_PRIME * HASH_PRIME
SAMPLE_MARGIN = 10


# -- moments -------------------------------------------------------------------


def whole_sum(value: Column, bits: int) -> Column:
    """Exact sum of whole numbers of that many bits, as a double.

    Wider values are summed in two halves: a plain 64-bit sum of 32-bit values overflows after
    some two thousand million rows.
    """
    if bits <= 16:
        return F.sum(value.cast("long")).cast("double")
    value = value.cast("long")
    high = F.sum(F.shiftright(value, 16)).cast("decimal(38,0)")
    low = F.sum(value.bitwiseAND(F.lit(0xFFFF))).cast("decimal(38,0)")
    return (high * 65536 + low).cast("double")


def sums(value: Column, band: Band) -> tuple[Column, Column]:
    """Sum and sum of squares of a band's values."""
    bits = 8 * item_size(band.dtype)
    real = value.cast("double")
    if band.is_float:
        return F.sum(real), F.sum(real * real)
    if bits == 64:
        return F.sum(value.cast("decimal(20,0)")).cast("double"), F.sum(real * real)
    whole = value.cast("long")
    squares = whole_sum(whole * whole, 2 * bits) if bits <= 16 else F.sum(real * real)
    return whole_sum(whole, bits), squares


def moments(pixels: DataFrame, raster: Raster, keys: list[str] | None = None) -> DataFrame:
    """One row per band (and key): min, max, mean, stddev, sum, sum_squares and count.

    One pass over the pixels for all bands; rows are spread per band only after aggregation.
    """
    keys = keys or []
    wide, rows = [], []
    for i, band in enumerate(raster.bands):
        value = F.when(counted(raster, band.name), F.col(band.name))
        total, squares = sums(value, band)
        real = value.cast("double")
        fields = {
            "min": F.min(real),
            "max": F.max(real),
            "stddev": F.stddev_pop(real),
            "sum": total,
            "sum_squares": squares,
            "count": F.count(value),
        }
        wide += [c.alias(f"b{i}_{k}") for k, c in fields.items()]
        rows.append(
            F.struct(
                F.lit(i).alias("position"),
                F.lit(band.name).alias("name"),
                *[F.col(f"b{i}_{k}").alias(k) for k in fields],
            )
        )
    out = pixels.groupBy(*keys).agg(*wide) if keys else pixels.agg(*wide)
    out = out.select(*keys, F.explode(F.array(*rows)).alias("s")).select(*keys, "s.*")
    mean = F.when(F.col("count") > 0, F.col("sum") / F.col("count"))
    zero_if_none = {c: F.coalesce(F.col(c), F.lit(0.0)) for c in ("sum", "sum_squares")}
    return out.withColumns(zero_if_none).select(
        *keys, "position", "name", "min", "max", mean.alias("mean"), "stddev", "sum",
        "sum_squares", "count",
    )


# -- histograms ------------------------------------------------------------------


def band_values(
    pixels: DataFrame, raster: Raster, names=None, kind="double", keys: list[str] | None = None
) -> DataFrame:
    """Rows ``<keys>, name, v`` for the counted pixels of the bands, from one scan."""
    names, keys = names or raster.names, keys or []
    cells = [
        F.struct(
            F.lit(n).alias("name"),
            F.when(counted(raster, n), F.col(n)).cast(kind).alias("v"),
        )
        for n in names
    ]
    out = pixels.select(*keys, F.explode(F.array(*cells)).alias("c"))
    return out.select(*keys, "c.name", "c.v").where(F.col("v").isNotNull())


def whole_kind(bands) -> str:
    """The Spark type that holds the whole-number values of all these bands."""
    return "decimal(20,0)" if any(item_size(b.dtype) == 8 for b in bands) else "long"


def histogram(
    pixels: DataFrame, raster: Raster, bands: list[Band], kind: str, keys: list[str] | None = None
) -> DataFrame:
    """Rows ``<keys>, name, v, n``: how many counted pixels of a band have each value."""
    values = band_values(pixels, raster, [b.name for b in bands], kind, keys)
    return values.groupBy(*(keys or []), "name", "v").agg(F.count("*").alias("n"))


def top_values(
    pixels: DataFrame,
    raster: Raster,
    n: int = TOP_VALUES_EXACT,
    bands: list[Band] | None = None,
) -> DataFrame:
    """The n most common values of each whole-number band; equal counts go by value."""
    bands = bands or [b for b in raster.bands if not b.is_float]
    if not bands:
        raise ValueError("Most common values need a whole-number band")
    hist = histogram(pixels, raster, bands, whole_kind(bands)).withColumnRenamed("n", "count")
    # Spark cuts each task's list to n rows before the shuffle (group limit).
    order = Window.partitionBy("name").orderBy(F.desc("count"), "v")
    ranked = hist.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)
    return ranked.select("name", "rank", F.col("v").alias("value"), "count")


# -- quantiles -------------------------------------------------------------------


def quantile_pairs() -> list[tuple[int, int]]:
    return [(i, j) for i in QUANTILE_GROUPS for j in range(1, i)]


def quantile_ranks(count: int) -> list[tuple[int, int, int]]:
    """(group, part, rank) of each "lower" quantile of ``count`` sorted values."""
    return [(i, j, math.floor((count - 1) * (j / i))) for i, j in quantile_pairs()]


def quantiles(pixels: DataFrame, raster: Raster) -> DataFrame:
    """Rows ``name, parts, part, value``: the value at rank floor((n-1)*part/parts).

    By counting 16 bits of the values a scan (see ``radix``): one scan for bands of 8 and 16 bits,
    at most four for any.
    """
    records, _ = radix.band_records(pixels, raster, quantile_ranks)
    rows = [
        (raster.bands[i].name, parts, part, value)
        for i, record in records.items()
        for (parts, part), value in record.quantiles.items()
    ]
    schema = "name string, parts int, part int, value double"
    return pixels.sparkSession.createDataFrame(rows, schema)


def quantile_lists(found: DataFrame) -> DataFrame:
    """Rows ``name, quantiles MAP<INT, ARRAY<DOUBLE>>`` from the rows of :func:`quantiles`."""
    part = F.sort_array(F.collect_list(F.struct("part", "value")))
    lists = found.groupBy("name", "parts").agg(F.transform(part, lambda p: p.value).alias("list"))
    entries = F.sort_array(F.collect_list(F.struct("parts", "list")))
    return lists.groupBy("name").agg(F.map_from_entries(entries).alias("quantiles"))


# -- samples ---------------------------------------------------------------------


def sample_hash(seed: int) -> Column:
    """A number below ``HASH_RANGE`` that looks random, from the place of a pixel and the seed.

    Plain whole-number arithmetic, as every pixel of a raster is hashed.
    """
    return _mixed(48271, 69621, seed) * HASH_PRIME + _mixed(40014, 16807, seed + 1)


def _mixed(x_factor: int, y_factor: int, seed: int) -> Column:
    p = F.lit(HASH_PRIME).cast("long")
    h = (F.col("px") % p * x_factor + F.col("py") % p * y_factor + seed % HASH_PRIME) % p
    h = (h * (h + 39373) + 1) % p
    return (h * (h + 52774) + 3) % p


def sample_pixels(
    pixels: DataFrame, raster: Raster, n: int = SAMPLE_SIZE, seed: int = 0, below: int | None = None
) -> DataFrame:
    """A repeatable sample: the n pixels with the smallest hash among those valid in all bands.

    The first band of a sampled pixel is always a finite number. Each task keeps n rows at most,
    so only the winners are moved. ``below`` keeps smaller hashes only, which leaves the sample the
    same if n pixels have one.
    """
    first = raster.bands[0]
    ok = pixels.where(valid_in_all(raster) & finite(first.name, first))
    ok = ok.select("px", "py", *raster.names, sample_hash(seed).alias("hash"))
    if below is not None:
        ok = ok.where(F.col("hash") < below)
    return ok.orderBy("hash", "px", "py").limit(n)


def sample_values(sample: DataFrame, raster: Raster, names=None, kind="double") -> DataFrame:
    """Rows ``name, v``: the finite sampled values of each band."""
    cells = [
        F.struct(
            F.lit(b.name).alias("name"),
            F.when(finite(b.name, b), F.col(b.name)).cast(kind).alias("v"),
        )
        for b in raster.bands
        if names is None or b.name in names
    ]
    out = sample.select(F.explode(F.array(*cells)).alias("c")).select("c.name", "c.v")
    return out.where(F.col("v").isNotNull())


def sample_sums(sample: DataFrame, raster: Raster) -> DataFrame:
    """Count, whole sum and whole sum of squares of each band's sampled values."""
    v = F.col("v")
    return (
        sample_values(sample, raster)
        .groupBy("name")
        .agg(
            F.count("*").alias("count"),
            _whole(F.sum(v)).alias("sum"),
            _whole(F.sum(v * v)).alias("sum_squares"),
        )
    )


def _whole(value: Column) -> Column:
    """Cut to a whole number, toward zero."""
    return F.when(value < 0, F.ceil(value)).otherwise(F.floor(value)).cast("double")


def sample_quantiles(sample: DataFrame, raster: Raster) -> DataFrame:
    """Quantiles of the sampled values, cut to whole numbers. A sample is small: one window."""
    pairs = F.array(
        *[F.struct(F.lit(i).alias("parts"), F.lit(j).alias("part")) for i, j in quantile_pairs()]
    )
    ordered = F.sort_array(F.collect_list("v")).alias("sorted")
    lists = sample_values(sample, raster).groupBy("name").agg(ordered)
    at = F.floor((F.size("sorted") - 1) * (F.col("p.part") / F.col("p.parts"))).cast("int") + 1
    return (
        lists.withColumn("p", F.explode(pairs))
        .select("name", "p.parts", "p.part", _whole(F.element_at("sorted", at)).alias("value"))
    )


def sample_top_values(
    sample: DataFrame, raster: Raster, n: int = TOP_VALUES_SAMPLED
) -> DataFrame:
    """The n most common whole values in the sample of each whole-number band."""
    bands = [b for b in raster.bands if not b.is_float]
    values = sample_values(sample, raster, [b.name for b in bands], whole_kind(bands))
    hist = values.groupBy("name", "v").agg(F.count("*").alias("count"))
    order = Window.partitionBy("name").orderBy(F.desc("count"), "v")
    ranked = hist.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)
    return ranked.select("name", "rank", F.col("v").alias("value"), "count")


# -- whole records -----------------------------------------------------------------

def top_lists(ranked: DataFrame) -> DataFrame:
    """Rows ``name, top_values MAP`` in rank order."""
    entries = F.sort_array(F.collect_list(F.struct("rank", "value", "count")))
    pairs = F.transform(entries, lambda e: F.struct(e.value, e["count"]))
    return ranked.groupBy("name").agg(F.map_from_entries(pairs).alias("top_values"))


def band_stats(
    pixels: DataFrame,
    raster: Raster,
    exact: bool = False,
    basic: bool = False,
    seed: int = 0,
    version: str = "",
    sample_size: int = SAMPLE_SIZE,
) -> DataFrame:
    """One stats record per band: rows ``position, name, <fields of the record>``.

    Smallest and largest value, mean and deviation are those of all counted pixels in both modes:
    they are one partial aggregate. The approximate mode takes the other fields from a sample,
    drawn once for all bands.
    """
    whole = [b.name for b in raster.bands if not b.is_float]
    top_type = top_map(raster)
    if exact and not basic:
        record = exact_records(pixels, raster)
    elif exact:
        record = moments(pixels, raster)
    else:
        sample = drawn_sample(pixels, raster, seed, sample_size)
        totals = sample_sums(sample, raster)
        record = moments(pixels, raster).drop("sum", "sum_squares", "count")
        record = record.join(totals, "name", "left").withColumns(
            {c: F.coalesce(c, F.lit(0.0)) for c in ("sum", "sum_squares")}
            | {"count": F.coalesce("count", F.lit(0).cast("long"))}
        )
    if basic:
        record = record.withColumns(
            {
                "quantiles": F.lit(None).cast("map<int, array<double>>"),
                "top_values": F.lit(None).cast(top_type),
            }
        )
    elif not exact:
        record = record.join(quantile_lists(sample_quantiles(sample, raster)), "name", "left")
        if whole:
            tops = top_lists(sample_top_values(sample, raster))
            record = record.join(tops, "name", "left")
        else:
            record = record.withColumn("top_values", F.lit(None).cast(top_type))
        empty = F.create_map().cast(top_type)
        record = record.withColumn("top_values", F.coalesce("top_values", empty))
    return record.select(
        "position", "name", "min", "max", "mean", "stddev", "sum", "sum_squares", "count",
        "quantiles", "top_values", F.lit(version).alias("version"),
        F.lit(not exact).alias("approximated_stats"),
    )


def top_map(raster: Raster) -> str:
    """The type of a map of most common values."""
    return f"map<{whole_kind(b for b in raster.bands if not b.is_float)}, long>"


def exact_records(pixels: DataFrame, raster: Raster) -> DataFrame:
    """Exact records of all bands as a local frame: at most 170 quantiles and 100 values a band.

    Bands of up to 16 bits take one scan for everything. Wider ones are scanned up to three times
    more for their quantiles, and wide whole-number bands once for their most common values.
    """
    records, _ = radix.band_records(pixels, raster, quantile_ranks, TOP_VALUES_EXACT)
    tops = {raster.bands[i].name: dict(r.tops) for i, r in records.items()}
    wide = [b for b in raster.bands if not b.is_float and radix.key_bits(b) > radix.DIGIT]
    if wide:
        found = top_values(pixels, raster, bands=wide).orderBy("name", "rank").collect()
        for r in found:
            tops.setdefault(r["name"], {})[int(r["value"])] = r["count"]
    decimal = "decimal" in top_map(raster)
    rows = []
    for i, band in enumerate(raster.bands):
        if i not in records:
            rows.append((i, band.name, *[None] * 4, 0.0, 0.0, 0, None, None))
            continue
        m, lists = records[i].moments, None
        lists = [
            (parts, [records[i].quantiles[parts, k] for k in range(1, parts)])
            for parts in QUANTILE_GROUPS
        ]
        own = [(Decimal(v) if decimal else v, n) for v, n in tops.get(band.name, {}).items()]
        rows.append(
            (i, band.name, m["min"], m["max"], m["mean"], m["stddev"], m["sum"], m["sum_squares"],
             m["count"], lists, None if band.is_float else own)
        )
    kind = "decimal(20,0)" if decimal else "long"
    found = pixels.sparkSession.createDataFrame(
        rows,
        "position int, name string, min double, max double, mean double, stddev double, "
        "sum double, sum_squares double, count long, "
        "quantiles array<struct<parts int, list array<double>>>, "
        f"top_values array<struct<value {kind}, count long>>",
    )
    # Maps made here keep the order of their entries.
    return found.withColumns({c: F.map_from_entries(c) for c in ("quantiles", "top_values")})


def drawn_sample(
    pixels: DataFrame, raster: Raster, seed: int = 0, n: int = SAMPLE_SIZE
) -> DataFrame:
    """The sample as a small local frame, so that each band's statistics reuse it.

    If the size of the raster is known, only hashes so small that some ten times n pixels should
    have one are looked at first; if too few pixels turn out to, all are.
    """
    area = (raster.width or 0) * (raster.height or 0)
    few = area > SAMPLE_MARGIN * n
    bound = HASH_RANGE * SAMPLE_MARGIN * n // area if few else None
    rows = sample_pixels(pixels, raster, n, seed, bound).collect()  # at most n rows
    if len(rows) < n and bound is not None:
        rows = sample_pixels(pixels, raster, n, seed).collect()
    if not rows:
        raise ValueError("No valid pixel to sample: the data is too sparse; use exact statistics")
    if len(rows) < n:
        warnings.warn(f"Only {len(rows)} valid pixels to sample; statistics may be inaccurate")
    return pixels.sparkSession.createDataFrame(rows, sample_pixels(pixels, raster).schema)


def band_sizes(raster: Raster) -> list[tuple[str, str, float]]:
    """Name, type and decoded size in MB of each band."""
    area = raster.width * raster.height
    return [(b.name, b.dtype, area * item_size(b.dtype) / 1024 / 1024) for b in raster.bands]
