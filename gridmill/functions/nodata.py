"""Nodata values and validity masks as columns."""

from __future__ import annotations

import math
from decimal import Decimal
from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridmill.spec import DEFAULT_NODATA, Band, Raster, item_size


# -- nodata of many bands, held in rows -------------------------------------


def default_nodata(dtype: Column) -> Column:
    """Default nodata of a band type; an unknown type is an error."""
    pairs = [F.lit(v) for k, n in DEFAULT_NODATA.items() for v in (k, float(n))]
    found = F.try_element_at(F.create_map(*pairs), dtype)
    known = dtype.isin(*DEFAULT_NODATA)
    message = F.concat(F.lit("No raster type is called "), dtype)
    return F.when(known, found).otherwise(F.raise_error(message))


def effective_nodata(dataset: Column, band: Column, dtype: Column) -> Column:
    return F.coalesce(dataset, band, default_nodata(dtype))


def float_text(value: Column) -> Column:
    """Text of a double in the notation of the metadata document (``0.0``, ``-3.4e+38``)."""
    text = value.cast("string")
    exponent = F.regexp_replace(text, r"(\.0)?E(\d+)$", "e+$2")
    exponent = F.regexp_replace(exponent, r"(\.0)?E-(\d)$", "e-0$2")
    exponent = F.regexp_replace(exponent, r"(\.0)?E-(\d+)$", "e-$2")
    whole = F.concat(value.cast("decimal(20,0)").cast("string"), F.lit(".0"))
    is_whole = (F.abs(value) < 1e16) & (F.floor(value) == value)
    return F.when(is_whole, whole).otherwise(exponent)


def nodata_text(dataset: Column, band: Column, dtype: Column, colorinterp: Column) -> Column:
    """The nodata of a band as the metadata document states it."""
    stated = F.coalesce(dataset, band)
    pairs = [F.lit(v) for k, n in DEFAULT_NODATA.items() for v in (k, str(n))]
    return (
        F.when(colorinterp.eqNullSafe(F.lit("alpha")), F.lit("0"))
        .when(F.isnan(stated), F.lit("nan"))
        .when(stated.isNotNull(), float_text(stated))
        .otherwise(F.try_element_at(F.create_map(*pairs), dtype))
    )


# -- masks over the pixel columns of one raster -----------------------------


def literal(value, band: Band) -> Column:
    """A nodata value as a literal of the band's own column type."""
    if isinstance(value, float) and not math.isnan(value) and not band.is_float:
        value = int(value)
    if isinstance(value, int) and abs(value) >= 1 << 63:
        value = Decimal(value)
    return F.lit(value).cast(band.spark_type)


def equals_nodata(value: Column, nodata, band: Band) -> Column:
    # Spark holds NaN = NaN true; be explicit so that the rule does not rest on it.
    if isinstance(nodata, float) and math.isnan(nodata):
        return F.isnan(value) if band.is_float else F.lit(False)
    if not band.is_float and (nodata != int(nodata) or not _fits(int(nodata), band.dtype)):
        return F.lit(False)
    return value == literal(nodata, band)


def _fits(value: int, dtype: str) -> bool:
    bits = 8 * item_size(dtype)
    low, high = (0, 2**bits) if dtype.startswith("u") else (-(2 ** (bits - 1)), 2 ** (bits - 1))
    return low <= value < high


def masked(raster: Raster, name: str) -> Column:
    """True where a band's pixel does not count as data. Pixels with no value never count."""
    band = raster.band(name)
    absent = F.col(name).isNull()
    if raster.always_valid(band):
        return absent
    if raster.alpha is not None:
        return absent | F.coalesce(F.col(raster.alpha.name) == 0, F.lit(True))
    parts = [equals_nodata(F.col(b.name), raster.band_nodata(b), b) for b in raster.compound(band)]
    return absent | reduce(and_, parts)


def valid(raster: Raster, name: str) -> Column:
    return ~masked(raster, name)


def counted(raster: Raster, name: str) -> Column:
    """Pixels that enter the statistics: valid and a number."""
    ok = valid(raster, name)
    return ok & ~F.isnan(F.col(name)) if raster.band(name).is_float else ok


def valid_in_all(raster: Raster) -> Column:
    return reduce(and_, [valid(raster, n) for n in raster.names])


def finite(name: str, band: Band) -> Column:
    value = F.col(name)
    if not band.is_float:
        return value.isNotNull()
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) != F.lit(math.inf))


def filled(raster: Raster, name: str) -> Column:
    """The value to store: masked pixels become the table's nodata, alpha keeps its own values."""
    band = raster.band(name)
    value = F.col(name).cast(band.spark_type)
    if band == raster.alpha:
        return F.coalesce(value, F.lit(0).cast(band.spark_type))
    nodata = literal(raster.table_nodata, band)
    if raster.alpha is not None:
        hidden = masked(raster, name)
    elif raster.stated_nodata(band) is not None:
        hidden = F.col(name).isNull() | equals_nodata(F.col(name), raster.stated_nodata(band), band)
    else:
        hidden = F.col(name).isNull()
    return F.when(hidden, nodata).otherwise(value)
