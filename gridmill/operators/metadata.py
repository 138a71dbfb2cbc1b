"""The metadata document of a table: building, reading, checking and merging it."""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmill.functions.geo import tile_lat, tile_lon
from gridmill.operators.arcs import arc_middle, enclosing_arc
from gridmill.operators.stats import SAMPLE_SIZE, band_stats
from gridmill.sources.pixels import measured
from gridmill.spec import Band, Raster

# The names of a document's fields. JSON keys are strings, so maps have string keys.
STATS_JSON = """struct<min double, max double, mean double, stddev double, sum double,
    sum_squares double, count bigint, quantiles map<string, array<double>>,
    top_values map<string, bigint>, version string, approximated_stats boolean>"""
BAND_JSON = f"""struct<type string, name string, stats {STATS_JSON}, colorinterp string,
    nodata string, colortable map<string, array<int>>, valuelabels map<string, string>>"""
DOCUMENT_JSON = f"""struct<compression string, block_resolution int, minresolution int,
    maxresolution int, nodata double, bands array<{BAND_JSON}>, bounds array<double>,
    center array<double>, width bigint, height bigint, block_width int, block_height int,
    num_blocks bigint, num_pixels bigint, pixel_resolution int>"""

# Fields of a band that say what it is; the others may differ between rasters of one table.
BAND_IDENTITY = ("type", "name", "nodata")

# Slack, in tiles, for bounds that lie on a tile edge up to rounding.
EDGE_SLACK = 1e-9


def to_document(struct: Column) -> Column:
    return F.to_json(struct, {"ignoreNullFields": "false"})


def parse(document: Column) -> Column:
    return F.from_json(document, DOCUMENT_JSON)


# -- building ------------------------------------------------------------------


def nodata_label(raster: Raster, band: Band) -> str:
    if band == raster.alpha:
        return "0"
    stated = raster.stated_nodata(band)
    return str(raster.band_nodata(band)) if stated is None else str(float(stated))


def json_nodata(value: Column) -> Column:
    """NaN has no JSON form; the document says null."""
    return F.when(~F.isnan(value), value)


def color_table(colorinterp: Column, table: Column) -> Column:
    return F.when(colorinterp.eqNullSafe(F.lit("palette")), table)


def extent(tile_x0, tile_y0, z, width, height, block_width, block_height) -> dict[str, Column]:
    """Bounds and centre of a tile-aligned raster; in Mercator its outline is a rectangle."""
    west, east = tile_lon(tile_x0, z), tile_lon(tile_x0 + width / block_width, z)
    north, south = tile_lat(tile_y0, z), tile_lat(tile_y0 + height / block_height, z)
    bounds = F.array(west, south, east, north)
    center = F.array((west + east) / 2, (south + north) / 2, z.cast("double"))
    return {"bounds": bounds, "center": center}


# The fields of a statistics record, in their order.
RECORD = (
    "min", "max", "mean", "stddev", "sum", "sum_squares", "count", "quantiles", "top_values",
    "version", "approximated_stats",
)


def document(
    pixels: DataFrame,
    raster: Raster,
    exact: bool = False,
    basic: bool = False,
    compress: bool = False,
    seed: int = 0,
    version: str = "",
    sample_size: int = SAMPLE_SIZE,
) -> DataFrame:
    """One row ``metadata``: the JSON document of a raster."""
    raster = measured(pixels, raster)
    stats = band_stats(pixels, raster, exact, basic, seed, version, sample_size)
    place = pixels.sparkSession.createDataFrame(
        [(raster.tile_x0, raster.tile_y0, raster.width, raster.height)],
        "tile_x0 long, tile_y0 long, width long, height long",
    )
    return documents(stats, place, raster, compress=compress)


def documents(
    stats: DataFrame,
    places: DataFrame,
    raster: Raster,
    keys: list[str] | None = None,
    compress: bool = False,
) -> DataFrame:
    """Documents of many rasters of one kind, as rows ``<keys>, metadata``.

    ``stats`` has one record per band and raster, ``places`` one row ``<keys>, tile_x0, tile_y0,
    width, height`` per raster; ``raster`` gives what they share.
    """
    keys = keys or []
    by = keys or ["__all"]
    if not keys:
        stats, places = (df.withColumn("__all", F.lit(0)) for df in (stats, places))
    facts = [
        (i, b.dtype, b.colorinterp, nodata_label(raster, b), _palette(b), b.valuelabels)
        for i, b in enumerate(raster.bands)
    ]
    facts = stats.sparkSession.createDataFrame(
        facts,
        "position int, type string, colorinterp string, nodata string, "
        "colortable map<int, array<int>>, valuelabels map<string, string>",
    )
    band = F.struct(
        "type", "name", F.struct(*RECORD).alias("stats"), "colorinterp", "nodata", "colortable",
        "valuelabels",
    ).alias("band")
    bands = stats.join(F.broadcast(facts), "position").select(*by, "position", band)
    # Maps cannot be sorted, so order the positions and look the bands up.
    listed = bands.groupBy(*by).agg(
        F.map_from_entries(F.collect_list(F.struct("position", "band"))).alias("bands")
    )
    ordered = F.transform(F.sort_array(F.map_keys("bands")), lambda i: F.element_at("bands", i))
    bw, bh = F.lit(raster.block_width), F.lit(raster.block_height)
    width, height = F.col("width").cast("long"), F.col("height").cast("long")
    place = extent(F.col("tile_x0"), F.col("tile_y0"), F.lit(raster.zoom), width, height, bw, bh)
    fields = {
        "compression": F.lit("gzip" if compress else None).cast("string"),
        "block_resolution": F.lit(raster.zoom),
        "minresolution": F.lit(raster.zoom - raster.levels),
        "maxresolution": F.lit(raster.zoom),
        "nodata": json_nodata(F.lit(float(raster.table_nodata))),
        "bands": ordered,
        "bounds": place["bounds"],
        "center": place["center"],
        "width": width,
        "height": height,
        "block_width": bw,
        "block_height": bh,
        "num_blocks": F.floor(width * height / raster.cells),
        "num_pixels": width * height,
        "pixel_resolution": F.lit(raster.pixel_resolution),
    }
    whole = F.struct(*[c.alias(k) for k, c in fields.items()])
    both = _side_by_side(places, listed, by)
    return both.select(*keys, to_document(whole).alias("metadata"))


def identity(raster: Raster, compress: bool = False) -> str:
    """The facts of a raster's document that loads of one table share, known before any pixel."""
    nodata = float(raster.table_nodata)
    bands = [
        {"type": b.dtype, "name": b.name, "nodata": nodata_label(raster, b)} for b in raster.bands
    ]
    facts = {
        "compression": "gzip" if compress else None,
        "block_resolution": raster.zoom,
        "nodata": None if math.isnan(nodata) else nodata,
        "bands": bands,
        "block_width": raster.block_width,
        "block_height": raster.block_height,
    }
    return json.dumps(facts)


def _side_by_side(left: DataFrame, right: DataFrame, by: list[str]) -> DataFrame:
    """The columns of two frames that have one row per key each, by one grouping instead of a
    join, which without a real key would cross the frames."""
    both = left.unionByName(right, allowMissingColumns=True)
    held = [c for c in both.columns if c not in by]
    return both.groupBy(*by).agg(*[F.first(c, ignorenulls=True).alias(c) for c in held])


def _palette(band: Band):
    if band.colorinterp != "palette" or band.colortable is None:
        return None
    return {int(k): [int(c) for c in v] for k, v in band.colortable.items()}


def value_labels(text: Column) -> Column:
    """Labels given as JSON ``{value: label}`` or the word None."""
    return F.when(text != "None", F.from_json(text, "map<string, string>", {"mode": "FAILFAST"}))


def label_text(version: Column) -> Column:
    """A version as a table label: lower case, other signs replaced."""
    return F.regexp_replace(F.lower(version), "[^a-z0-9_-]", "_")


def default_table_name(path: Column, band: Column, suffix: Column) -> Column:
    base = F.split_part(F.element_at(F.split(path, "/"), -1), F.lit("."), F.lit(1))
    name = F.concat_ws("_", base, F.lit("band"), band.cast("string"), suffix)
    return F.regexp_replace(name, "[^a-zA-Z0-9_-]", "_")


# -- compatibility -------------------------------------------------------------


def differences(new: Column, old: Column) -> dict[str, Column]:
    """Per check, whether two parsed documents agree."""

    def kinds(doc):
        return F.transform(doc.bands, lambda b: F.struct(*[b[f].alias(f) for f in BAND_IDENTITY]))

    def same(field):
        return new[field].eqNullSafe(old[field])

    return {
        "same_resolution": same("block_resolution"),
        "same_nodata": same("nodata"),
        "same_block": same("block_width") & same("block_height"),
        "same_bands": kinds(new).eqNullSafe(kinds(old)),
        "same_compression": same("compression"),
    }


PROBLEMS = {
    "same_resolution": "another block resolution",
    "same_nodata": "another nodata value",
    "same_block": "another block width or height",
    "same_bands": "other bands",
    "same_compression": "another compression",
}


def check(pairs: DataFrame, new: str = "new", old: str = "old") -> DataFrame:
    """Rows of two documents with the outcome of every check and the first ``problem``, if any."""
    parsed = pairs.withColumns({"__n": parse(F.col(new)), "__o": parse(F.col(old))})
    out = parsed.withColumns(differences(F.col("__n"), F.col("__o"))).drop("__n", "__o")
    problem = F.coalesce(
        *[
            F.when(~F.col(c), F.lit(f"The table does not fit: it has {text}"))
            for c, text in PROBLEMS.items()
        ]
    )
    return out.withColumn("problem", problem)


# -- merging -------------------------------------------------------------------


def merge(
    documents: DataFrame, order: str, keys: list[str] | None = None, around: bool = False
) -> DataFrame:
    """Merge documents ``metadata`` (per key) into one, however many there are.

    ``around`` takes the smallest arc of longitudes around all extents, which may cross the
    antimeridian (its west is then greater than its east); otherwise they span from the smallest to
    the largest longitude.

    Extents grow, counts and sums add up, and moments follow from the sums of the documents that
    counted pixels. Only if none did, the mean is the mean of the means; then, and where the sums
    give no variance, the deviation is the root of the summed squares. So documents may be merged
    in any grouping, but for that mean of means: it is the same for all groupings only if at most
    one step takes it. Facts that are equal in all documents, and the descriptions of the bands, come
    from the last one by ``order``. Quantiles and most common values cannot be merged and become
    null.
    """
    keys = keys or []
    by = keys or ["__all"]
    docs = documents if keys else documents.withColumn("__all", F.lit(0))
    docs = docs.select(*by, F.col(order).alias("__order"), parse(F.col("metadata")).alias("d"))

    def last(field):
        return F.max_by(f"d.{field}", "__order").alias(field)

    top = docs.groupBy(*by).agg(
        *[
            last(f)
            for f in (
                "compression", "block_resolution", "minresolution", "maxresolution", "nodata",
                "block_width", "block_height", "pixel_resolution",
            )
        ],
        F.min(F.col("d.bounds")[0]).alias("west"),
        F.min(F.col("d.bounds")[1]).alias("south"),
        F.max(F.col("d.bounds")[2]).alias("east"),
        F.max(F.col("d.bounds")[3]).alias("north"),
        F.sum("d.num_blocks").alias("num_blocks"),
        F.sum("d.num_pixels").alias("num_pixels"),
        F.count("*").alias("__docs"),
    )
    if around:
        edges = docs.select(*by, F.col("d.bounds")[0].alias("west"), F.col("d.bounds")[2].alias("east"))
        top = _side_by_side(top.drop("west", "east"), enclosing_arc(edges, by), by)
    top = _tile_span(top)

    band = docs.select(*by, "__order", F.posexplode("d.bands").alias("position", "b"))
    s = "b.stats."
    counted = F.col(s + "count") > 0
    total, squares = (F.sum(F.when(counted, F.col(s + f))) for f in ("sum", "sum_squares"))
    n = F.sum(s + "count")
    bands = band.groupBy(*by, F.col("b.name").alias("name")).agg(
        F.max_by("position", "__order").alias("position"),
        F.count("*").alias("__seen"),
        *[
            F.max_by(f"b.{f}", "__order").alias(f)
            for f in ("type", "colorinterp", "nodata", "colortable", "valuelabels")
        ],
        F.min(s + "min").alias("min"),
        F.max(s + "max").alias("max"),
        F.coalesce(total, F.lit(0.0)).alias("sum"),
        F.coalesce(squares, F.lit(0.0)).alias("sum_squares"),
        n.alias("count"),
        F.avg(s + "mean").alias("__mean"),
        F.sqrt(F.sum(F.col(s + "stddev") * F.col(s + "stddev"))).alias("__deviation"),
        F.max(s + "version").alias("version"),
        F.max(s + "approximated_stats").alias("approximated_stats"),
    )
    no_sums = F.col("count") == 0
    mean = F.when(no_sums, F.col("__mean")).otherwise(F.col("sum") / F.col("count"))
    bands = bands.withColumn("mean", mean)
    variance = F.when(
        ~no_sums, F.col("sum_squares") / F.col("count") - F.col("mean") * F.col("mean")
    )
    bands = bands.withColumn(
        "stddev", F.when(variance >= 0, F.sqrt(variance)).otherwise(F.col("__deviation"))
    )
    stats = F.struct(
        "min", "max", "mean", "stddev", "sum", "sum_squares", "count",
        F.lit(None).cast("map<string, array<double>>").alias("quantiles"),
        F.lit(None).cast("map<string, bigint>").alias("top_values"),
        "version", "approximated_stats",
    ).alias("stats")
    entry = F.struct("type", "name", stats, "colorinterp", "nodata", "colortable", "valuelabels")
    key = F.struct("position", "name")
    lists = bands.groupBy(*by).agg(
        F.map_from_entries(F.collect_list(F.struct(key, entry))).alias("__bands"),
        F.min("__seen").alias("__seen"),
        F.max("__seen").alias("__most"),
    )
    joined = _side_by_side(top, lists, by)
    ordered = F.transform(F.sort_array(F.map_keys("__bands")), lambda i: F.element_at("__bands", i))
    complete = (F.col("__seen") == F.col("__docs")) & (F.col("__most") == F.col("__docs"))
    ordered = F.when(complete, ordered).otherwise(
        F.raise_error(F.lit("Cannot merge metadata: a band is missing from a document"))
    )
    bounds = F.array("west", "south", "east", "north")
    across = (F.col("west") + F.col("east")) / 2
    center = F.array(
        arc_middle(F.col("west"), F.col("east")) if around else across,
        (F.col("south") + F.col("north")) / 2,
        F.col("block_resolution").cast("double"),
    )
    whole = F.struct(
        "compression", "block_resolution", "minresolution", "maxresolution", "nodata",
        ordered.alias("bands"), bounds.alias("bounds"), center.alias("center"), "width", "height",
        "block_width", "block_height", "num_blocks", "num_pixels", "pixel_resolution",
    )
    return joined.select(*keys, to_document(whole).alias("metadata"))


def _tile_span(top: DataFrame) -> DataFrame:
    """Width and height from the tiles that hold the corners of the bounds, whole tiles each."""
    z = "block_resolution"
    # Fractions of a tile, so that bounds on an edge up to rounding count as on it.
    top = top.withColumns(
        {
            "__w": F.floor(_column_of(F.col("west"), F.col(z)) + EDGE_SLACK),
            "__e": F.ceil(_column_of(F.col("east"), F.col(z)) - EDGE_SLACK),
            "__s": F.ceil(_row_of(F.col("south"), F.col(z)) - EDGE_SLACK),
            "__n": F.floor(_row_of(F.col("north"), F.col(z)) + EDGE_SLACK),
        }
    )
    wrapped = F.when(F.col("east") < F.col("west"), F.pow(F.lit(2.0), F.col(z))).otherwise(0)
    wide = (F.col("__e") - F.col("__w") + wrapped).cast("long")
    return top.withColumns(
        {
            "width": wide * F.col("block_width"),
            "height": (F.col("__s") - F.col("__n")) * F.col("block_height"),
        }
    ).drop("__w", "__e", "__s", "__n")


def pixel_ends(document: str) -> list[Column]:
    """Columns ``end_x, end_y``: where a parsed document's raster ends, in pixels of the world."""
    d = F.col(document)
    first_x = F.floor(_column_of(d.bounds[0], d.block_resolution) + EDGE_SLACK)
    first_y = F.floor(_row_of(d.bounds[3], d.block_resolution) + EDGE_SLACK)
    return [
        (first_x * d.block_width + d.width).alias("end_x"),
        (first_y * d.block_height + d.height).alias("end_y"),
    ]


def _column_of(lon: Column, z: Column) -> Column:
    return F.pow(F.lit(2.0), z) * (lon / 360 + 0.5)


def _row_of(lat: Column, z: Column) -> Column:
    sin = F.sin(F.radians(lat))
    fraction = 0.5 - 0.25 / math.pi * F.log((1 + sin) / (1 - sin))
    return F.pow(F.lit(2.0), z) * fraction
