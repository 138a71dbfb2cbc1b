"""Queries over metadata documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridmill.functions import geo
from gridmill.functions.nodata import effective_nodata, nodata_text
from gridmill.operators import metadata, stats
from gridmill.plans import fixtures as fx
from gridmill.plans.masks import _DEFAULT_TEXTS, _DEFAULTS
from gridmill.plans.numbers import _values
from gridmill.plans.registry import query
from gridmill.spec import Band

LABELLED = Band("b1", colorinterp="palette", colortable={1: (255, 0, 0, 255), 2: (0, 9, 0, 255)})
DOCUMENT = fx.plane(LABELLED, Band("b2", valuelabels={"0": "none"}), nodata=0, levels=3)

_B = "d.bands"


def shown(documents, *keys: str):
    """A parsed document as one row per band, with the document's own facts repeated."""
    parsed = documents.select(*keys, metadata.parse(F.col("metadata")).alias("d"))
    bands = parsed.select(*keys, "d", F.explode("d.bands").alias("b"))
    return bands.select(
        *keys,
        "d.compression", "d.block_resolution", "d.minresolution", "d.maxresolution", "d.nodata",
        "d.width", "d.height", "d.num_blocks", "d.num_pixels", "d.pixel_resolution",
        *[
            F.round(F.col("d.bounds")[i], 7).alias(n)
            for i, n in enumerate(("west", "south", "east", "north"))
        ],
        F.round(F.col("d.center")[0], 7).alias("center_lon"),
        F.round(F.col("d.center")[1], 7).alias("center_lat"),
        F.col("b.name").alias("name"), F.col("b.type").alias("type"),
        F.col("b.nodata").alias("band_nodata"),
        *[
            F.round(f"b.stats.{c}", 6).alias(c)
            for c in ("min", "max", "mean", "sum", "sum_squares")
        ],
        F.round("b.stats.stddev", 4).alias("stddev"),
        F.col("b.stats.count").alias("count"),
    )


def bounds_sql(x0: str, y0: str, x1: str, y1: str) -> str:
    w, e, n, s = fx.lon_of(x0), fx.lon_of(x1), fx.lat_of(y0), fx.lat_of(y1)
    return f"""round({w}, 7) AS west, round({s}, 7) AS south, round({e}, 7) AS east,
        round({n}, 7) AS north, round(({w} + {e}) / 2, 7) AS center_lon,
        round(({s} + {n}) / 2, 7) AS center_lat"""


_STATS_SQL = """min(v) AS min, max(v) AS max, round(avg(v), 6) AS mean, sum(v) AS sum,
    sum(v * v) AS sum_squares, round(stddev_pop(v), 4) AS stddev, count(*) AS count"""


@query(
    "metadata_doc",
    sql=f"""
    SELECT CAST(NULL AS VARCHAR) AS compression, {fx.ZOOM} AS block_resolution,
        {fx.ZOOM - 3} AS minresolution, {fx.ZOOM} AS maxresolution, 0.0::DOUBLE AS nodata,
        width, height, width * height // 4096 AS num_blocks, width * height AS num_pixels,
        24 AS pixel_resolution,
        {bounds_sql(str(fx.TILE_X0), str(fx.TILE_Y0), f"{fx.TILE_X0} + width / 64",
                    f"{fx.TILE_Y0} + height / 64")},
        s.*, 'uint8' AS type, '0.0' AS band_nodata, top, CASE name WHEN 'b1' THEN 'palette' END
            AS colorinterp,
        CASE name WHEN 'b1' THEN '[255,0,0,255]' END AS colour_of_1,
        CASE name WHEN 'b2' THEN 'none' END AS label_of_0, 17 AS quantile_groups
    FROM v_size, (SELECT name, {_STATS_SQL} FROM ({_values("b1", "b2")}) GROUP BY name) s
    JOIN (SELECT name, arg_max(CAST(v AS VARCHAR), n) AS top FROM
        (SELECT name, CAST(v AS BIGINT) AS v, count(*) AS n
            FROM ({_values("b1", "b2")}) GROUP BY 1, 2)
        GROUP BY name) USING (name)""",
)
def metadata_doc(spark, sf):
    """The document of a raster with exact statistics, read back field by field."""
    doc = metadata.document(fx.grid(spark, sf), DOCUMENT, exact=True)
    bands = F.explode(metadata.parse(F.col("metadata")).bands).alias("b")
    extra = doc.select(bands).select(
        F.col("b.name").alias("name"),
        "b.colorinterp",
        F.to_json(F.try_element_at("b.colortable", F.lit("1"))).alias("colour_of_1"),
        F.try_element_at("b.valuelabels", F.lit("0")).alias("label_of_0"),
        F.size("b.stats.quantiles").alias("quantile_groups"),
        F.element_at(F.map_keys("b.stats.top_values"), 1).alias("top"),
    )
    return shown(doc).join(extra, "name")


TILE_BANDS = fx.plane(fx.B1, Band("b2"), nodata=0)


def tile_documents(spark, sf):
    """One document per tile, as if every tile had been loaded apart."""
    pixels = fx.grid(spark, sf).withColumns(
        {"tx": F.shiftright("px", 6), "ty": F.shiftright("py", 6)}
    )
    record = stats.moments(pixels, TILE_BANDS, ["tx", "ty"]).withColumns(
        {
            "quantiles": F.lit(None).cast("map<int, array<double>>"),
            "top_values": F.lit(None).cast("map<bigint, bigint>"),
            "version": F.lit("0.1.0"),
            "approximated_stats": F.lit(False),
        }
    )
    places = record.where("position = 0").select(
        "tx",
        "ty",
        (fx.TILE_X0 + F.col("tx")).alias("tile_x0"),
        (fx.TILE_Y0 + F.col("ty")).alias("tile_y0"),
        F.lit(fx.EDGE).alias("width"),
        F.lit(fx.EDGE).alias("height"),
    )
    return metadata.documents(record, places, TILE_BANDS, ["tx", "ty"])


@query(
    "metadata_merge",
    sql=f"""
    SELECT CAST(NULL AS VARCHAR) AS compression, {fx.ZOOM} AS block_resolution,
        {fx.ZOOM} AS minresolution, {fx.ZOOM} AS maxresolution, 0.0::DOUBLE AS nodata,
        (x1 - x0) * 64 AS width, (y1 - y0) * 64 AS height, n AS num_blocks, n * 4096 AS num_pixels,
        24 AS pixel_resolution, {bounds_sql("x0", "y0", "x1", "y1")}, s.*, 'uint8' AS type,
        '0.0' AS band_nodata
    FROM (SELECT min(px // 64) + {fx.TILE_X0} AS x0, min(py // 64) + {fx.TILE_Y0} AS y0,
            max(px // 64) + 1 + {fx.TILE_X0} AS x1, max(py // 64) + 1 + {fx.TILE_Y0} AS y1,
            count(DISTINCT (px // 64, py // 64)) AS n FROM v_grid),
        (SELECT name, {_STATS_SQL} FROM ({_values("b2")} UNION ALL
            SELECT 'b1' AS name, CAST(b1 AS DOUBLE) AS v, * FROM v_gappy WHERE b1 <> 0)
        GROUP BY name) s""",
)
def metadata_merge(spark, sf):
    """Documents of all tiles merged into one: the statistics of the whole."""
    docs = tile_documents(spark, sf).withColumn("load", F.struct("ty", "tx"))
    return shown(metadata.merge(docs, "load"))


@query(
    "metadata_merge_by_strip",
    sql=f"""
    SELECT strip, CAST(NULL AS VARCHAR) AS compression, {fx.ZOOM} AS block_resolution,
        {fx.ZOOM} AS minresolution, {fx.ZOOM} AS maxresolution, 0.0::DOUBLE AS nodata,
        (x1 - x0) * 64 AS width, 64::BIGINT AS height, n AS num_blocks, n * 4096 AS num_pixels,
        24 AS pixel_resolution,
        {bounds_sql("x0", f"strip + {fx.TILE_Y0}", "x1", f"strip + 1 + {fx.TILE_Y0}")},
        s.* EXCLUDE (strip), 'uint8' AS type, '0.0' AS band_nodata
    FROM (SELECT py // 64 AS strip, min(px // 64) + {fx.TILE_X0} AS x0,
            max(px // 64) + 1 + {fx.TILE_X0} AS x1, count(DISTINCT px // 64) AS n
        FROM v_grid GROUP BY 1)
    JOIN (SELECT py // 64 AS strip, name, {_STATS_SQL} FROM ({_values("b2")} UNION ALL
            SELECT 'b1' AS name, CAST(b1 AS DOUBLE) AS v, * FROM v_gappy WHERE b1 <> 0)
        GROUP BY ALL) s USING (strip)""",
)
def metadata_merge_by_strip(spark, sf):
    """The same, merged per row of tiles: many merges at once."""
    docs = tile_documents(spark, sf).withColumnRenamed("ty", "strip")
    return shown(metadata.merge(docs, "tx", ["strip"]), "strip")


_R = "CAST(floor(max_zoom - round(log2(edge / 256 * (edge / 256)) / 2, 9)) AS INT)"


@query(
    "append_check",
    sql=f"""
    WITH docs AS (SELECT raster, min(r) AS r, max(nodata) FILTER (band = 1) AS nodata,
            max(edge) AS edge, list((dtype, 'band_' || band, label) ORDER BY band) AS bands
        FROM (SELECT *, {_R} AS r,
            CASE WHEN NOT isnan(nd) THEN nd END AS nodata,
            CASE WHEN colorinterp = 'alpha' THEN '0' WHEN isnan(coalesce(ds_nodata, band_nodata))
                THEN 'nan' ELSE coalesce(CAST(coalesce(ds_nodata, band_nodata) AS VARCHAR),
                {_DEFAULT_TEXTS}) END AS label
            FROM (SELECT *, coalesce(ds_nodata, band_nodata, {_DEFAULTS}) AS nd FROM v_catalog))
        GROUP BY raster),
    checks AS (SELECT n.raster, n.r = o.r AS same_resolution,
            n.nodata IS NOT DISTINCT FROM o.nodata AS same_nodata, n.edge = o.edge AS same_block,
            n.bands = o.bands AS same_bands, true AS same_compression
        FROM docs n JOIN docs o ON n.raster = o.raster + 44)
    SELECT *, CASE WHEN NOT same_resolution THEN 'resolution' WHEN NOT same_nodata THEN 'nodata'
        WHEN NOT same_block THEN 'block' WHEN NOT same_bands THEN 'bands' ELSE 'none' END AS problem
    FROM checks""",
)
def append_check(spark, sf):
    """Rasters of a catalogue checked against the one 44 places before."""
    args = F.col("ds_nodata"), F.col("band_nodata"), F.col("dtype")
    edge = F.col("edge")
    bands = fx.catalog(spark, sf).withColumns(
        {
            "r": geo.block_resolution(F.col("max_zoom"), edge, edge),
            "nodata": metadata.json_nodata(effective_nodata(*args)),
            "label": nodata_text(*args, F.col("colorinterp")),
        }
    )
    entry = F.struct(
        "band",
        F.col("dtype").alias("type"),
        F.concat(F.lit("band_"), F.col("band")).alias("name"),
        F.col("label").alias("nodata"),
    )
    docs = bands.groupBy("raster").agg(
        F.min("r").alias("block_resolution"),
        F.max(F.when(F.col("band") == 1, F.col("nodata"))).alias("nodata"),
        F.max("edge").alias("block_width"),
        F.max("edge").alias("block_height"),
        F.sort_array(F.collect_list(entry)).alias("bands"),
    )
    whole = F.struct("block_resolution", "nodata", "block_width", "block_height", "bands")
    new = docs.select("raster", metadata.to_document(whole).alias("new"))
    old = new.select((F.col("raster") + 44).alias("raster"), F.col("new").alias("old"))
    checked = metadata.check(new.join(old, "raster"))
    text = F.coalesce("problem", F.lit("none"))
    word = F.regexp_extract(text, r"(resolution|nodata|block|bands|none)", 1)
    first = F.when(text.contains("resolution"), F.lit("resolution")).otherwise(word)
    return checked.select(
        "raster", "same_resolution", "same_nodata", "same_block", "same_bands",
        "same_compression", first.alias("problem"),
    )


@query(
    "color_table",
    sql="""
    SELECT raster, band, colorinterp, CASE WHEN colorinterp = 'palette' THEN
        '{"0":[0,0,0,255],"' || levels + 1 || '":[' || width % 256 || ',' || height % 256 || ','
        || max_zoom || ',255]}' END AS colortable
    FROM v_catalog""",
)
def color_table(spark, sf):
    """Colour tables, only where the band is a palette."""

    def rgba(*parts):
        return F.array(*[F.lit(p).cast("int") if isinstance(p, int) else p for p in parts])

    table = F.create_map(
        F.lit(0),
        rgba(0, 0, 0, 255),
        F.col("levels") + 1,
        rgba(F.col("width") % 256, F.col("height") % 256, F.col("max_zoom"), 255),
    )
    return fx.catalog(spark, sf).select(
        "raster",
        "band",
        "colorinterp",
        F.to_json(metadata.color_table(F.col("colorinterp"), table)).alias("colortable"),
    )


@query(
    "value_labels",
    sql=f"""
    SELECT t.name, CAST(v AS BIGINT) AS value, n AS count, n_name AS label
    FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY n DESC, v) AS rank
        FROM (SELECT name, v, count(*) AS n FROM ({_values("b1", "b2", "a1")}) GROUP BY name, v)) t
    LEFT JOIN nation ON t.v = n_nationkey AND t.name = 'b1'
    WHERE rank <= 100""",
)
def value_labels(spark, sf):
    """Most common values with the labels that a band's JSON gives them."""
    entries = F.collect_list(F.struct(F.col("n_nationkey").cast("string"), "n_name"))
    text = F.to_json(F.map_from_entries(entries))
    given = fx.table(spark, sf, "nation").agg(text.alias("b1"), F.lit("None").alias("b2"))
    texts = F.explode(F.create_map(F.lit("b1"), "b1", F.lit("b2"), "b2")).alias("name", "text")
    entry = F.explode(metadata.value_labels(F.col("text"))).alias("key", "label")
    labels = given.select(texts).select("name", entry)
    labels = labels.select("name", F.col("key").cast("long").alias("value"), "label")
    raster = fx.plane(fx.B1, Band("b2", nodata=0), Band("a1"))
    tops = stats.top_values(fx.grid(spark, sf), raster)
    return tops.join(labels, ["name", "value"], "left").select("name", "value", "count", "label")
