"""Queries over written block tables: each writes the whole plane, then reads it back."""

from __future__ import annotations

import json
import uuid
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridmill.functions import cells
from gridmill.operators import stats
from gridmill.plans import fixtures as fx
from gridmill.plans import load
from gridmill.plans.documents import bounds_sql
from gridmill.plans.load import load_raster
from gridmill.plans.numbers import _values
from gridmill.plans.registry import query
from gridmill.plans.tiles import CELL, dense_sql, hex_sql
from gridmill.sources import pixels as px
from gridmill.sources.tables import BlockTable, CatalogTable, quote_name, run_sql
from gridmill.streaming.append import append_stream

RASTER = fx.plane(fx.B1, levels=3)


def loaded(spark, sf, **options) -> BlockTable:
    """The plane loaded into a new table."""
    table = BlockTable(spark, fx.scratch(spark))
    pixels = fx.staged(fx.grid(spark, sf).select("px", "py", "b1"))
    load_raster(pixels, RASTER, table, exact_stats=True, basic_stats=True, **options)
    return table


_B1 = _values("b1")
_STORED = f"SELECT DISTINCT gx // 64 AS tx, gy // 64 AS ty, z FROM v_levels"


@query(
    "metadata_read",
    sql=f"""
    SELECT {fx.ZOOM} AS block_resolution, {fx.ZOOM - 3} AS minresolution, width, height,
        width * height // 4096 AS num_blocks, 'b1' AS name, min(v) AS min, max(v) AS max,
        sum(v) AS sum, sum(v * v) AS sum_squares, count(*) AS count, 'gzip' AS compression
    FROM v_size, ({_B1}) GROUP BY ALL""",
)
def metadata_read(spark, sf):
    """The metadata row of a written table, parsed."""
    doc = loaded(spark, sf, compress=True).metadata_rows()
    b = F.col("bands")[0]
    return doc.select(
        "block_resolution", "minresolution", "width", "height", "num_blocks",
        b.getField("name").alias("name"),
        *[b.stats[c].alias(c) for c in ("min", "max", "sum", "sum_squares", "count")],
        "compression",
    )


@query(
    "get_records",
    sql=f"""
    SELECT * FROM (
        SELECT 0::BIGINT AS block, true AS has_metadata, CAST(NULL AS VARCHAR) AS b1
        UNION ALL
        SELECT {CELL} AS block, false AS has_metadata, {hex_sql()} AS b1
        FROM ({dense_sql("b1", levels=True)}) GROUP BY tx, ty, z)
    ORDER BY block LIMIT 10""",
)
def get_records(spark, sf):
    """The first ten rows of a written table."""
    rows = loaded(spark, sf).records(10, ordered=True)
    return rows.select(
        "block", F.col("metadata").isNotNull().alias("has_metadata"), F.hex("b1").alias("b1")
    )


@query(
    "describe",
    sql=f"""
    SELECT unnest([0, 1, 2])::INT AS position, unnest(['block', 'metadata', 'b1']) AS "column",
        unnest(['bigint', 'string', 'binary']) AS type, n + 1 AS rows,
        unnest([n + 1, 1, n]) AS non_null
    FROM (SELECT count(*) AS n FROM ({_STORED}))""",
)
def describe(spark, sf):
    """Columns, types and row counts of a written table."""
    return loaded(spark, sf).describe()


@query(
    "block_range_scan",
    sql=f"""
    SELECT {CELL} AS block, {hex_sql()} AS b1
    FROM ({dense_sql("b1", levels=True)}) WHERE z = {fx.ZOOM} GROUP BY tx, ty, z""",
)
def block_range_scan(spark, sf):
    """The base level of a clustered table, as a range of its sort column."""
    low, high = cells.zoom_range(fx.ZOOM)
    rows = loaded(spark, sf, compress=False).data()
    return rows.where(F.col("block").between(low, high)).select("block", F.hex("b1").alias("b1"))


@query(
    "sql_surface",
    sql=f"""
    SELECT {fx.ZOOM} - z AS level, count(*) AS blocks, count(*) * 4096 AS bytes
    FROM ({_STORED}) GROUP BY z""",
)
def sql_surface(spark, sf):
    """Plain SQL over a written table, with a frame and a value as parameters."""
    text = """
        SELECT CAST(:base - (shiftright(block, 52) & 31) AS INT) AS level, count(*) AS blocks,
            sum(length(b1)) AS bytes
        FROM {blocks} WHERE block <> 0 GROUP BY 1"""
    return run_sql(spark, text, {"blocks": loaded(spark, sf).read()}, base=fx.ZOOM)


@query(
    "append_result",
    sql=f"""
    SELECT (SELECT count(*) FROM ({_STORED} WHERE level = 0)) AS blocks, 2 AS loads,
        {bounds_sql(str(fx.TILE_X0), str(fx.TILE_Y0), f"{fx.TILE_X0} + 8",
                    f"{fx.TILE_Y0} + height / 64")},
        width, (height + 63) // 64 * 64 AS height, width * height AS num_pixels, min(v) AS min,
        max(v) AS max, round(avg(v), 6) AS mean, round(stddev_pop(v), 4) AS stddev, sum(v) AS sum,
        count(*) AS count, true AS no_quantiles
    FROM v_size, ({_B1}) GROUP BY ALL""",
)
def append_result(spark, sf):
    """The left half loaded, the right half appended: one table, merged metadata."""
    pixels = fx.staged(fx.grid(spark, sf).select("px", "py", "b1"))
    raster = fx.plane(fx.B1)
    height = pixels.agg(F.max("py") + 1).first()[0]
    half = fx.GRID_WIDTH // 2
    left = pixels.where(F.col("px") < half)
    right = pixels.where(F.col("px") >= half).withColumn("px", F.col("px") - half)
    table = BlockTable(spark, fx.scratch(spark))
    load_raster(left, raster.sized(half, height), table, load="left", exact_stats=True)
    moved = replace(raster, tile_x0=fx.TILE_X0 + half // fx.EDGE).sized(half, height)
    load_raster(right, moved, table, mode="append", load="right", exact_stats=True)
    b = F.col("bands")[0].stats
    counts = table.read().agg(F.count_if(F.col("block") != 0).alias("blocks"))
    return table.metadata_rows().select(
        counts.scalar().alias("blocks"),
        F.lit(2).alias("loads"),
        *[
            F.round(F.col("bounds")[i], 7).alias(n)
            for i, n in enumerate(("west", "south", "east", "north"))
        ],
        F.round(F.col("center")[0], 7).alias("center_lon"),
        F.round(F.col("center")[1], 7).alias("center_lat"),
        "width", "height", "num_pixels", b["min"].alias("min"), b["max"].alias("max"),
        F.round(b["mean"], 6).alias("mean"), F.round(b["stddev"], 4).alias("stddev"),
        b["sum"].alias("sum"), b["count"].alias("count"),
        b["quantiles"].isNull().alias("no_quantiles"),
    )


def _two_halves(spark, sf, **options):
    """The left half of the plane loaded and the right half appended."""
    pixels = fx.staged(fx.grid(spark, sf).select("px", "py", "b1"))
    raster = fx.plane(fx.B1)
    height = pixels.agg(F.max("py") + 1).first()[0]
    half = fx.GRID_WIDTH // 2
    right = pixels.where(F.col("px") >= half).withColumn("px", F.col("px") - half)
    table = BlockTable(spark, fx.scratch(spark))
    options |= {"exact_stats": True, "basic_stats": True}
    left = raster.sized(half, height)
    load_raster(pixels.where(F.col("px") < half), left, table, load="left", **options)
    moved = replace(raster, tile_x0=fx.TILE_X0 + half // fx.EDGE).sized(half, height)
    load_raster(right, moved, table, mode="append", load="right", **options)
    return table, raster


_HALVES = f"""
    WITH b AS ({_B1}), ordered AS (SELECT list_sort(list(v)) AS l, count(*) AS n FROM b)
    SELECT {{moments}}, round(sum(l[1 + CAST(floor((n - 1) * (j::DOUBLE / i)) AS BIGINT)]), 4)
            AS quantile_sum,
        (SELECT count(*) FROM (SELECT v FROM b GROUP BY v)) AS top_size,
        (SELECT CAST(v AS BIGINT) FROM b GROUP BY v ORDER BY count(*) DESC, v LIMIT 1) AS top
    FROM ordered, (SELECT i, unnest(range(1, i)) AS j FROM (SELECT unnest(range(3, 20)) AS i))"""


def _filled(table, *more):
    b = F.col("bands")[0].stats
    lists = F.flatten(F.map_values(b["quantiles"]))
    total = F.aggregate(lists, F.lit(0.0), lambda a, v: a + v, lambda a: F.round(a, 4))
    return table.metadata_rows().select(
        *more,
        total.alias("quantile_sum"),
        F.size(b["top_values"]).cast("long").alias("top_size"),
        F.map_keys(b["top_values"])[0].cast("long").alias("top"),
    )


@query("merged_statistics", sql=_HALVES.format(moments="2 AS loads"))
def merged_statistics(spark, sf):
    """Quantiles and common values of a table of two loads, from the loads' summaries."""
    table, _ = _two_halves(spark, sf, summary=True)
    load.merged_statistics(table)
    return _filled(table, F.lit(2).alias("loads"))


@query(
    "recomputed_statistics",
    sql=_HALVES.format(
        moments="""(SELECT count(*) FROM b) AS count, (SELECT sum(v) FROM b) AS sum,
        (SELECT min(v) FROM b) AS min, (SELECT round(stddev_pop(v), 6) FROM b) AS stddev"""
    ),
)
def recomputed_statistics(spark, sf):
    """Exact statistics of a table of two loads, from its tiles."""
    table, raster = _two_halves(spark, sf)
    load.recompute_statistics(table, replace(raster, nodata=0))
    b = F.col("bands")[0].stats
    return _filled(
        table, b["count"].alias("count"), b["sum"].alias("sum"), b["min"].alias("min"),
        F.round(b["stddev"], 6).alias("stddev"),
    )


@query(
    "stream_append",
    sql=f"""
    SELECT (SELECT count(*) FROM ({_STORED} WHERE level = 0)) AS blocks,
        {bounds_sql(str(fx.TILE_X0), str(fx.TILE_Y0), f"{fx.TILE_X0} + 8",
                    f"{fx.TILE_Y0} + height / 64")},
        min(v) AS min, max(v) AS max, round(avg(v), 6) AS mean, round(stddev_pop(v), 4) AS stddev,
        sum(v) AS sum, count(*) AS count
    FROM v_size, ({_B1}) GROUP BY ALL""",
)
def stream_append(spark, sf):
    """The plane arriving as files of whole tile rows, appended by a stream."""
    folder = fx.scratch(spark)
    pixels = fx.grid(spark, sf).select("px", "py", "b1")
    arriving = pixels.withColumn("strip", F.shiftright("py", 6))
    arriving.repartitionByRange(4, "strip").drop("strip").write.parquet(f"{folder}/arriving")
    source = (
        spark.readStream.schema(pixels.schema)
        .option("maxFilesPerTrigger", 1)
        .parquet(f"{folder}/arriving")
    )
    table = BlockTable(spark, f"{folder}/table")
    stream = append_stream(
        source, fx.plane(fx.B1), table, f"{folder}/progress", exact_stats=True, basic_stats=True
    )
    stream.awaitTermination()
    b = F.col("bands")[0].stats
    counts = table.data().agg(F.count("*").alias("blocks"))
    return table.metadata_rows().select(
        counts.scalar().alias("blocks"),
        *[
            F.round(F.col("bounds")[i], 7).alias(n)
            for i, n in enumerate(("west", "south", "east", "north"))
        ],
        F.round(F.col("center")[0], 7).alias("center_lon"),
        F.round(F.col("center")[1], 7).alias("center_lat"),
        b["min"].alias("min"), b["max"].alias("max"), F.round(b["mean"], 6).alias("mean"),
        F.round(b["stddev"], 4).alias("stddev"), b["sum"].alias("sum"), b["count"].alias("count"),
    )


@query(
    "write_modes",
    sql=f"""
    SELECT step, CAST(blocks * n AS BIGINT) AS blocks,
        CASE WHEN n > 1 THEN blocks ELSE 0 END AS duplicates, CAST(pixels * n AS BIGINT) AS num_pixels,
        total * n AS sum, refused
    FROM (SELECT unnest(['error', 'append', 'append again', 'overwrite']) AS step,
            unnest([1, 2, 2, 1]) AS n, unnest([true, false, false, false]) AS refused),
        (SELECT count(*) AS blocks FROM ({_STORED} WHERE level = 0)),
        (SELECT width * height AS pixels FROM v_size), (SELECT sum(v) AS total FROM ({_B1}))""",
)
def write_modes(spark, sf):
    """A table after each write mode: refused, appended, the same load again, overwritten."""
    pixels = fx.staged(fx.grid(spark, sf).select("px", "py", "b1"))
    raster = fx.plane(fx.B1)
    table = BlockTable(spark, fx.scratch(spark))
    load_raster(pixels, raster, table, load="first", basic_stats=True)
    try:
        load_raster(pixels, raster, table, basic_stats=True)
        refused = False
    except FileExistsError:
        refused = True

    def state(step: str, refused: bool = False):
        copies = table.duplicates().agg(F.count("*").alias("duplicates"))
        blocks = table.data().agg(F.count("*").alias("blocks"))
        doc = table.metadata_rows().select(
            F.lit(step).alias("step"),
            "num_pixels",
            F.col("bands")[0].stats["sum"].alias("sum"),
            F.lit(refused).alias("refused"),
        )
        return doc.select(
            "step", blocks.scalar().alias("blocks"), copies.scalar().alias("duplicates"),
            "num_pixels", "sum", "refused",
        )

    states = [state("error", refused)]
    for step, mode, load in (
        ("append", "append", "second"),
        ("append again", "append", "second"),
        ("overwrite", "overwrite", "third"),
    ):
        load_raster(pixels, raster, table, mode=mode, load=load, basic_stats=True)
        states.append(state(step))
    return reduce(DataFrame.unionByName, states)


@query(
    "insert_rows",
    sql="""
    SELECT CAST(n_nationkey + 1 AS BIGINT) AS block, hex(encode(n_name)) AS b1 FROM nation""",
)
def insert_rows(spark, sf):
    """The nations' names given as rows by hand, appended to a written table and read back."""
    table = loaded(spark, sf)
    given = fx.table(spark, sf, "nation").collect()  # fixed at 25 rows
    table.insert([{"block": r["n_nationkey"] + 1, "b1": r["n_name"].encode()} for r in given])
    rows = table.data().where(F.col("block") < cells.zoom_range(0)[0])
    return rows.select("block", F.hex("b1").alias("b1"))


@query(
    "exact_or_sampled",
    sql=f"""
    SELECT mode, min(v) AS min, max(v) AS max, round(avg(v), 6) AS mean,
        CASE mode WHEN 'exact' THEN count(*) ELSE least(count(*), 1000) END AS count,
        mode = 'sampled' AS approximated_stats
    FROM ({_B1}), (SELECT unnest(['exact', 'sampled']) AS mode) GROUP BY mode""",
)
def exact_or_sampled(spark, sf):
    """The record of one raster in either mode: the same moments, a full or a sampled count."""
    pixels = fx.staged(fx.grid(spark, sf).select("px", "py", "b1"))
    raster = px.measured(pixels, RASTER)
    records = [
        stats.band_stats(pixels, raster, exact=exact, seed=fx.SEED).withColumn("mode", F.lit(mode))
        for mode, exact in (("exact", True), ("sampled", False))
    ]
    return reduce(DataFrame.unionByName, records).select(
        "mode", "min", "max", F.round("mean", 6).alias("mean"), "count", "approximated_stats"
    )


@query(
    "catalog_roundtrip",
    sql=f"""
    SELECT blocks, width, height, width * height AS num_pixels, sum, count, bytes, '1_0_x' AS label
    FROM v_size, (SELECT count(*) AS blocks, count(*) * 4096 AS bytes FROM ({_STORED} WHERE level = 0)),
        (SELECT sum(v) AS sum, count(*) AS count FROM ({_B1}))""",
)
def catalog_roundtrip(spark, sf):
    """The two halves of the plane loaded into a table of the catalog, read back by its name."""
    name = f"gridmill_{uuid.uuid4().hex}"
    table = CatalogTable(spark, name)
    pixels = fx.staged(fx.grid(spark, sf).select("px", "py", "b1"))
    raster = px.measured(pixels, fx.plane(fx.B1))
    half = fx.GRID_WIDTH // 2
    left = raster.sized(half, raster.height)
    right = replace(left, tile_x0=fx.TILE_X0 + half // fx.EDGE)
    moved = pixels.where(F.col("px") >= half).withColumn("px", F.col("px") - half)
    load_raster(pixels.where(F.col("px") < half), left, table, basic_stats=True, version="1.0+X")
    load_raster(moved, right, table, mode="append", basic_stats=True, version="1.0+X")
    rows = run_sql(
        spark, "SELECT count(*) AS blocks, sum(length(b1)) AS bytes FROM {t}", {"t": table.data()}
    )
    doc = table.metadata_rows()
    return doc.select(
        rows.select("blocks").scalar().alias("blocks"),
        "width",
        F.lit(raster.height).alias("height"),
        F.lit(table.metadata()["num_pixels"]).alias("num_pixels"),
        F.col("bands")[0].stats["sum"].alias("sum"),
        F.col("bands")[0].stats["count"].alias("count"),
        rows.select("bytes").scalar().alias("bytes"),
        F.lit(table.properties()["version"]).alias("label"),
    )


@query(
    "stream_tiles",
    sql=f"""
    SELECT {CELL} AS block, {hex_sql()} AS b1
    FROM ({dense_sql("b1", levels=True)}) GROUP BY tx, ty, z""",
)
def stream_tiles(spark, sf):
    """Pixels dealt at random over files and appended by a stream: whole tiles at all levels."""
    folder = fx.scratch(spark)
    pixels = fx.grid(spark, sf).select("px", "py", "b1")
    pixels.repartition(3, F.xxhash64("px", "py")).write.parquet(f"{folder}/arriving")
    source = (
        spark.readStream.schema(pixels.schema)
        .option("maxFilesPerTrigger", 1)
        .parquet(f"{folder}/arriving")
    )
    table = BlockTable(spark, f"{folder}/table")
    append_stream(
        source, RASTER, table, f"{folder}/progress", basic_stats=True
    ).awaitTermination()
    return table.data().select("block", F.hex("b1").alias("b1"))


@query(
    "drop_and_vacuum",
    sql=f"""
    SELECT step, n FROM (SELECT count(*) AS blocks FROM ({_STORED})),
        LATERAL (VALUES ('blocks', blocks), ('after vacuum', blocks), ('folders before', 2),
            ('folders after', 1), ('exists after drop', 0)) AS t(step, n)""",
)
def drop_and_vacuum(spark, sf):
    """A table overwritten, cleaned up and dropped, with what is left after each step."""
    table = loaded(spark, sf)
    rows = table.data()
    blocks = rows.count()
    table.write(rows, json.dumps(table.metadata()), "overwrite")

    def folders() -> int:
        fs, root = table._fs(f"{table.path}/data")
        return len(fs.listStatus(root))

    before = folders()
    table.vacuum()
    steps = [("blocks", blocks), ("after vacuum", table.data().count())]
    steps += [("folders before", before), ("folders after", folders())]
    table.drop()
    steps.append(("exists after drop", int(table.exists())))
    return spark.createDataFrame(steps, "step string, n long")


@query(
    "write_parallelism",
    sql=f"""
    SELECT parts, parts AS files, (SELECT count(*) FROM ({_STORED})) AS blocks, 0 AS overlaps
    FROM (SELECT unnest([1, 4]) AS parts)""",
)
def write_parallelism(spark, sf):
    """Loads written by one and by four tasks: files, and files whose blocks overlap."""
    found = []
    for parts in (1, 4):
        files = (
            loaded(spark, sf, parallelism=parts)
            .data()
            .groupBy(F.input_file_name().alias("file"))
            .agg(F.min("block").alias("lo"), F.max("block").alias("hi"), F.count("*").alias("n"))
        )
        last = F.max("hi").over(Window.orderBy("lo").rowsBetween(Window.unboundedPreceding, -1))
        # One row per file.
        found.append(
            files.withColumn("last", last).agg(
                F.lit(parts).alias("parts"),
                F.count("*").cast("int").alias("files"),
                F.sum("n").alias("blocks"),
                F.count_if(F.col("lo") <= F.col("last")).cast("int").alias("overlaps"),
            )
        )
    return reduce(DataFrame.unionByName, found)


@query(
    "quoted_names",
    sql="""
    SELECT n_name AS nation, count(c_custkey) AS customers FROM nation
    LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY n_name""",
)
def quoted_names(spark, sf):
    """Views whose names hold blanks, signs and back-ticks, read by plain SQL."""
    nations = fx.table(spark, sf, "nation").select("n_nationkey", "n_name").collect()  # 25 rows
    customers = fx.table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    mark = uuid.uuid4().hex
    parts = []
    for n in nations:
        view = f"of `{n['n_name']}` -- 'x' {mark}"
        customers.where(F.col("c_nationkey") == n["n_nationkey"]).createOrReplaceTempView(
            quote_name(view)
        )
        text = f"SELECT :name AS nation, count(*) AS customers FROM {quote_name(view)}"
        parts.append(run_sql(spark, text, name=n["n_name"]))
    return reduce(DataFrame.unionByName, parts)
