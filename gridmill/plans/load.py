"""The whole load of a raster: statistics, metadata, blocks, table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmill import __version__
from gridmill.functions.cells import with_tile
from gridmill.operators import stats, summaries
from gridmill.operators.arrays import block_ids, blocks_of_tiles
from gridmill.operators.metadata import document, identity
from gridmill.operators.overviews import overview_count
from gridmill.operators.stats import SAMPLE_SIZE
from gridmill.operators.tiling import blocks, decode, output_partitions, split_points
from gridmill.sources import tiff, tiff_source
from gridmill.sources.pixels import measured, pixels_of_tiles
from gridmill.sources.tables import MODES, BlockTable
from gridmill.spec import Raster, check_names


def load_raster(
    pixels: DataFrame,
    raster: Raster,
    table: BlockTable,
    mode: str = "error",
    load: str | None = None,
    exact_stats: bool = True,
    basic_stats: bool = False,
    compress: bool = False,
    compression_level: int = 6,
    chunk_size: int | None = None,
    parallelism: int | None = None,
    seed: int = 0,
    version: str = __version__,
    sample_size: int = SAMPLE_SIZE,
    summary: bool = False,
) -> dict:
    """Load a pixel table into a block table and report expected, written and empty blocks.

    ``summary`` keeps a summary of the values with the load, from which
    :func:`merged_statistics` takes quantiles and common values of the whole table. The refusal of an existing table and the compatibility check come before any row is written.
    """
    _admit(table, mode, raster, load, compress)
    raster = measured(pixels, raster)
    rows = blocks(
        pixels, raster, compress=compress, compression_level=compression_level, in_order=True,
        partitions=parallelism,
    )
    return _load(
        pixels, rows, raster, table, mode, load, exact_stats, basic_stats, compress, chunk_size,
        seed, version, sample_size, summary,
    )


def load_tiff(
    path: str,
    table: BlockTable,
    names: list[str] | None = None,
    mode: str = "error",
    load: str | None = None,
    exact_stats: bool = True,
    basic_stats: bool = False,
    compress: bool = False,
    compression_level: int = 6,
    chunk_size: int | None = None,
    parallelism: int | None = None,
    seed: int = 0,
    version: str = __version__,
    sample_size: int = SAMPLE_SIZE,
    band_numbers: list[int] | None = None,
    style=None,
    value_labels: dict[int, dict] | None = None,
    summary: bool = False,
    own_overviews: bool = False,
) -> dict:
    """Load the tiled TIFF files of a path as one raster. Base tiles are encoded as they are read.

    The files of a folder must agree in all but their extent; the raster spans them all.
    ``band_numbers`` (from 1) chooses bands, ``names`` names them, ``style`` renames the unnamed
    ones too, and ``value_labels`` gives labels by band number. With ``own_overviews`` the levels of
    the pyramid are the files' own reduced images, which may be averaged, not thinned base pixels.
    """
    spark = table.spark
    profile = tiff.common_profile(spark, path)
    raster = tiff.raster_of(profile, names, band_numbers, style, value_labels)
    _admit(table, mode, raster, load, compress)
    tiles = tiff.tiles(spark, path, raster, band_numbers)
    # The ranges of the output come from the list of tiles, so that no tile is read for them.
    parts = parallelism or output_partitions(spark, raster)
    listed = block_ids(tiff.tile_list(tiff.profiles(spark, path)), raster)
    splits = split_points(listed, raster, parts, rows=raster.tiles_wide * raster.tiles_high)
    levels = None
    if own_overviews and raster.levels:
        tiff_source.register(spark)
        numbers = band_numbers or range(1, profile.bands + 1)
        levels = spark.read.format("webmap_tiff").options(
            overviews="true", bands=",".join(map(str, numbers)), names=",".join(raster.names)
        )
        levels = levels.load(path).where(F.col("z") < raster.zoom)
    rows = blocks_of_tiles(
        tiles, raster, splits, levels, compress=compress, compression_level=compression_level
    )
    rows = rows.repartitionById(parts, "part").drop("part").sortWithinPartitions("block")
    return _load(
        pixels_of_tiles(tiles, raster), rows, raster, table, mode, load, exact_stats, basic_stats,
        compress, chunk_size, seed, version, sample_size, summary,
    )


def _admit(
    table: BlockTable, mode: str, raster: Raster, load: str | None, compress: bool
) -> None:
    """Refuse what can be refused before any pixel is read."""
    check_names(raster.names)
    if mode not in MODES:
        raise ValueError(f"Invalid write mode {mode}")
    filled = not table.is_empty()
    if filled and mode == "error":
        raise FileExistsError(f"Table {table.path} already exists and is not empty")
    if filled and mode == "append":
        table.check_fit(identity(raster, compress), load)


def _load(
    pixels, rows, raster, table, mode, load, exact, basic, compress, chunk_size, seed, version,
    sample_size, summary,
):
    row = document(pixels, raster, exact, basic, compress, seed, version, sample_size).first()
    kept = summaries.summarise(pixels, raster) if summary else None
    load = table.write(
        rows, row.metadata, mode, load, chunk_size, is_clustered=True, summary=kept
    )
    expected = raster.tiles_wide * raster.tiles_high + overview_count(raster)
    written = table.load_rows(load)
    return {"expected": expected, "written": written, "empty": expected - written}


def merged_statistics(table: BlockTable) -> None:
    """Fill the quantiles and most common values that merging left out, from the loads' summaries.

    Pixels that several loads have count once per load, as in the document's sums.
    """
    summary = table.summary()
    if summary is None:
        raise ValueError(f"A load of {table.path} was written without a summary")
    fields: dict[str, dict] = {}
    for r in stats.quantile_lists(summaries.quantiles(summary)).collect():
        fields[r["name"]] = {"quantiles": _by_text(r["quantiles"])}
    for r in summaries.top_values(summary).orderBy("name", "rank").collect():
        own = fields[r["name"]].setdefault("top_values", {})
        own[str(r["value"])] = r["count"]
    table.set_statistics(fields)


def recompute_statistics(table: BlockTable, raster: Raster, compressed: bool = False) -> None:
    """Exact statistics of all bands from the table's base tiles, into the table's document.

    Needs tiles that no two loads share (see ``BlockTable.compact``). Padding beyond a load's extent
    does not count, nor do pixels of tiles that were left out as empty. Pixels that a sparse pixel
    table lacked read as nodata: for such tables pass a raster that states it.
    """
    if not table.duplicates().isEmpty():
        raise ValueError(f"Loads of {table.path} share blocks; compact it first")
    rows = with_tile(table.loaded_rows(), "block").where(F.col("z") == raster.zoom)
    rows = rows.drop("z", "tile_x", "tile_y")
    pixels = decode(rows, raster, compressed, keep=("end_x", "end_y")).where(
        "(end_x IS NULL OR gx < end_x) AND (end_y IS NULL OR gy < end_y)"
    )
    records = stats.exact_records(pixels, raster)
    fields = {}
    for r in records.withColumn("top_values", F.map_entries("top_values")).collect():
        fields[r["name"]] = r.asDict() | {
            "quantiles": _by_text(r["quantiles"]),
            "top_values": r["top_values"] and {str(int(v)): n for v, n in r["top_values"]},
            "approximated_stats": False,
        }
        for other in ("name", "position"):
            del fields[r["name"]][other]
    table.set_statistics(fields)


def _by_text(lists: dict | None) -> dict | None:
    return lists and {str(k): v for k, v in sorted(lists.items())}
