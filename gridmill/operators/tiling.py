"""Pixels to tiles and back.

Tiles are assembled with one shuffle: pixels of the base and of every pyramid level are packed per
cell, sent to the partition of their cell and sorted by it, and each task fills dense arrays batch
by batch. A task holds a bounded number of pixels and tiles at a time, however many it is sent.
"""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from gridmill.functions import codec
from gridmill.functions.cells import with_cell, with_tile
from gridmill.functions.nodata import filled
from gridmill.scratch import scratch
from gridmill.spec import Raster, item_size

# Cells a task fills at once; bounds its memory when pixels are sparse.
DENSE_CELLS = 1 << 22
# Pixels a task packs at once before the shuffle.
PACK_ROWS = 1 << 19
# Cells, in bytes, of an output partition, and sampled ids per partition to find its range.
PARTITION_BYTES = 64 << 20
SPLIT_SAMPLES = 1000
# Bits of Spark's increasing ids that number the rows of a partition.
PLACE_BITS = 33


# -- pixel coordinates -------------------------------------------------------


def global_x(raster: Raster) -> Column:
    return F.col("px").cast("long") + raster.tile_x0 * raster.block_width


def global_y(raster: Raster) -> Column:
    return F.col("py").cast("long") + raster.tile_y0 * raster.block_height


def pixel_level(raster: Raster) -> Column:
    """The pyramid level that takes this pixel, if any.

    Level k keeps the pixel at offset 2**(k-1) of each 2**k square. That is a pixel whose two
    global coordinates both end in exactly k-1 zero bits, so no pixel serves two levels.
    """
    x, y = global_x(raster), global_y(raster)
    low = x.bitwiseAND(-x)
    pick = reduce(
        lambda acc, k: acc.when(low == 1 << (k - 1), F.lit(k)),
        range(2, raster.levels + 1),
        F.when(low == 1, F.lit(1)),
    )
    return F.when(low == y.bitwiseAND(-y), pick)


def on_levels(pixels: DataFrame, raster: Raster, base: bool = True, pyramid: bool = True):
    """Pixels with their level and their global coordinates ``gx, gy`` at that level."""
    level = pixel_level(raster) if raster.levels else F.lit(None).cast("int")
    if base and pyramid and raster.levels:
        both = F.array(F.lit(0), level)
        out = pixels.withColumn(
            "level", F.explode(F.when(level.isNull(), F.array(F.lit(0))).otherwise(both))
        )
    elif base:
        return pixels.withColumns(
            {"level": F.lit(0), "gx": global_x(raster), "gy": global_y(raster)}
        )
    else:
        out = pixels.withColumn("level", level).where(F.col("level").isNotNull())
    shift = F.col("level")
    return out.withColumns(
        {
            "gx": F.call_function("shiftright", global_x(raster), shift),
            "gy": F.call_function("shiftright", global_y(raster), shift),
        }
    )


def with_position(pixels: DataFrame, raster: Raster) -> DataFrame:
    """Add ``tile_x, tile_y, z`` and the row-major position ``pos`` inside the tile."""
    bw, bh = raster.block_width, raster.block_height
    return pixels.withColumns(
        {
            "tile_x": F.floor(F.col("gx") / bw) if bw & (bw - 1) else _div(F.col("gx"), bw),
            "tile_y": F.floor(F.col("gy") / bh) if bh & (bh - 1) else _div(F.col("gy"), bh),
            "z": raster.zoom - F.col("level"),
            "pos": (F.pmod("gy", F.lit(bh)) * bw + F.pmod("gx", F.lit(bw))).cast("int"),
        }
    )


def _div(value: Column, edge: int) -> Column:
    return F.shiftright(value, edge.bit_length() - 1)


def tile_pixels(pixels: DataFrame, raster: Raster, base=True, pyramid=True) -> DataFrame:
    """Rows ``block, pos, <bands>``, bands filled, for the base and the pyramid levels."""
    bands = {n: filled(raster, n) for n in raster.names}
    out = with_position(on_levels(pixels, raster, base, pyramid), raster)
    out = out.select("tile_x", "tile_y", "z", "pos", *[c.alias(n) for n, c in bands.items()])
    return with_cell(out, "tile_x", "tile_y", "z").select("block", "pos", *raster.names)


# -- grids of blocks ---------------------------------------------------------


def block_grid(spark: SparkSession, raster: Raster) -> DataFrame:
    """Every base window: its tile, its cell and its pixel window."""
    wide, high = raster.tiles_wide, raster.tiles_high
    bw, bh = raster.block_width, raster.block_height
    tx, ty = F.col("id") % wide, F.floor(F.col("id") / wide)
    grid = spark.range(wide * high).select(
        (raster.tile_x0 + tx).alias("tile_x"),
        (raster.tile_y0 + ty).alias("tile_y"),
        F.lit(raster.zoom).alias("z"),
        (tx * bw).alias("col_off"),
        (ty * bh).alias("row_off"),
        F.lit(bw).alias("width"),
        F.lit(bh).alias("height"),
    )
    return with_cell(grid, "tile_x", "tile_y", "z")


# -- assembly ----------------------------------------------------------------


def assemble(
    rows: DataFrame,
    raster: Raster,
    compress: bool = False,
    compression_level: int = 6,
    drop_nan: bool = False,
    keep_empty: bool = False,
    in_order: bool = False,
    partitions: int | None = None,
) -> DataFrame:
    """Rows ``block, pos, <bands>`` to one row per block with each band's bytes.

    Cells with no row hold the nodata value. A band whose cells all equal it becomes null and a
    block with no band left is dropped, unless ``keep_empty``. Comparing with NaN is false, so
    all-NaN bands stay unless ``drop_nan``. ``in_order`` spreads blocks by range, which makes the
    output ready for a clustered write with no further shuffle.

    Before the shuffle each task packs the pixels it has of a block into one row of raw bytes. A
    pixel then takes its own size and two or four bytes of position, not a whole Spark row.
    """
    splits = None
    if in_order:
        partitions = partitions or output_partitions(rows.sparkSession, raster)
        splits = split_points(rows.select("block"), raster, partitions)
    chunks = _signed(rows, raster).mapInArrow(
        _packer({b.name: b.dtype for b in raster.bands}, raster.cells, splits),
        packed_schema(raster, part=True),
    )
    if in_order:
        spread = chunks.repartitionById(partitions, "part")
    elif partitions:
        spread = chunks.repartition(partitions, "block")
    else:
        spread = chunks.repartition("block")
    return fill_tiles(
        spread.drop("part"), raster, compress, compression_level, drop_nan, keep_empty
    )


def packed_schema(raster: Raster, part: bool = False) -> T.StructType:
    """Rows of packed pixels: positions in a block and the values there, as bytes."""
    extra = [T.StructField("part", T.IntegerType(), False)] if part else []
    return T.StructType(
        [T.StructField("block", T.LongType(), False), *extra, T.StructField("pos", T.BinaryType())]
        + [T.StructField(n, T.BinaryType()) for n in raster.names]
    )


def stored_schema(raster: Raster, part: bool = False) -> T.StructType:
    """Block rows, with the output partition they belong to if asked."""
    extra = [T.StructField("part", T.IntegerType(), False)] if part else []
    return T.StructType(
        [T.StructField("block", T.LongType(), False), *extra]
        + [T.StructField(n, T.BinaryType()) for n in raster.names]
    )


def fill_tiles(
    chunks: DataFrame,
    raster: Raster,
    compress: bool = False,
    compression_level: int = 6,
    drop_nan: bool = False,
    keep_empty: bool = False,
    splits: list[int] | None = None,
) -> DataFrame:
    """Packed rows, all rows of a block in one partition, to block rows.

    ``splits`` adds the range a block falls into as ``part``.
    """
    nodata = raster.table_nodata
    dtypes = {b.name: b.dtype for b in raster.bands}
    fills = {b.name: (0 if b == raster.alpha else nodata) for b in raster.bands}
    fill = _filler(
        dtypes, fills, nodata, raster.cells, compression_level if compress else None, drop_nan,
        keep_empty, splits,
    )
    schema = stored_schema(raster, part=splits is not None)
    return chunks.sortWithinPartitions("block").mapInArrow(fill, schema)


def _signed(rows: DataFrame, raster: Raster) -> DataFrame:
    """64-bit unsigned values travel as their signed bit pattern; Arrow decimals are slow."""
    half, full = F.lit(Decimal(1 << 63)), F.lit(Decimal(1 << 64))
    for band in raster.bands:
        if band.dtype == "uint64":
            value = F.col(band.name)
            signed = F.when(value >= half, value - full).otherwise(value).cast("long")
            rows = rows.withColumn(band.name, signed)
    return rows


def output_partitions(session: SparkSession, raster: Raster) -> int:
    """Output partitions of about 64 MB of cells; for small rasters, what cores there are."""
    if raster.width is None or raster.height is None:
        return int(session.conf.get("spark.sql.shuffle.partitions"))
    size = raster.width * raster.height * sum(item_size(b.dtype) for b in raster.bands)
    at_64_mb = -(-size // PARTITION_BYTES)
    at_1_mb = -(-size // (1 << 20))
    return max(at_64_mb, min(session.sparkContext.defaultParallelism, at_1_mb), 1)


def split_points(
    blocks: DataFrame, raster: Raster, partitions: int, rows: int | None = None
) -> list[int]:
    """Block ids that cut the rows into ranges of about equal size, from a sample of the ids.

    The sampling pass reads what the ids are made of only. Rows of one block never part. ``rows``
    is about how many rows there are, if not as many as the raster has pixels.
    """
    if partitions == 1:
        return []
    if rows is None and raster.width is not None and raster.height is not None:
        rows = raster.width * raster.height
    if rows is not None and SPLIT_SAMPLES * partitions < rows / 2:
        blocks = blocks.sample(SPLIT_SAMPLES * partitions / rows, seed=0)
    at = [i / partitions for i in range(1, partitions)]
    found = blocks.approxQuantile("block", at, 0.1 / partitions)
    return sorted({int(v) for v in found})


def parts_of(ids: np.ndarray, splits) -> pa.Array:
    edges = np.array(splits or [], dtype=np.int64)
    return pa.array(np.searchsorted(edges, ids, side="right").astype(np.int32))


def position_type(cells: int) -> str:
    return "<u2" if cells <= 1 << 16 else "<i4"


def _packer(dtypes, cells, splits):
    """The task function that packs pixels of a block into one row, as bytes per column."""
    names = list(dtypes)
    position = np.dtype(position_type(cells))

    def flush(held):
        blocks = np.concatenate([h["block"] for h in held])
        order = np.argsort(blocks, kind="stable")
        blocks = blocks[order]
        starts = np.concatenate([[0], np.flatnonzero(np.diff(blocks)) + 1])
        ends = np.append(starts, len(blocks))
        ids = blocks[starts]

        def chunked(column, dtype):
            values = np.concatenate([h[column] for h in held])[order].astype(dtype, copy=False)
            offsets = pa.py_buffer((ends * values.itemsize).astype("<i4"))
            return pa.Array.from_buffers(
                pa.binary(), len(ids), [None, offsets, pa.py_buffer(np.ascontiguousarray(values))]
            )

        columns = [pa.array(ids), parts_of(ids, splits), chunked("pos", position)]
        columns += [chunked(b, codec.wire_dtype(dtypes[b])) for b in names]
        return pa.RecordBatch.from_arrays(columns, names=["block", "part", "pos", *names])

    def values_of(batch, band):
        values = batch.column(band)
        if dtypes[band] == "uint64":
            return values.to_numpy().view("uint64")
        return codec.to_numpy(values, dtypes[band])

    def run(batches):
        held, count = [], 0
        for batch in batches:
            if batch.num_rows == 0:
                continue
            one = {c: batch.column(c).to_numpy() for c in ("block", "pos")}
            held.append(one | {b: values_of(batch, b) for b in names})
            count += batch.num_rows
            if count >= PACK_ROWS:
                yield flush(held)
                held, count = [], 0
        if held:
            yield flush(held)

    return run


def _filler(dtypes, fills, nodata, cells, gzip_level, drop_nan, keep_empty, splits):
    """The task function that fills tiles: packed rows sorted by block in, encoded blocks out."""
    names = list(dtypes)
    position = position_type(cells)
    at_once = max(1, DENSE_CELLS // cells)

    def empty_tiles(n):
        return {b: np.full((n, cells), fills[b], dtype=codec.wire_dtype(dtypes[b])) for b in names}

    def encode(blocks, tiles):
        keep = {b: np.full(len(blocks), True) for b in names}
        if not keep_empty:
            keep = {b: ~codec.blank_rows(tiles[b], nodata, drop_nan) for b in names}
        return codec.block_batch(
            blocks, tiles, keep, gzip_level, None if splits is None else parts_of(blocks, splits)
        )

    def bounded(batches):
        """Slices of batches with a bounded number of packed pixels, or one row."""
        for batch in batches:
            sizes = np.diff(codec.byte_offsets(batch.column("pos")))
            upto = np.cumsum(sizes) // (DENSE_CELLS * np.dtype(position).itemsize)
            cuts = np.flatnonzero(np.diff(upto)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, batch.num_rows]):
                if hi > lo:
                    yield batch.slice(lo, hi - lo)

    def run(batches):
        open_block, open_tile = None, None
        for batch in bounded(batches):
            sizes = np.diff(codec.byte_offsets(batch.column("pos")))
            blocks = np.repeat(
                batch.column("block").to_numpy(), sizes // np.dtype(position).itemsize
            )
            pos = codec.raw_values(batch.column("pos"), position)
            values = {
                b: codec.raw_values(batch.column(b), codec.wire_dtype(dtypes[b])) for b in names
            }
            starts = np.concatenate([[0], np.flatnonzero(np.diff(blocks)) + 1])
            for lo in range(0, len(starts), at_once):
                first = starts[lo : lo + at_once]
                ids = blocks[first]
                begin = first[0]
                stop = starts[lo + at_once] if lo + at_once < len(starts) else len(blocks)
                if open_block is not None and open_block != ids[0]:
                    yield encode(np.array([open_block]), open_tile)
                    open_block, open_tile = None, None
                tiles = empty_tiles(len(ids))
                if open_block is not None:
                    for b in names:
                        tiles[b][0] = open_tile[b][0]
                row = np.repeat(np.arange(len(ids)), np.diff(np.append(first, stop)))
                for b in names:
                    tiles[b][row, pos[begin:stop]] = values[b][begin:stop]
                # The last block may go on in the next batch.
                if len(ids) > 1:
                    yield encode(ids[:-1], {b: tiles[b][:-1] for b in names})
                open_block = ids[-1]
                open_tile = {b: tiles[b][-1:].copy() for b in names}
        if open_block is not None:
            yield encode(np.array([open_block]), open_tile)

    return run


def base_blocks(pixels: DataFrame, raster: Raster, **options) -> DataFrame:
    return assemble(tile_pixels(pixels, raster, pyramid=False), raster, **options)


def blocks(pixels: DataFrame, raster: Raster, **options) -> DataFrame:
    """Base and pyramid blocks of a raster, from one pass over its pixels."""
    return assemble(tile_pixels(pixels, raster), raster, **options)


# -- back to pixels ----------------------------------------------------------


def decode(
    stored: DataFrame, raster: Raster, compressed: bool = False, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Block rows to pixel rows ``z, gx, gy, <bands>`` in global pixel coordinates.

    A band that a block lacks reads as the table's nodata. Pixels also get the ``keep`` columns of
    their block, which are whole numbers.
    """
    bw, bh, cells = raster.block_width, raster.block_height, raster.cells
    nodata = raster.table_nodata
    dtypes = {b.name: b.dtype for b in raster.bands}
    kinds = {b.name: to_arrow_type(b.spark_type) for b in raster.bands}
    names = list(dtypes)
    rows_of = np.repeat(np.arange(bh, dtype=np.int64), bw)
    cols_of = np.tile(np.arange(bw, dtype=np.int64), bh)

    def run(batches):
        for batch in batches:
            at = {c: batch.column(c).to_numpy() for c in ("z", "tile_x", "tile_y")}
            for i in range(batch.num_rows):
                columns = [
                    pa.array(np.full(cells, at["z"][i], dtype=np.int32)),
                    pa.array(at["tile_x"][i] * bw + cols_of),
                    pa.array(at["tile_y"][i] * bh + rows_of),
                ]
                for b in names:
                    data = batch.column(b)[i].as_py()
                    if data is None:
                        values = np.full(cells, nodata, dtype=codec.wire_dtype(dtypes[b]))
                    else:
                        values = codec.unpack(data, dtypes[b], compressed)
                    columns.append(codec.value_column(values, kinds[b]))
                for c in keep:
                    one = batch.column(c)[i].as_py()
                    columns.append(pa.array([one] * cells, pa.int64()))
                yield pa.RecordBatch.from_arrays(columns, names=["z", "gx", "gy", *names, *keep])

    schema = T.StructType(
        [
            T.StructField("z", T.IntegerType(), False),
            T.StructField("gx", T.LongType(), False),
            T.StructField("gy", T.LongType(), False),
        ]
        + [T.StructField(b.name, b.spark_type) for b in raster.bands]
        + [T.StructField(c, T.LongType()) for c in keep]
    )
    data = with_tile(stored.where("block <> 0"), "block")
    return data.select("z", "tile_x", "tile_y", *names, *keep).mapInArrow(run, schema)


# -- small table operators ---------------------------------------------------


def merge_bands(parts: list[DataFrame]) -> DataFrame:
    """Bands loaded apart, side by side per block; a band a block lacks stays null.

    A block that several rows of a part have gets as many rows: the first of each part together,
    then the second, and so on, rows of a part being ordered by a hash of their bytes. All parts
    share one shuffle, by block.
    """
    tagged = [part.withColumn("__part", F.lit(i)) for i, part in enumerate(parts)]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    bands = [c for c in rows.columns if c not in ("block", "__part")]
    order = Window.partitionBy("block", "__part").orderBy(F.xxhash64(*bands))
    numbered = rows.repartition("block").withColumn("__copy", F.row_number().over(order))
    merged = numbered.groupBy("block", "__copy").agg(
        *[F.first(b, ignorenulls=True).alias(b) for b in bands]
    )
    return merged.drop("__copy")


def merge_copies(
    stored: DataFrame, raster: Raster, order: str, compressed: bool = False, level: int = 6
) -> DataFrame:
    """One row per block: of the rows of a block, in ascending ``order``, the last cell that is not
    nodata counts. Rows are read one by one, so a block may have any number of them."""
    dtypes = {b.name: b.dtype for b in raster.bands}
    fills = {b.name: 0 if b == raster.alpha else raster.band_nodata(b) for b in raster.bands}
    gzip_level = level if compressed else None

    def given(cells, fill):
        return ~np.isnan(cells) if cells.dtype.kind == "f" and np.isnan(fill) else cells != fill

    def packed(done):
        columns = {"block": pa.array([block for block, _ in done], pa.int64())}
        for b in dtypes:
            parts = [tiles.get(b) for _, tiles in done]
            columns[b] = pa.concat_arrays(
                [
                    pa.nulls(1, pa.binary())
                    if part is None
                    else codec.binary_column(part[None], np.ones(1, bool), gzip_level)
                    for part in parts
                ]
            )
        return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    def run(batches):
        done, tiles, last = [], {}, None
        for batch in batches:
            for i, block in enumerate(batch.column("block").to_pylist()):
                if block != last and last is not None:
                    done.append((last, tiles))
                    tiles = {}
                    if len(done) * raster.cells >= DENSE_CELLS:
                        yield packed(done)
                        done = []
                last = block
                for b, dtype in dtypes.items():
                    data = batch.column(b)[i].as_py()
                    if data is None:
                        continue
                    cells = codec.unpack(data, dtype, compressed)
                    if b in tiles:
                        tiles[b] = np.where(given(cells, fills[b]), cells, tiles[b])
                    else:
                        tiles[b] = cells
        if last is not None:
            done.append((last, tiles))
        if done:
            yield packed(done)

    rows = stored.select("block", order, *dtypes)
    sorted_ = rows.repartition("block").sortWithinPartitions("block", order)
    return sorted_.mapInArrow(run, stored_schema(raster))


def missing_blocks(written: DataFrame, expected: int) -> DataFrame:
    """How many of the expected blocks were empty and so not written."""
    return written.agg(F.count("*").alias("written")).select(
        F.lit(expected).cast("long").alias("expected"),
        "written",
        (F.lit(expected) - F.col("written")).alias("empty"),
    )


def with_rank(blocks: DataFrame, cell: str = "block", out: str = "rank") -> DataFrame:
    """Zero-based position of each block in cell order.

    The blocks are dealt out by ranges of the cell, sorted and written with their place in their
    partition; a rank is that place and the count of the partitions before, of which there is one
    row each. Blocks are stored first, as the ranges come from a look at them before they are dealt.
    """
    spark = blocks.sparkSession
    held, placed = scratch(spark, "ranked"), scratch(spark, "places")
    blocks.write.parquet(held)
    ordered = spark.read.schema(blocks.schema).parquet(held)
    # Upper bits: the partition; the others: the row in it.
    ordered = ordered.repartitionByRange(cell).sortWithinPartitions(cell)
    ordered = ordered.withColumn("__place", F.monotonically_increasing_id())
    ordered.write.parquet(placed)
    found = spark.read.schema(ordered.schema).parquet(placed)
    found = found.withColumn("__part", F.shiftright("__place", PLACE_BITS))
    sizes = found.groupBy("__part").agg(F.count("*").alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__first")
    place = F.col("__place").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    return (
        found.join(F.broadcast(sizes.select("__part", first)), "__part")
        .withColumn(out, F.col("__first") + place)
        .drop("__part", "__place", "__first")
    )


def with_batch(blocks: DataFrame, size: int, cell: str = "block", out: str = "batch") -> DataFrame:
    """Number blocks into batches of ``size`` in cell order; the last may be shorter."""
    if size < 1:
        raise ValueError("size must be at least one")
    return with_rank(blocks, cell).withColumn(out, F.floor(F.col("rank") / size))


def to_arrays(stored: DataFrame, raster: Raster, compressed: bool = False) -> DataFrame:
    """Block rows with each band's bytes as an array of values; a missing band stays null."""
    dtypes = {b.name: b.dtype for b in raster.bands}
    kinds = {b.name: to_arrow_type(b.spark_type) for b in raster.bands}

    def run(batches):
        for batch in batches:
            columns = [batch.column("block")]
            for b, dtype in dtypes.items():
                ends, parts = [0], []
                for data in batch.column(b):
                    if data.is_valid:
                        parts.append(codec.unpack(data.as_py(), dtype, compressed))
                    ends.append(ends[-1] + (len(parts[-1]) if data.is_valid else 0))
                flat = np.concatenate(parts) if parts else np.empty(0, codec.wire_dtype(dtype))
                values = codec.value_column(flat, kinds[b])
                missing = pa.array([not d.is_valid for d in batch.column(b)])
                offsets = pa.array(ends, pa.int32())
                columns.append(pa.ListArray.from_arrays(offsets, values, mask=missing))
            yield pa.RecordBatch.from_arrays(columns, names=["block", *dtypes])

    schema = T.StructType(
        [T.StructField("block", T.LongType(), False)]
        + [T.StructField(b.name, T.ArrayType(b.spark_type)) for b in raster.bands]
    )
    return stored.where("block <> 0").select("block", *dtypes).mapInArrow(run, schema)
