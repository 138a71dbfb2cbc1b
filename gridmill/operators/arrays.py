"""Tiles that are arrays already: encoded where they are, with the pyramid packed from them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmill.functions import codec
from gridmill.functions.cells import tile_cell, with_cell
from gridmill.operators.tiling import (
    fill_tiles,
    packed_schema,
    parts_of,
    position_type,
    stored_schema,
)
from gridmill.spec import Raster


def _reader(raster: Raster):
    """A task function: a batch of tiles to filled 2-D arrays, and which rows each band has."""
    nodata, cells = raster.table_nodata, raster.cells
    dtypes = {b.name: b.dtype for b in raster.bands}
    alpha = raster.alpha.name if raster.alpha is not None else None
    stated = {b.name: raster.stated_nodata(b) for b in raster.bands}

    def read(batch):
        tiles, given = {}, {}
        for b, dtype in dtypes.items():
            fill = 0 if b == alpha else nodata
            tiles[b], given[b] = codec.dense_rows(batch.column(b), dtype, cells, fill)
        for b in dtypes:
            if alpha is not None and b != alpha:
                tiles[b][tiles[alpha] == 0] = nodata
            elif alpha is None and stated[b] is not None and stated[b] != nodata:
                tiles[b][tiles[b] == stated[b]] = nodata
        return tiles, given

    return read


def encode_arrays(
    tiles: DataFrame,
    raster: Raster,
    compress: bool = False,
    compression_level: int = 6,
    drop_nan: bool = False,
    splits: list[int] | None = None,
) -> DataFrame:
    """Tiles ``block, <bands ARRAY>`` to block rows, with no shuffle.

    Masked cells take the table's nodata. ``splits`` adds the range of a block as ``part``.
    """
    read, names, nodata = _reader(raster), raster.names, raster.table_nodata
    level = compression_level if compress else None

    def run(batches):
        for batch in batches:
            ids = batch.column("block").to_numpy()
            dense, given = read(batch)
            keep = {b: given[b] & ~codec.blank_rows(dense[b], nodata, drop_nan) for b in names}
            parts = None if splits is None else parts_of(ids, splits)
            yield codec.block_batch(ids, dense, keep, level, parts)

    return tiles.select("block", *names).mapInArrow(
        run, stored_schema(raster, part=splits is not None)
    )


def pack_pyramid(tiles: DataFrame, raster: Raster) -> DataFrame:
    """Packed rows of the pixels that the pyramid keeps of base tiles ``tile_x, tile_y, <bands>``.

    A base tile lies in one tile of each level, so it gives at most one row per level.
    """
    read, names, levels = _reader(raster), raster.names, raster.levels
    bw, bh, zoom = raster.block_width, raster.block_height, raster.zoom
    position = position_type(raster.cells)

    def kept(first, size, level):
        """Places in a tile of the pixels a level keeps, and their places in its parent."""
        at = np.arange(first, first + size)
        inside = np.flatnonzero(at & ((1 << level) - 1) == 1 << (level - 1))
        return inside, (at[inside] >> level) % size

    def run(batches):
        for batch in batches:
            dense, _ = read(batch)
            tx, ty = (batch.column(c).to_numpy() for c in ("tile_x", "tile_y"))
            for level in range(1, levels + 1):
                rows = []
                for i in range(batch.num_rows):
                    cols, to_x = kept(int(tx[i]) * bw, bw, level)
                    lines, to_y = kept(int(ty[i]) * bh, bh, level)
                    if not len(cols) or not len(lines):
                        continue
                    pos = (to_y[:, None] * bw + to_x).astype(position)
                    cut = (lines[:, None] * bw + cols).ravel()
                    values = [dense[b][i][cut].tobytes() for b in names]
                    rows.append(
                        (int(tx[i]) >> level, int(ty[i]) >> level, zoom - level, pos.tobytes(), *values)
                    )
                if rows:
                    columns = [pa.array(c) for c in zip(*rows)]
                    columns[2] = columns[2].cast(pa.int32())
                    yield pa.RecordBatch.from_arrays(
                        columns, names=["tile_x", "tile_y", "z", "pos", *names]
                    )

    schema = T.StructType(
        [T.StructField(c, T.LongType(), False) for c in ("tile_x", "tile_y")]
        + [T.StructField("z", T.IntegerType(), False)]
        + packed_schema(raster).fields[1:]
    )
    packed = tiles.select("tile_x", "tile_y", *names).mapInArrow(run, schema)
    return with_cell(packed, "tile_x", "tile_y", "z").select("block", "pos", *names)


def pack_levels(tiles: DataFrame, raster: Raster) -> DataFrame:
    """Packed rows of pyramid tiles ``z, tile_x, tile_y, <bands>`` that are there already.

    Parts of one tile, as files beside each other have them, are put together when blocks are
    filled; cells that hold nodata in all bands are not packed.
    """
    read, names = _reader(raster), raster.names
    position = position_type(raster.cells)
    fill = {b.name: 0 if b == raster.alpha else raster.table_nodata for b in raster.bands}

    def run(batches):
        for batch in batches:
            dense, _ = read(batch)
            rows = []
            for i in range(batch.num_rows):
                some = np.zeros(raster.cells, bool)
                for b in names:
                    cells = dense[b][i]
                    some |= cells == cells if fill[b] != fill[b] else cells != fill[b]
                at = np.flatnonzero(some)
                if len(at):
                    values = [dense[b][i][at].tobytes() for b in names]
                    rows.append((batch.column("block")[i].as_py(), at.astype(position).tobytes(),
                                 *values))
            if rows:
                columns = [pa.array(c) for c in zip(*rows, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=["block", "pos", *names])

    schema = T.StructType(
        [T.StructField("block", T.LongType(), False)] + packed_schema(raster).fields[1:]
    )
    placed = with_cell(tiles, "tile_x", "tile_y", "z")
    return placed.select("block", *names).mapInArrow(run, schema)


def blocks_of_tiles(
    tiles: DataFrame,
    raster: Raster,
    splits: list[int] | None = None,
    levels: DataFrame | None = None,
    **options,
) -> DataFrame:
    """Base and pyramid blocks of tiles ``tile_x, tile_y, <bands ARRAY>``.

    Base tiles are encoded where they are; only the pixels the pyramid keeps are shuffled, packed.
    ``levels`` gives tiles ``z, tile_x, tile_y, <bands ARRAY>`` of the pyramid, instead of taking
    them from the base.
    """
    placed = with_cell(tiles, "tile_x", "tile_y", raster.zoom)
    base = encode_arrays(placed, raster, splits=splits, **options)
    if not raster.levels:
        return base
    packed = pack_pyramid(tiles, raster) if levels is None else pack_levels(levels, raster)
    chunks = packed.repartition("block")
    return fill_tiles(chunks, raster, splits=splits, **options).unionByName(base)


def block_ids(tiles: DataFrame, raster: Raster) -> DataFrame:
    """The ids of the blocks that tiles ``tile_x, tile_y`` give: their own and their ancestors'.

    An ancestor is listed by the one descendant in its corner; at the edges some go unlisted.
    """
    levels = F.sequence(F.lit(0), F.lit(raster.levels))

    def in_corner(level):
        mask = F.call_function("shiftleft", F.lit(1).cast("long"), level) - 1
        return (F.col("tile_x").bitwiseOR(F.col("tile_y"))).bitwiseAND(mask) == 0

    listed = tiles.select(
        "tile_x", "tile_y", F.explode(F.filter(levels, in_corner)).alias("level")
    )
    x, y = (F.call_function("shiftright", F.col(c), F.col("level")) for c in ("tile_x", "tile_y"))
    return listed.select(tile_cell(x, y, raster.zoom - F.col("level")).alias("block"))
