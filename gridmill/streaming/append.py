"""Appending a stream of pixel files to one block table."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gridmill.plans.load import load_raster
from gridmill.sources.tables import BlockTable
from gridmill.spec import Raster


def append_stream(
    pixels: DataFrame,
    raster: Raster,
    table: BlockTable,
    checkpoint: str,
    name: str | None = None,
    trigger: dict | None = None,
    compact: bool = True,
    **options,
) -> StreamingQuery:
    """Load each micro-batch of a streaming pixel table as one raster.

    ``raster`` places pixel (0, 0); a batch may hold any part of the pixel plane. Stream and batch
    number name the load, so a batch that is run again after a failure replaces its own rows. The
    stream is named by the id in its checkpoint, unless ``name`` is given; give one only to let a
    stream with a new checkpoint replace what an earlier one loaded.

    With ``compact``, tiles whose pixels come in several batches are merged after each batch, at all
    levels; only loads that share tiles with the batch are written anew.
    """

    def load_batch(batch: DataFrame, number: int) -> None:
        if batch.isEmpty():
            return
        context = batch.sparkSession.sparkContext
        stream = name or context.getLocalProperty("sql.streaming.queryId")
        part, moved = window_of(batch, raster)
        load = f"{stream}-{number}"
        load_raster(moved, part, table, mode="append", load=load, **options)
        if compact:
            table.compact(raster, options.get("compress", False), load)

    writer = pixels.writeStream.foreachBatch(load_batch).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def window_of(batch: DataFrame, raster: Raster) -> tuple[Raster, DataFrame]:
    """The tile-aligned part of the raster that a batch covers, and its pixels moved to it."""
    bw, bh = raster.block_width, raster.block_height
    edges = batch.agg(
        F.min("px").alias("x0"),
        F.max("px").alias("x1"),
        F.min("py").alias("y0"),
        F.max("py").alias("y1"),
    ).first()
    left, top = edges.x0 // bw, edges.y0 // bh
    part = replace(
        raster,
        tile_x0=raster.tile_x0 + left,
        tile_y0=raster.tile_y0 + top,
        width=edges.x1 + 1 - left * bw,
        height=edges.y1 + 1 - top * bh,
    )
    moved = batch.withColumns({"px": F.col("px") - left * bw, "py": F.col("py") - top * bh})
    return part, moved
