"""Tiled TIFF files as a Spark data source: ``spark.read.format("webmap_tiff").load(path)``.

Rows are ``z, tile_x, tile_y`` and one array per band, for the base image and, with the option
``overviews``, for the reduced images that the files hold themselves. Headers are read once, when a
scan is planned; a task then gets rows of tiles that make up about ``TASK_BYTES``, whichever files
they are in, and reads the byte ranges of these tiles only. Filters that compare ``z``, ``tile_x`` or
``tile_y`` with numbers are taken over by the source (if ``spark.sql.python.filterPushdown.enabled``
is set): tiles outside are never read. The option ``bands`` (numbers from 1) chooses bands, of planar
files only theirs are read; ``names`` names them.

A reduced image need not begin at the edge of a tile of its level, so a tile is put together from the
up to four stored ones that it meets. Factors are powers of two. Cells outside an image hold nodata,
in an alpha band 0. Deflate tiles may use either predictor of the format.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    LessThan,
    LessThanOrEqual,
)
from pyspark.sql.pandas.types import to_arrow_type

from gridmill.errors import IncompatibleRaster
from gridmill.functions import codec
from gridmill.sources import tiff
from gridmill.spec import Raster

PLACES = ("z", "tile_x", "tile_y")
HEADER_THREADS = 32


def register(spark: SparkSession) -> None:
    """Make the format known to a session, and let Spark hand filters over."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(TiffSource)


def listed(path: str) -> list[tuple[str, int]]:
    """Names and lengths of the files at a path, which may be a folder or end in a pattern."""
    from fnmatch import fnmatch

    from pyarrow import fs

    filesystem, name = tiff.file_system(path.rstrip("/"))
    folder, _, pattern = name.rpartition("/")
    prefix = path[: len(path.rstrip("/")) - len(name)]
    if "*" in pattern:
        found = filesystem.get_file_info(fs.FileSelector(folder))
        found = [f for f in found if fnmatch(f.base_name, pattern)]
    else:
        info = filesystem.get_file_info(name)
        if info.type == fs.FileType.Directory:
            info = filesystem.get_file_info(fs.FileSelector(name))
        found = info if isinstance(info, list) else [info]
    kept = [f for f in found if f.type == fs.FileType.File and f.base_name[0] not in "._"]
    return sorted((prefix + f.path, f.size) for f in kept)


@dataclass
class Image:
    """One image of a file. ``left`` and ``top``: where it begins, in pixels of the world at z."""

    z: int
    left: int
    top: int
    width: int
    height: int
    starts: np.ndarray  # by plane and stored tile
    sizes: np.ndarray
    compression: int
    predictor: int


def images(path: str, length: int, overviews: bool) -> tuple[dict, list[Image]]:
    """The profile of a file and its images, the base first."""
    profile = tiff.describe_file(path, length)
    read = tiff.RangeReader(path)
    bw, bh, found = profile["block_width"], profile["block_height"], []
    planes = profile["bands"] if profile["planar"] == 2 else 1
    for i, tags in enumerate(tiff.read_directories(read)):
        value = lambda tag, default=None: tiff.tag_values(read, tags, tag, [default])[0]  # noqa: B023, E731
        if i and not (overviews and value(tiff.SUBFILE, 0) == 1):
            continue
        if (value(tiff.TILE_WIDTH), value(tiff.TILE_HEIGHT)) != (bw, bh):
            raise IncompatibleRaster(f"An image of {path} has tiles of another size")
        levels = math.log2(profile["width"] / value(tiff.WIDTH))
        factor = 1 << round(levels)
        left, top = profile["tile_x0"] * bw, profile["tile_y0"] * bh
        whole = -(-profile["width"] // factor), -(-profile["height"] // factor)
        size = value(tiff.WIDTH), value(tiff.HEIGHT)
        if left % factor or top % factor or size != whole:
            raise IncompatibleRaster(f"An image of {path} does not lie on a level of the pyramid")
        arrays = (
            np.array(tiff.tag_values(read, tags, tag), np.int64).reshape(planes, -1)
            for tag in (tiff.TILE_OFFSETS, tiff.TILE_COUNTS)
        )
        found.append(
            Image(
                profile["zoom"] - round(levels), left // factor, top // factor, *size, *arrays,
                value(tiff.COMPRESSION, 1), value(tiff.PREDICTOR, 1),
            )
        )
    return profile, found


@dataclass
class Bounds:
    """Numbers that a column may have: from ``low`` to ``high``, and if given among ``only``."""

    low: float = -math.inf
    high: float = math.inf
    only: frozenset | None = None

    def narrow(self, f: Filter) -> bool:
        """Take a filter over, if it is of a known kind."""
        if isinstance(f, In):
            values = frozenset(f.value)
        elif isinstance(f, EqualTo):
            values = frozenset([f.value])
        else:
            values = None
        if values is not None:
            self.only = values if self.only is None else self.only & values
        elif isinstance(f, GreaterThan):
            self.low = max(self.low, math.floor(f.value) + 1)
        elif isinstance(f, GreaterThanOrEqual):
            self.low = max(self.low, math.ceil(f.value))
        elif isinstance(f, LessThan):
            self.high = min(self.high, math.ceil(f.value) - 1)
        elif isinstance(f, LessThanOrEqual):
            self.high = min(self.high, math.floor(f.value))
        else:
            return False
        return True

    def among(self, first: int, last: int) -> list[tuple[int, int]]:
        """The runs of numbers from first to last that are allowed, both ends inside."""
        first, last = max(first, self.low), min(last, self.high)
        if first > last:
            return []
        if self.only is None:
            return [(int(first), int(last))]
        return [(int(v), int(v)) for v in sorted(self.only) if first <= v <= last]


@dataclass
class Tiles(InputPartition):
    """Rows of tiles: path, length, number of the image, tile row, first and last column."""

    rows: list[tuple[str, int, int, int, int, int]]


class TiffSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "webmap_tiff"

    def __init__(self, options) -> None:
        super().__init__(options)
        self.files = listed(options["path"])
        if not self.files:
            raise FileNotFoundError(f"There is no file at {options['path']}")

    def raster(self) -> Raster:
        """The bands as the first file has them."""
        from pyspark.sql import Row

        profile = tiff.describe_file(*self.files[0])
        profile["colortable"] = dict(profile["colortable"] or []) or None
        split = lambda key: [p for p in self.options.get(key, "").split(",") if p]
        numbers = [int(n) for n in split("bands")] or None
        return tiff.raster_of(Row(**profile), split("names") or None, numbers)

    def schema(self) -> T.StructType:
        places = [T.StructField(p, T.LongType() if p != "z" else T.IntegerType()) for p in PLACES]
        bands = [T.StructField(b.name, T.ArrayType(b.spark_type)) for b in self.raster().bands]
        return T.StructType(places + bands)

    def reader(self, schema: T.StructType) -> TiffReader:
        numbers = [int(n) for n in self.options.get("bands", "").split(",") if n]
        overviews = str(self.options.get("overviews", "false")).lower() == "true"
        task_bytes = int(self.options.get("task_bytes", tiff.TASK_BYTES))
        return TiffReader(self.files, self.raster(), numbers, overviews, task_bytes)


class TiffReader(DataSourceReader):
    def __init__(self, files, raster: Raster, numbers, overviews: bool, task_bytes: int) -> None:
        self.files, self.raster, self.numbers = files, raster, numbers
        self.overviews, self.task_bytes = overviews, task_bytes
        self.bounds = {p: Bounds() for p in PLACES}

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Filters on places are applied here; the others stay with Spark."""
        for f in filters:
            column = getattr(f, "attribute", ())
            known = len(column) == 1 and column[0] in PLACES
            if not (known and self.bounds[column[0]].narrow(f)):
                yield f

    def partitions(self) -> list[Tiles]:
        """Rows of tiles inside the bounds, in pieces of about ``task_bytes``."""
        with ThreadPoolExecutor(HEADER_THREADS) as pool:
            found = pool.map(lambda f: images(*f, self.overviews), self.files)
            pieces, rows, held = [], [], 0.0
            for (path, length), (profile, levels) in zip(self.files, found, strict=True):
                self._agree(path, profile)
                for number, image in enumerate(levels):
                    for row, cost in self._rows(image):
                        rows.append((path, length, number, *row))
                        held += cost
                        if held >= self.task_bytes:
                            pieces.append(Tiles(rows))
                            rows, held = [], 0.0
        return [*pieces, Tiles(rows)] if rows or not pieces else pieces

    def _agree(self, path: str, profile: dict) -> None:
        own = self.raster
        if (profile["block_width"], profile["block_height"], profile["dtype"]) != (
            own.block_width, own.block_height, own.bands[0].dtype
        ):
            raise IncompatibleRaster(f"{path} differs from the other files in more than its extent")

    def _rows(self, image: Image) -> Iterator[tuple[tuple[int, int, int], float]]:
        """(tile row, first and last column) and about how many bytes it takes."""
        bw, bh = self.raster.block_width, self.raster.block_height
        if not self.bounds["z"].among(image.z, image.z):
            return
        wide = -(-image.width // bw)
        by_row = image.sizes.sum(axis=0).reshape(-1, wide).sum(axis=1)
        last_x, last_y = (image.left + image.width - 1) // bw, (image.top + image.height - 1) // bh
        for first, last in self.bounds["tile_y"].among(image.top // bh, last_y):
            for y in range(first, last + 1):
                stored = self._met(y, image.top, bh, image.height)
                share = sum(int(by_row[s]) for s in stored) / wide / len(stored)
                step = max(1, int(self.task_bytes / max(share, 1)))
                for begin, end in self.bounds["tile_x"].among(image.left // bw, last_x):
                    for x in range(begin, end + 1, step):
                        stop = min(x + step - 1, end)
                        yield (y, x, stop), share * (stop - x + 1)

    @staticmethod
    def _met(tile: int, origin: int, size: int, extent: int) -> range:
        """The stored tiles, along one side, that a tile of the level meets."""
        first = max(tile * size - origin, 0) // size
        last = (min((tile + 1) * size - origin, extent) - 1) // size
        return range(first, last + 1)

    def read(self, partition: Tiles) -> Iterator[pa.RecordBatch]:
        raster = self.raster
        bw, bh, n = raster.block_width, raster.block_height, len(raster.bands)
        at_once = max(1, tiff.BATCH_CELLS // (bw * bh * n))
        held, path, levels, read = [], None, [], None
        for name, length, number, y, first, last in partition.rows:
            if name != path:
                path, read = name, tiff.RangeReader(name)
                levels = images(name, length, self.overviews)[1]
            for x in range(first, last + 1):
                cells = self._cells(read, levels[number], x, y)
                if cells is not None:
                    held.append((levels[number].z, x, y, cells))
                if len(held) == at_once:
                    yield self._batch(held)
                    held = []
        if held:
            yield self._batch(held)

    def _cells(self, read, image: Image, x: int, y: int) -> np.ndarray | None:
        """The cells of a tile by band; none if nothing of it is stored."""
        raster = self.raster
        bw, bh = raster.block_width, raster.block_height
        fill = [0 if b == raster.alpha else raster.table_nodata for b in raster.bands]
        kind = codec.wire_dtype(raster.bands[0].dtype)
        out = np.empty((len(fill), bh, bw), kind)
        out[:] = np.array(fill, dtype=object).astype(kind).reshape(-1, 1, 1)
        wide, any_ = -(-image.width // bw), False
        left, top = x * bw - image.left, y * bh - image.top
        for row in self._met(y, image.top, bh, image.height):
            for column in self._met(x, image.left, bw, image.width):
                part = self._stored(read, image, row * wide + column)
                if part is None:
                    continue
                any_ = True
                # Where the stored tile and this one overlap, in pixels of the image.
                x0, x1 = max(left, column * bw), min(left + bw, (column + 1) * bw, image.width)
                y0, y1 = max(top, row * bh), min(top + bh, (row + 1) * bh, image.height)
                for band, cells in zip(out, part, strict=True):
                    if cells is not None:
                        band[y0 - top : y1 - top, x0 - left : x1 - left] = cells[
                            y0 - row * bh : y1 - row * bh, x0 - column * bw : x1 - column * bw
                        ]
        return out if any_ else None

    def _stored(self, read, image: Image, at: int) -> list | None:
        """A stored tile's cells by chosen band."""
        raster = self.raster
        bw, bh = raster.block_width, raster.block_height
        planes = len(image.starts)
        chosen = [k - 1 for k in self.numbers] or list(range(len(raster.bands)))
        kind = codec.wire_dtype(raster.bands[0].dtype)

        def unpacked(plane: int):
            size = int(image.sizes[plane, at])
            if not size:
                return None
            data = read(int(image.starts[plane, at]), size)
            return tiff.unpacked(data, image.compression, image.predictor, kind, bh, bw)

        if planes == 1:
            whole = unpacked(0)
            return None if whole is None else [whole[:, :, k] for k in chosen]
        parts = [unpacked(k) for k in chosen]
        if all(p is None for p in parts):
            return None
        return [None if p is None else p[:, :, 0] for p in parts]

    def _batch(self, held: list) -> pa.RecordBatch:
        raster = self.raster
        cells = raster.block_width * raster.block_height
        ends = pa.array(np.arange(len(held) + 1, dtype=np.int32) * cells)
        kind = to_arrow_type(raster.bands[0].spark_type)
        lists = [
            pa.ListArray.from_arrays(
                ends, codec.value_column(np.concatenate([h[3][b].ravel() for h in held]), kind)
            )
            for b in range(len(raster.bands))
        ]
        z, x, y = (
            pa.array([h[i] for h in held], k) for i, k in enumerate([pa.int32(), *[pa.int64()] * 2])
        )
        return pa.RecordBatch.from_arrays([z, x, y, *lists], [*PLACES, *raster.names])
