"""Tiled TIFF files as Spark tables.

Little-endian classic and big files, plain or deflate tiles with or without a predictor. Files are listed by Spark; tasks read
only headers and byte ranges, never a whole file. The tiles of all files are dealt out evenly, so a
file that holds most of the data is read by as many tasks as its share calls for.
"""

from __future__ import annotations

import math
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from gridmill.errors import IncompatibleRaster
from gridmill.functions import codec
from gridmill.functions.geo import EARTH_RADIUS
from gridmill.spec import RGB, Band, Raster, pair_bands

# Fixed values of the file format: tag numbers, and struct codes by field type.
WIDTH, HEIGHT, BITS, COMPRESSION, PHOTOMETRIC = 256, 257, 258, 259, 262
SUBFILE, SAMPLES, PLANAR, PREDICTOR, COLOR_MAP = 254, 277, 284, 317, 320
TILE_WIDTH, TILE_HEIGHT, TILE_OFFSETS, TILE_COUNTS = 322, 323, 324, 325
EXTRA_SAMPLES, SAMPLE_FORMAT = 338, 339
PIXEL_SCALE, TIE_POINT, XML, NODATA = 33550, 33922, 42112, 42113
FIELD_CODES = {
    1: "B", 2: "s", 3: "H", 4: "I", 5: "II", 6: "b", 7: "s", 8: "h", 9: "i", 10: "ii", 11: "f",
    12: "d", 13: "I", 16: "Q", 17: "q", 18: "Q",
}
PLAIN, DEFLATE = (1,), (8, 32946)
PREDICTORS = NO_PREDICTOR, DIFFERENCES, FLOAT_DIFFERENCES = (1, 2, 3)
MASK = 4  # bit of a directory's kind
KINDS = {1: "uint", 2: "int", 3: "float"}
SCHEME = "GoogleMapsCompatible"

# How much a task reads, and how many cells it hands on at once.
TASK_BYTES = 64 << 20
BATCH_CELLS = 1 << 21

PROFILE = """path string, length long, width long, height long, block_width int, block_height int,
    zoom int, tile_x0 long, tile_y0 long, dtype string, bands int, colorinterp array<string>,
    nodata double, overviews array<int>, colortable map<int, array<int>>, compression int,
    planar int, predictor int"""
TILE_LIST = """path string, position long, samples array<struct<start: long, size: long>>,
    tile_x long, tile_y long, inside_x int, inside_y int, compression int,
    predictor int"""


# -- reading headers, in tasks ---------------------------------------------------


# Names that Spark's file systems have for stores that Arrow opens under another.
SCHEMES = {"s3a": "s3", "s3n": "s3", "abfs": "abfss", "gcs": "gs"}


def file_system(path: str):
    """The Arrow file system of a path, under Spark's names or Arrow's own, and the path in it.

    Credentials are those that Arrow finds on the executors.
    """
    from pyarrow import fs

    scheme, mark, rest = path.partition("://")
    if mark and scheme in SCHEMES:
        path = f"{SCHEMES[scheme]}://{rest}"
    elif path.startswith("dbfs:/"):
        path = "/dbfs/" + path[6:].lstrip("/")
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    if re.match(r"^/[^:]*$", path):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path)


class RangeReader:
    """Byte ranges of a file on any file system Arrow knows."""

    def __init__(self, path: str):
        filesystem, name = file_system(path)
        self.file = filesystem.open_input_file(name)

    def __call__(self, start: int, size: int) -> bytes:
        return self.file.read_at(size, start)


def read_directories(read) -> list[dict]:
    """The tags of every image in a file; long arrays are left as (type, count, offset)."""
    magic = read(0, 16)
    if magic[:2] != b"II":
        raise ValueError("Only little-endian TIFF files can be read")
    big = struct.unpack_from("<H", magic, 2)[0] == 43
    here = struct.unpack_from("<Q" if big else "<I", magic, 8 if big else 4)[0]
    count_code, entry_size, inline = ("<Q", 20, 8) if big else ("<H", 12, 4)
    found = []
    while here:
        head = struct.calcsize(count_code)
        n = struct.unpack(count_code, read(here, head))[0]
        body = read(here + head, n * entry_size + inline)
        tags = {}
        for i in range(n):
            tag, kind = struct.unpack_from("<HH", body, i * entry_size)
            count = struct.unpack_from("<Q" if big else "<I", body, i * entry_size + 4)[0]
            at = i * entry_size + entry_size - inline
            size = struct.calcsize("<" + FIELD_CODES[kind]) * count
            if size <= inline:
                tags[tag] = (kind, count, body[at : at + size])
            else:
                tags[tag] = (kind, count, struct.unpack_from("<Q" if big else "<I", body, at)[0])
        found.append(tags)
        here = struct.unpack_from("<Q" if big else "<I", body, n * entry_size)[0]
    return found


def tag_values(read, tags: dict, tag: int, default=None):
    if tag not in tags:
        return default
    kind, count, data = tags[tag]
    code = FIELD_CODES[kind]
    if not isinstance(data, bytes):
        data = read(data, struct.calcsize("<" + code) * count)
    if code == "s":
        return data.rstrip(b"\0").decode("utf-8", "replace")
    return np.frombuffer(data, "<" + code[0]).tolist()


def describe_file(path: str, length: int) -> dict:
    """The profile of one file; raises if it is not a tile-aligned web map raster."""
    read = RangeReader(path)
    directories = read_directories(read)
    base = directories[0]

    def value(tag, default=None):
        values = tag_values(read, base, tag, default)
        return values[0] if isinstance(values, list) else values

    if TILE_WIDTH not in base:
        raise IncompatibleRaster(f"{path} is not tiled")
    if value(COMPRESSION, 1) not in PLAIN + DEFLATE or value(PREDICTOR, 1) not in PREDICTORS:
        raise ValueError(f"{path} has a compression that cannot be read")
    items = tag_values(read, base, XML, "") or ""
    scheme = re.search(r'name="NAME"[^>]*domain="TILING_SCHEME"[^>]*>([^<]*)<', items, re.I)
    if scheme is None or scheme.group(1) != SCHEME:
        raise IncompatibleRaster(f"{path} is not a {SCHEME} raster")
    scale, tie = tag_values(read, base, PIXEL_SCALE), tag_values(read, base, TIE_POINT)
    width, height = value(WIDTH), value(HEIGHT)
    bw, bh = value(TILE_WIDTH), value(TILE_HEIGHT)
    world = 2 * math.pi * EARTH_RADIUS
    zoom = math.log2(world / (scale[0] * bw))
    tile = world / 2 ** round(zoom)
    tile_x = (tie[3] - tie[0] * scale[0] + world / 2) / tile
    tile_y = (world / 2 - tie[4] - tie[1] * scale[1]) / tile
    aligned = (abs(v - round(v)) < 1e-4 for v in (zoom, tile_x, tile_y))
    if not all(aligned) or abs(scale[0] * bw - scale[1] * bh) > tile * 1e-6:
        raise IncompatibleRaster(f"{path} is not aligned to web map tiles")
    samples = value(SAMPLES, 1)
    bits, kinds = tag_values(read, base, BITS, [8]), tag_values(read, base, SAMPLE_FORMAT, [1])
    if len(set(bits)) > 1 or len(set(kinds)) > 1:
        raise ValueError(f"{path} has bands of different types")
    photometric = value(PHOTOMETRIC, 1)
    colours = list(RGB) if photometric == 2 else ["palette" if photometric == 3 else "gray"]
    extra = tag_values(read, base, EXTRA_SAMPLES, [])
    colours += ["alpha" if e in (1, 2) else "undefined" for e in extra]
    colours = (colours + ["undefined"] * samples)[:samples]
    table = None
    if photometric == 3 and COLOR_MAP in base:
        entries = np.array(tag_values(read, base, COLOR_MAP)).reshape(3, -1) >> 8
        table = [(i, [int(c) for c in rgb] + [255]) for i, rgb in enumerate(entries.T)]
    kinds_of = [tag_values(read, d, SUBFILE, [0])[0] for d in directories]
    if any(kind & MASK for kind in kinds_of):
        raise ValueError(f"{path} has an internal mask; state a nodata value or an alpha band")
    coarse = [
        round(width / tag_values(read, d, WIDTH)[0])
        for d in directories[1:]
        if tag_values(read, d, SUBFILE, [0])[0] == 1
    ]
    nodata = tag_values(read, base, NODATA)
    return {
        "path": path, "length": length, "width": width, "height": height, "block_width": bw,
        "block_height": bh, "zoom": round(zoom), "tile_x0": round(tile_x),
        "tile_y0": round(tile_y), "dtype": f"{KINDS[kinds[0]]}{bits[0]}", "bands": samples,
        "colorinterp": colours, "nodata": None if nodata is None else float(nodata),
        "overviews": coarse, "colortable": table, "compression": value(COMPRESSION, 1),
        "planar": value(PLANAR, 1), "predictor": value(PREDICTOR, 1),
    }


def unpacked(
    data: bytes, compression: int, predictor: int, kind: np.dtype, height: int, width: int
) -> np.ndarray:
    """The cells of a stored tile by row, column and sample. A predictor stores each value of a row
    as its difference from the one before; for floats of the bytes, the leading ones of all values
    first."""
    kind = np.dtype(kind)
    data = zlib.decompress(data) if compression in DEFLATE else data
    if predictor == FLOAT_DIFFERENCES:
        rows = np.frombuffer(data, np.uint8).reshape(height, -1)
        samples = rows.shape[1] // (width * kind.itemsize)
        # Neighbours are a sample apart; sums wrap as the differences did.
        steps = rows.reshape(height, -1, samples)
        summed = np.cumsum(steps, axis=1, dtype=np.uint8).reshape(height, kind.itemsize, -1)
        cells = np.ascontiguousarray(summed.transpose(0, 2, 1)).view(kind.newbyteorder(">"))
        return cells.astype(kind).reshape(height, width, samples)
    cells = np.frombuffer(data, kind).reshape(height, width, -1)
    if predictor == DIFFERENCES:
        whole = np.dtype(f"u{kind.itemsize}").newbyteorder("<")
        cells = np.cumsum(cells.view(whole), axis=1, dtype=whole).view(kind)
    return cells


# -- Spark tables ----------------------------------------------------------------


def _arrow_schema(ddl: str) -> tuple[T.StructType, pa.Schema]:
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = T._parse_datatype_string(ddl)
    return schema, to_arrow_schema(schema)


def files(spark: SparkSession, path: str) -> DataFrame:
    """The files of a path, by name and length; their content is not read."""
    return spark.read.format("binaryFile").load(path).select("path", "length")


def profiles(spark: SparkSession, path: str) -> DataFrame:
    """One row of header facts per file."""
    schema, arrow = _arrow_schema(PROFILE)

    def run(batches):
        for batch in batches:
            rows = [describe_file(r["path"], r["length"]) for r in batch.to_pylist()]
            yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    return files(spark, path).mapInArrow(run, schema)


# What the files of one load must agree in.
SHARED = ("block_width", "block_height", "zoom", "dtype", "bands", "colorinterp", "nodata",
          "overviews")


def common_profile(spark: SparkSession, path: str) -> Row:
    """One profile for all files of a path, which must agree in all but their extent.

    The extent spans all files. A file may end inside a tile only where the whole raster does, as
    the padding of such a tile would else count as pixels.
    """
    found = profiles(spark, path)
    east = F.col("tile_x0") * F.col("block_width") + F.col("width")
    south = F.col("tile_y0") * F.col("block_height") + F.col("height")
    ragged = lambda edge, size: F.min(F.when(edge % F.col(size) != 0, edge))
    kinds = (
        found.groupBy(*SHARED, F.to_json("colortable").alias("colours"))
        .agg(
            F.min("tile_x0").alias("tile_x0"),
            F.min("tile_y0").alias("tile_y0"),
            F.max(east).alias("east"),
            F.max(south).alias("south"),
            ragged(east, "block_width").alias("ragged_east"),
            ragged(south, "block_height").alias("ragged_south"),
            F.first("colortable").alias("colortable"),
        )
        .limit(2)
        .collect()
    )
    if not kinds:
        raise FileNotFoundError(f"There is no file at {path}")
    if len(kinds) > 1:
        raise IncompatibleRaster(f"The files of {path} differ in more than their extent")
    one = kinds[0].asDict()
    for side in ("east", "south"):
        if one[f"ragged_{side}"] not in (None, one[side]):
            raise IncompatibleRaster(f"A file of {path} ends inside a tile before the others do")
    one["width"] = one["east"] - one["tile_x0"] * one["block_width"]
    one["height"] = one["south"] - one["tile_y0"] * one["block_height"]
    return Row(**one)


def raster_of(
    profile: Row,
    names: list[str] | None = None,
    numbers: list[int] | None = None,
    style=None,
    labels: dict[int, dict] | None = None,
) -> Raster:
    """The raster that a profile row describes, or some of its bands, by number from 1."""
    numbers = list(numbers or range(1, profile.bands + 1))
    wrong = [n for n in numbers if not 1 <= n <= profile.bands]
    if wrong:
        raise ValueError(f"There are {profile.bands} bands, none numbered {wrong}")
    bands = []
    for number, name in pair_bands(numbers, names, style):
        colour = profile.colorinterp[number - 1]
        table = profile.colortable if colour == "palette" else None
        given = (labels or {}).get(number)
        given = None if given is None else {str(k): str(v) for k, v in given.items()}
        bands.append(Band(name, profile.dtype, colour, None, table, given))
    return Raster(
        tuple(bands), profile.zoom, profile.tile_x0, profile.tile_y0, profile.block_width,
        profile.block_height, profile.width, profile.height, profile.nodata,
        tuple(profile.overviews),
    )


def tile_list(profiled: DataFrame) -> DataFrame:
    """One row per stored tile: where its bytes are and which web map tile it is."""
    schema, arrow = _arrow_schema(TILE_LIST)

    def run(batches):
        for batch in batches:
            for p in batch.to_pylist():
                yield from list_tiles(p)

    def list_tiles(p):
        read = RangeReader(p["path"])
        base = read_directories(read)[0]
        starts = np.array(tag_values(read, base, TILE_OFFSETS), dtype=np.int64)
        sizes = np.array(tag_values(read, base, TILE_COUNTS), dtype=np.int64)
        wide = -(-p["width"] // p["block_width"])
        high = -(-p["height"] // p["block_height"])
        planes = p["bands"] if p["planar"] == 2 else 1
        starts, sizes = starts.reshape(planes, -1), sizes.reshape(planes, -1)
        for lo in range(0, wide * high, 4096):
            rows = []
            for i in range(lo, min(lo + 4096, wide * high)):
                if not sizes[:, i].any():
                    continue
                tx, ty = i % wide, i // wide
                rows.append(
                    {
                        "path": p["path"],
                        "position": i,
                        "samples": [
                            {"start": int(s), "size": int(n)}
                            for s, n in zip(starts[:, i], sizes[:, i])
                        ],
                        "tile_x": p["tile_x0"] + tx,
                        "tile_y": p["tile_y0"] + ty,
                        "inside_x": min(p["block_width"], p["width"] - tx * p["block_width"]),
                        "inside_y": min(p["block_height"], p["height"] - ty * p["block_height"]),
                        "compression": p["compression"],
                        "predictor": p["predictor"],
                    }
                )
            yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    return profiled.mapInArrow(run, schema)


def tiles(
    spark: SparkSession,
    path: str,
    raster: Raster | None = None,
    numbers: list[int] | None = None,
) -> DataFrame:
    """The base tiles of the files: ``tile_x, tile_y, <bands ARRAY>``.

    Pixels of an edge tile that lie outside the raster hold the nodata value, in the alpha band 0.
    ``numbers`` are those of the raster's bands in the files; of planar files only these are read.
    """
    profiled = profiles(spark, path)
    stored = common_profile(spark, path)
    if raster is None:
        raster = raster_of(stored, None, numbers)
    chosen = [n - 1 for n in numbers or range(1, stored.bands + 1)]
    total = files(spark, path).agg(F.sum("length")).first()[0]
    tasks = max(spark.sparkContext.defaultParallelism, math.ceil(total / TASK_BYTES))
    # Neighbouring tiles go to one task; a fixed number of tasks, as the rows themselves are small.
    listed = tile_list(profiled)
    dealt = listed.repartition(tasks, "path", F.shiftright("position", 4))

    bw, bh, n = raster.block_width, raster.block_height, len(raster.bands)
    dtype = raster.bands[0].dtype
    kind = to_arrow_type(raster.bands[0].spark_type)
    names = raster.names
    padding = [0 if b == raster.alpha else raster.table_nodata for b in raster.bands]
    at_once = max(1, BATCH_CELLS // (bw * bh * n))

    wire = codec.wire_dtype(dtype)

    def part(read, tile, k):
        at = tile["samples"][k]
        data = read(at["start"], at["size"])
        return unpacked(data, tile["compression"], tile["predictor"], wire, bh, bw)

    def read_tile(read, tile):
        if len(tile["samples"]) == 1:
            cells = part(read, tile, 0).transpose(2, 0, 1)[chosen].copy()
        else:
            empty = [np.full((bh, bw, 1), fill, wire) for fill in padding]
            cells = np.stack(
                [
                    part(read, tile, k) if tile["samples"][k]["size"] else empty[i]
                    for i, k in enumerate(chosen)
                ]
            ).reshape(n, bh, bw)
        for band, fill in zip(cells, padding, strict=True):
            band[tile["inside_y"] :, :] = fill
            band[:, tile["inside_x"] :] = fill
        return cells.reshape(n, -1)

    def run(batches):
        open_path, read = None, None
        for batch in batches:
            rows = batch.to_pylist()
            for lo in range(0, len(rows), at_once):
                some = rows[lo : lo + at_once]
                cells = []
                for tile in some:
                    if tile["path"] != open_path:
                        open_path, read = tile["path"], RangeReader(tile["path"])
                    cells.append(read_tile(read, tile))
                offsets = pa.array(np.arange(len(some) + 1, dtype=np.int32) * (bw * bh))
                lists = [
                    pa.ListArray.from_arrays(
                        offsets, codec.value_column(np.concatenate([c[b] for c in cells]), kind)
                    )
                    for b in range(n)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([t["tile_x"] for t in some], pa.int64()),
                        pa.array([t["tile_y"] for t in some], pa.int64()),
                        *lists,
                    ],
                    names=["tile_x", "tile_y", *names],
                )

    schema = T.StructType(
        [T.StructField("tile_x", T.LongType()), T.StructField("tile_y", T.LongType())]
        + [T.StructField(b.name, T.ArrayType(b.spark_type)) for b in raster.bands]
    )
    return dealt.mapInArrow(run, schema)
