"""Facts about a raster that are known when a plan is built: bands, grid and nodata rules.

These objects are small (one entry per band) and never hold pixels.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field, replace

from pyspark.sql import types as T

# Nodata used for a band type when neither the raster nor the band states one.
DEFAULT_NODATA = {
    "int8": -128,
    "int16": -32768,
    "int32": -2147483648,
    "int64": -9223372036854775808,
    "uint8": 0,
    "uint16": 65535,
    "uint32": 4294967295,
    "uint64": 18446744073709551615,
    "float16": math.nan,
    "float32": math.nan,
    "float64": math.nan,
}

# Column names every block table has.
RESERVED_NAMES = ("block", "metadata")

# Fixed value: the deepest pixel resolution a table may have.
MAX_PIXEL_RESOLUTION = 26

# Fixed value: block edge, in pixels, whose zoom equals the tiling scheme's zoom.
ZOOM_BLOCK_EDGE = 256

# Unsigned types take the next wider Spark type; the encoder narrows them again.
SPARK_TYPES = {
    "int8": T.ByteType(),
    "int16": T.ShortType(),
    "int32": T.IntegerType(),
    "int64": T.LongType(),
    "uint8": T.ShortType(),
    "uint16": T.IntegerType(),
    "uint32": T.LongType(),
    "uint64": T.DecimalType(20, 0),
    "float16": T.FloatType(),
    "float32": T.FloatType(),
    "float64": T.DoubleType(),
}

RGB = ("red", "green", "blue")


def item_size(dtype: str) -> int:
    """Bytes per pixel of a band type in an encoded tile."""
    check_dtype(dtype)
    return int(dtype.lstrip("uintfloa")) // 8


def check_dtype(dtype: str) -> str:
    if dtype not in DEFAULT_NODATA:
        raise ValueError(f"No raster type is called {dtype}")
    return dtype


def _is_nan(value) -> bool:
    return isinstance(value, float) and math.isnan(value)


def _same(a, b) -> bool:
    return (_is_nan(a) and _is_nan(b)) or a == b


@dataclass(frozen=True)
class Band:
    """One band: the pixel column that holds it and what its values mean."""

    name: str
    dtype: str = "uint8"
    colorinterp: str | None = None
    nodata: float | int | None = None
    colortable: dict[int, tuple[int, int, int, int]] | None = None
    valuelabels: dict[str, str] | None = None

    def __post_init__(self):
        check_dtype(self.dtype)

    @property
    def is_float(self) -> bool:
        return self.dtype.startswith("float")

    @property
    def spark_type(self) -> T.DataType:
        return SPARK_TYPES[self.dtype]


@dataclass(frozen=True)
class Raster:
    """A tiled raster aligned to the web Mercator tile grid."""

    bands: tuple[Band, ...]
    zoom: int
    tile_x0: int
    tile_y0: int
    block_width: int = 256
    block_height: int = 256
    width: int | None = None
    height: int | None = None
    nodata: float | int | None = None
    overviews: tuple[int, ...] = field(default_factory=tuple)

    def __post_init__(self):
        check_overviews(self.overviews)
        if len(self.overviews) > self.zoom:
            raise ValueError("A raster cannot have more overview levels than its zoom")
        if self.pixel_resolution > MAX_PIXEL_RESOLUTION:
            raise ValueError(
                f"Pixel resolution {self.pixel_resolution} exceeds the largest supported one, "
                f"{MAX_PIXEL_RESOLUTION}; resample the raster first"
            )

    # -- grid -------------------------------------------------------------

    @property
    def cells(self) -> int:
        return self.block_width * self.block_height

    @property
    def pixel_resolution(self) -> int:
        # The logarithm of an exact power of four may fall a hair below the integer.
        return int(self.zoom + math.log(self.cells, 4) + 1e-9)

    @property
    def levels(self) -> int:
        return len(self.overviews)

    @property
    def tiles_wide(self) -> int:
        return -(-self._known("width") // self.block_width)

    @property
    def tiles_high(self) -> int:
        return -(-self._known("height") // self.block_height)

    def _known(self, attribute: str) -> int:
        value = getattr(self, attribute)
        if value is None:
            raise ValueError(f"The raster's {attribute} is not known; measure the pixels first")
        return value

    def sized(self, width: int, height: int) -> "Raster":
        return replace(self, width=int(width), height=int(height))

    # -- bands ------------------------------------------------------------

    def band(self, name: str) -> Band:
        for band in self.bands:
            if band.name == name:
                return band
        raise ValueError(f"Band {name} not found")

    def select(self, *names: str) -> "Raster":
        return replace(self, bands=tuple(self.band(n) for n in names))

    @property
    def names(self) -> list[str]:
        return [b.name for b in self.bands]

    @property
    def alpha(self) -> Band | None:
        return next((b for b in self.bands if b.colorinterp == "alpha"), None)

    def compound(self, band: Band) -> list[Band]:
        """Bands whose nodata is judged together with this one (a full colour triplet)."""
        if band.colorinterp in RGB:
            triplet = [b for b in self.bands if b.colorinterp in RGB]
            if len(triplet) == 3:
                return triplet
        return [band]

    def stated_nodata(self, band: Band):
        return self.nodata if self.nodata is not None else band.nodata

    def band_nodata(self, band: Band):
        stated = self.stated_nodata(band)
        return DEFAULT_NODATA[band.dtype] if stated is None else stated

    def always_valid(self, band: Band) -> bool:
        """True when nothing masks the band: it is the alpha band, or nobody states a nodata."""
        alpha = self.alpha
        if alpha is not None:
            return band == alpha
        return self.stated_nodata(band) is None and not band.is_float

    @property
    def table_nodata(self):
        """The one nodata value of the table; bands must agree on it."""
        value = self.band_nodata(self.bands[0])
        if any(not _same(self.band_nodata(b), value) for b in self.bands):
            raise ValueError("The bands have no nodata value in common")
        return value


def check_overviews(factors) -> None:
    if any(f != 2 ** (i + 1) for i, f in enumerate(factors)):
        raise ValueError("Overviews must halve the raster step by step: 2, 4, 8 and so on")


def check_block_shapes(shapes) -> None:
    if len(set(map(tuple, shapes))) > 1:
        raise ValueError("All bands need blocks of one shape")


def check_names(names) -> None:
    """Refuse band names that collide with the table's own columns, in any case."""
    clash = sorted({n for n in names if n and n.lower() in RESERVED_NAMES})
    if clash:
        raise ValueError(f"The table needs these column names itself: {clash}")


def pair_bands(numbers, names=None, style=None) -> list[tuple[int, str]]:
    """Pair band numbers with column names; unnamed bands are called ``band_<n>``."""
    names = [None] * len(numbers) if not names else list(names)
    if len(names) != len(numbers):
        raise ValueError(f"{len(numbers)} bands cannot carry {len(names)} names")
    check_names(names)
    style = style or (lambda name: name)
    return [(n, style(name or f"band_{n}")) for n, name in zip(numbers, names)]


def pick_source(file_path=None, file_url=None) -> str:
    """Exactly one of a path and a URL must be given."""
    if (file_path is None) == (file_url is None):
        raise ValueError("Give exactly one of file_path and file_url")
    return file_path if file_path is not None else file_url
