"""Small tiled TIFF files, made whole in memory."""

from __future__ import annotations

import math
import struct
import zlib

import numpy as np

from gridmill.functions.geo import EARTH_RADIUS
from gridmill.sources.tiff import SCHEME, file_system

WORLD = 2 * math.pi * EARTH_RADIUS
CODES = {"B": 1, "s": 2, "H": 3, "I": 4, "d": 12, "Q": 16}


def encode_tiff(
    bands, zoom, tile_x0, tile_y0, edge, deflate=True, nodata=None, photometric=1, extra=(),
    scheme=SCHEME, planar=1, big=False, overviews=(), colormap=None, shift=0.0, predictor=1,
):
    """A tile-aligned file of bands, a list of 2-D arrays of one type; small enough for memory.

    ``overviews`` are factors, of which every such pixel is kept, or pairs of a factor and bands.
    """
    height, width = bands[0].shape
    out = bytearray(b"\0" * 16)

    def put(bands):
        """Write the tiles of an image and return its tags."""
        height, width = bands[0].shape
        wide, high = -(-width // edge), -(-height // edge)
        padded = np.zeros((len(bands), high * edge, wide * edge), bands[0].dtype)
        for b, band in enumerate(bands):
            padded[b, :height, :width] = band
        starts, sizes = [], []
        for plane in range(len(bands) if planar == 2 else 1):
            for ty in range(high):
                for tx in range(wide):
                    cut = padded[:, ty * edge : (ty + 1) * edge, tx * edge : (tx + 1) * edge]
                    cut = cut[plane : plane + 1] if planar == 2 else cut
                    data = foretold(cut.transpose(1, 2, 0), predictor)
                    data = zlib.compress(data) if deflate else data
                    starts.append(len(out))
                    sizes.append(len(data))
                    out.extend(data)
        return {
            256: ("I", [width]), 257: ("I", [height]), 259: ("H", [8 if deflate else 1]),
            317: ("H", [predictor]), 322: ("I", [edge]), 323: ("I", [edge]),
            324: ("Q" if big else "I", starts), 325: ("Q" if big else "I", sizes),
        }

    tile = WORLD / 2**zoom
    kind = {"u": 1, "i": 2, "f": 3}[bands[0].dtype.kind]
    n = len(bands)
    items = f'<GDALMetadata><Item name="NAME" domain="TILING_SCHEME">{scheme}</Item></GDALMetadata>'
    tags = put(bands) | {
        254: ("I", [0]), 258: ("H", [bands[0].dtype.itemsize * 8] * n),
        262: ("H", [photometric]), 277: ("H", [n]), 284: ("H", [planar]),
        339: ("H", [kind] * n), 33550: ("d", [tile / edge, tile / edge, 0.0]),
        33922: ("d", [0.0, 0.0, 0.0, tile_x0 * tile - WORLD / 2 + shift * tile,
                      WORLD / 2 - tile_y0 * tile, 0.0]),
    }
    if scheme:
        tags[42112] = ("s", items.encode() + b"\0")
    if extra:
        tags[338] = ("H", list(extra))
    if nodata is not None:
        tags[42113] = ("s", str(nodata).encode() + b"\0")
    if colormap is not None:
        tags[320] = ("H", colormap)
    images = [tags]
    for level in overviews:
        reduced = [b[::level, ::level] for b in bands] if isinstance(level, int) else level[1]
        images.append(put(reduced) | {254: ("I", [1])})
    inline, head, entry, word = (8, "<Q", "<HHQ", "<Q") if big else (4, "<H", "<HHI", "<I")
    link = 8 if big else 4
    out[:link] = struct.pack("<2sHHH", b"II", 43, 8, 0) if big else struct.pack("<2sH", b"II", 42)
    for image in images:
        packed = {}
        for tag, (code, values) in sorted(image.items()):
            count = len(values)
            data = values if code == "s" else struct.pack(f"<{count}{code}", *values)
            if len(data) <= inline:
                packed[tag] = (code, count, data.ljust(inline, b"\0"))
            else:
                packed[tag] = (code, count, struct.pack(word, len(out)))
                out += data
        out[link : link + struct.calcsize(word)] = struct.pack(word, len(out))
        out += struct.pack(head, len(packed))
        for tag, (code, count, data) in packed.items():
            out += struct.pack(entry, tag, CODES[code], count) + data
        link = len(out)
        out += struct.pack(word, 0)
    return bytes(out)


def foretold(cells: np.ndarray, predictor: int) -> bytes:
    """The bytes of cells by row, column and sample, after the predictor."""
    kind = cells.dtype
    if predictor == 2:
        whole = np.ascontiguousarray(cells).view(f"u{kind.itemsize}")
        cells = np.diff(whole, axis=1, prepend=whole[:, :1] * 0)
    elif predictor == 3:
        high, _, samples = cells.shape
        raw = np.ascontiguousarray(cells).astype(kind.newbyteorder(">")).view(np.uint8)
        planes = raw.reshape(high, -1, kind.itemsize).transpose(0, 2, 1).reshape(high, -1, samples)
        cells = np.diff(planes, axis=1, prepend=planes[:, :1] * 0)
    return np.ascontiguousarray(cells).astype(cells.dtype.newbyteorder("<")).tobytes()


def write_file(path: str, data: bytes) -> None:
    """Write a file whole, on any file system that tasks can read TIFF files from."""
    filesystem, name = file_system(path)
    filesystem.create_dir(name.rpartition("/")[0], recursive=True)
    with filesystem.open_output_stream(name) as file:
        file.write(data)
