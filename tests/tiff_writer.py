"""Tiled TIFF files for the tests."""

from gridmill.sources.tiff_file import encode_tiff


def write_tiff(path, bands, *args, **facts):
    with open(path, "wb") as file:
        file.write(encode_tiff(bands, *args, **facts))
