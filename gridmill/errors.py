"""Exceptions raised to callers."""


class IncompatibleRaster(ValueError):
    """The source raster is not aligned to the web map tiling scheme."""


class IncompatibleTable(ValueError):
    """The raster cannot be appended to the table because their metadata differ."""
