"""Raster tables on Spark: pixels, tiles, pyramids, statistics and metadata as DataFrames."""

import sys

from pyspark import cloudpickle

from gridmill.errors import IncompatibleRaster, IncompatibleTable
from gridmill.spec import Band, Raster

__version__ = "0.1.0"

# Ship the helpers that run in Python tasks by value, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["Band", "IncompatibleRaster", "IncompatibleTable", "Raster", "__version__"]
