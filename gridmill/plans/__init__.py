"""End-to-end plans: the load of a raster, and the registered queries with their checks."""
