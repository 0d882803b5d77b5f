"""Street-network analytics on Spark: sources, spatial/raster/graph operators, cost models, reports."""
