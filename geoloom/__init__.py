"""geoloom: raster and vector feature analytics as Spark DataFrames."""
