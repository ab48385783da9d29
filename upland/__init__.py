"""upland: elevation rasters and linear works on Spark."""
