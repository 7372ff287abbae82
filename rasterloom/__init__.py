"""rasterloom: a Spark-native engine for geospatial event catalogues, raster patches and leak-free splits."""
