"""Kawara: building footprints, hazard polygons and boundaries as Spark DataFrames."""

__version__ = "0.1.0"
