"""Spatial, space-time and partition-layout analytics on PySpark DataFrames."""
