"""Trajectory and point-cloud analytics on PySpark DataFrames."""
