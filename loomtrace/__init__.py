"""Trajectory and training-data analytics on Spark DataFrames."""
