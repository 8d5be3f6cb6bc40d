"""Sensor readings in, window averages and rule alerts out, on Spark DataFrames."""
