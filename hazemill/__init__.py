"""Hourly weather and air-quality analytics on Spark DataFrames."""
