"""Drift, temporal validation and scoring operators on Spark DataFrames."""
