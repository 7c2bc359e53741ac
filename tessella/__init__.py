"""Cohort, measurement and embedding analytics on Spark DataFrames."""
