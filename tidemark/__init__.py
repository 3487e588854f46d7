"""Product analytics on Spark: plain functions from DataFrames and dates to a DataFrame."""
