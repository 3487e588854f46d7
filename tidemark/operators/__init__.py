"""The analyses. Each function takes DataFrames and dates and returns a lazy DataFrame."""
