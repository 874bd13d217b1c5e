"""Layer builders and checks: each takes DataFrames and returns a DataFrame."""
