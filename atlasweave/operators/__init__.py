"""Table-level operators: every one takes DataFrames and returns a DataFrame."""
