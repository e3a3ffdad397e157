"""DataFrame operators: DataFrames in, a DataFrame out, nothing collected."""
