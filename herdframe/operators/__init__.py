"""DataFrame operators: take DataFrames, return lazy DataFrames."""
