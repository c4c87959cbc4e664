"""DataFrame operators. Each takes and returns DataFrames, apart from those that write."""
