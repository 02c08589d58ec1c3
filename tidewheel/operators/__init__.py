"""Table operators: DataFrames in, DataFrames out, lazy throughout."""
