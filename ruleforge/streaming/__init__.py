"""Rules on streaming DataFrames."""
