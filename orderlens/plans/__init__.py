"""Reports and tables as functions from DataFrames to DataFrames."""
